"""The landed VARIANT table and the history of its schema."""

from __future__ import annotations

import glob
import json

import pyarrow.parquet as pq
import pytest
from conftest import SF0001

from sessionlens.plans.schema_history import leaf_types, schema_history
from sessionlens.runtime import table_path
from sessionlens.sources import driver_tables, json_io


def line(event_id, day, params=None, **more):
    listed = [{"key": k, "value": v} for k, v in (params or {}).items()]
    return {"event_id": event_id, "event_date": day, "event_timestamp": 1, "event_name": "x", "user_pseudo_id": "u", "event_params": listed,
            "device": {"category": "mobile"}, "geo": None, "traffic_source": {}, "ecommerce": {"purchase_revenue_in_usd": None}, "items": []} | more


@pytest.fixture()
def landed(spark, tmp_path):
    def make(lines):
        (tmp_path / "shards").mkdir()
        (tmp_path / "shards" / "a.json").write_text("\n".join(json.dumps(x) for x in lines))
        path = str(tmp_path / "landed")
        json_io.write_landed(json_io.load_landed(spark, str(tmp_path / "shards")), path)
        return json_io.read_landed(spark, path)

    return make


def test_landed_table_is_shredded_and_paths_reach_the_scan(spark):
    path, shards = table_path(spark, "test_landed"), table_path(spark, "test_shards")
    raw = driver_tables.raw_events(spark, SF0001)
    json_io.export_ndjson(raw, shards)
    json_io.write_landed(json_io.load_landed(spark, shards), path)
    written = str(pq.ParquetFile(glob.glob(f"{path.removeprefix('file:')}/*/*.parquet")[0]).schema)
    assert "typed_value" in written and "category" in written
    fields = json_io.variant_fields(json_io.read_landed(spark, path, "20240105", "20240107"))
    plan = fields.where("device_category = 'mobile'")._jdf.queryExecution().executedPlan().toString()
    # Single paths are read, typed, with the filter on one of them; the params
    # and items are not read at all.
    assert "device:struct<0:string>" in plan and "EqualTo(device.`0`,mobile)" in plan
    assert "event_params" not in plan and "items" not in plan and "PartitionFilters: [isnotnull(event_day" in plan
    flat = json_io.variant_params(json_io.read_landed(spark, path))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_landed_values_survive_other_types(landed):
    odd = [line(1, "20240101", device={"category": "tablet"}), line(2, "20240101", device={"category": 7}), line(3, "20240101", device="none"),
           line(4, "20240101", device=None), line(5, "20240101", device={"category": None, "more": [1, {"x": 2}]})]
    rows = landed(odd).selectExpr("event_id", "to_json(device) as device").collect()
    assert {r.event_id: None if r.device is None else json.loads(r.device) for r in rows} == {x["event_id"]: x["device"] for x in odd}


def test_leaf_types():
    assert leaf_types("OBJECT<a: BIGINT, b: OBJECT<c: VOID, d: ARRAY<OBJECT<e: DECIMAL(5,2)>>>, f: OBJECT<>, `odd-name`: BOOLEAN>") == {
        "a": "number", "b.d[].e": "number", "odd-name": "boolean"
    }
    assert leaf_types("ARRAY<VOID>") == {} and leaf_types("STRING") == {"": "string"} and leaf_types("VOID") == {}


def test_history_tells_the_day_of_a_change(landed):
    n = {"int_value": 5, "string_value": None}
    days = [
        line(1, "20240101", {"old": n}), line(2, "20240102", {"old": n, "new": {"int_value": None, "string_value": "s"}}),
        line(3, "20240103", {"new": {"int_value": None, "string_value": "s"}}, device={"category": 3}), line(4, "20240104", {"new": n}, geo={"city": "x"}),
    ]
    got = {r.path: r for r in schema_history(landed(days), ["event_id", "event_params[new].string_value", "geo.country"]).collect()}

    def told(path):
        r = got[path]
        return r.types, r.first_day, r.last_day, r.days, r.declared, r.change

    assert told("event_id") == ("number", "20240101", "20240104", 4, True, "none")
    assert told("event_params[old].int_value") == ("number", "20240101", "20240102", 2, False, "gone")
    assert told("event_params[new].string_value") == ("string", "20240102", "20240103", 2, True, "added, gone")
    assert told("event_params[new].int_value") == ("number", "20240104", "20240104", 1, False, "added")
    assert told("device.category") == ("number, string", "20240101", "20240104", 4, False, "type changed")
    assert told("geo.city") == ("string", "20240104", "20240104", 1, False, "added")
    assert told("geo.country") == (None, None, None, 0, True, "missing")
    assert "event_params[old].string_value" not in got and "ecommerce.purchase_revenue_in_usd" not in got


def test_history_of_nothing(landed):
    got = schema_history(landed([line(1, "20240101")]).where("event_id is null"), ["event_id"]).collect()
    assert [(r.path, r.days, r.change) for r in got] == [("event_id", 0, "missing")]
