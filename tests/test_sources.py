"""Sources and sinks: day partitions, NDJSON export/load, incremental load."""

from __future__ import annotations

import glob
import gzip
import os
import tempfile
from collections import Counter

import pytest
from conftest import SF0001, ev, raw_df
from pyspark.sql import functions as F

from sessionlens.schemas import DAY_PARTITION
from sessionlens.sources import driver_tables, event_days, json_io
from sessionlens.streaming.ingest import ingest_available


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sessionlens-test-")


def test_day_partition_pruning(spark, scratch):
    raw = driver_tables.raw_events(spark, SF0001)
    path = os.path.join(scratch, "days")
    event_days.write_event_days(raw, path)
    df = event_days.read_event_days(spark, path, "20240105", "20240106")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    days = {r[DAY_PARTITION] for r in df.select(DAY_PARTITION).distinct().collect()}
    assert days == {"20240105", "20240106"}
    assert df.count() == raw.where(F.col("event_date").between("20240105", "20240106")).count()


def test_dynamic_overwrite_reloads_only_given_days(spark, scratch):
    path = os.path.join(scratch, "days")
    rows = [ev("u1", 1, "page_view", "2020-11-02 10:00:00"), ev("u1", 2, "page_view", "2020-11-03 10:00:00")]
    event_days.write_event_days(raw_df(spark, rows), path)
    again = [ev("u9", 9, "purchase", "2020-11-03 11:00:00")]
    event_days.write_event_days(raw_df(spark, again), path)
    got = {(r.event_day, r.user_pseudo_id) for r in event_days.read_event_days(spark, path).collect()}
    assert got == {("20201102", "u1"), ("20201103", "u9")}


def test_truncating_reload_leaves_no_stale_days(spark, scratch):
    path = os.path.join(scratch, "days")
    rows = [ev("u1", 1, "page_view", "2020-11-02 10:00:00"), ev("u1", 2, "page_view", "2020-11-03 10:00:00")]
    event_days.write_event_days(raw_df(spark, rows), path)
    event_days.write_event_days(raw_df(spark, rows[1:]), path, dynamic=False)
    assert {r.event_day for r in event_days.read_event_days(spark, path).collect()} == {"20201103"}


def test_a_large_day_is_written_by_several_tasks(spark, scratch):
    raw = driver_tables.raw_events(spark, SF0001).withColumn("event_date", F.lit("20240105"))
    path = os.path.join(scratch, "days")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        event_days.write_event_days(raw.repartition(8), path)
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(os.path.join(path, f"{DAY_PARTITION}=20240105", "*.parquet"))) > 1
    assert event_days.read_event_days(spark, path).count() == raw.count()


def test_malformed_json_fails_the_job(spark):
    exported = json_io.to_json_columns(raw_df(spark, [ev("u1", 1, "page_view", "2020-11-02 10:00:00")]))
    with pytest.raises(Exception):
        json_io.from_json_columns(exported.withColumn("device", F.lit('{"category": '))).collect()


def test_adapter_gives_null_for_null(spark, scratch):
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    holes = events.withColumns({"user_id": F.lit(None).cast("long"), "props": F.lit(None).cast("string")})
    holes.write.parquet(os.path.join(scratch, "events.parquet"))
    raw = driver_tables.raw_events(spark, scratch)
    got = raw.select("device.category", "geo.country", "traffic_source.medium", "user_pseudo_id").distinct().collect()
    assert [tuple(r) for r in got] == [(None, None, None, None)]
    assert json_io.from_json_columns(json_io.to_json_columns(raw)).count() == raw.count()


def test_ndjson_export_shards_and_failfast(spark, scratch):
    raw = driver_tables.raw_events(spark, SF0001)
    n = raw.count()
    path = os.path.join(scratch, "json")
    json_io.export_ndjson(raw.coalesce(1), path, shard_rows=1000)
    shards = sorted(glob.glob(os.path.join(path, "*.json.gz")))
    assert len(shards) == -(-n // 1000)
    with gzip.open(shards[0], "rt") as fh:
        line = fh.readline()
    assert line.startswith('{"event_id":') and ": " not in line  # compact separators
    assert json_io.load_ndjson(spark, path).count() == n
    bad = os.path.join(scratch, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "x.json"), "w") as fh:
        fh.write('{"event_id": "not a number"}\n')
    with pytest.raises(Exception):
        json_io.load_ndjson(spark, bad).collect()


def test_variant_paths_equal_struct_paths(spark):
    raw = driver_tables.raw_events(spark, SF0001)
    v = json_io.variant_fields(json_io.as_variant(raw))
    s = raw.select(
        "event_id",
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
    )
    assert v.exceptAll(s).count() == 0 and s.exceptAll(v).count() == 0


def test_bulk_load_returns_the_whole_window(spark):
    import __spark_entry__ as E

    loaded, staged = (Counter(map(tuple, E.queries()[n](spark, SF0001).collect())) for n in ("load_raw_events", "stg_events"))
    assert loaded == staged


def test_incremental_ingest_is_exactly_once(spark, scratch):
    raw = driver_tables.raw_events(spark, SF0001)
    landing, table, ckpt = (os.path.join(scratch, x) for x in ("landing", "table", "ckpt"))
    first = F.col("event_date") <= "20240115"
    json_io.export_ndjson(raw.where(first), os.path.join(landing, "b1"))
    n1 = ingest_available(spark, os.path.join(landing, "b*"), table, ckpt).count()
    assert n1 == raw.where(first).count()
    # A second run with nothing new loads nothing twice.
    assert ingest_available(spark, os.path.join(landing, "b*"), table, ckpt).count() == n1
    json_io.export_ndjson(raw.where(~first), os.path.join(landing, "b2"))
    assert ingest_available(spark, os.path.join(landing, "b*"), table, ckpt).count() == raw.count()


def test_build_and_test_writes_marts_results_alerts(spark, scratch):
    from dataclasses import replace

    from sessionlens.config import DEFAULT
    from sessionlens.plans.run_build import build_and_test

    out = os.path.join(scratch, "build")
    build_and_test(spark, SF0001, out, replace(DEFAULT, run_id="r1"))
    res = build_and_test(spark, SF0001, out, replace(DEFAULT, run_id="r2"))
    for name in ("fct_sessions", "funnel_conversion", "retention_cohorts", "rfm_segments", "owner_alerts"):
        assert os.path.isdir(os.path.join(out, name))
    history = spark.read.parquet(os.path.join(out, "check_results"))
    assert {r.run_id for r in history.select("run_id").distinct().collect()} == {"r1", "r2"}
    alerts = {r.check for r in res["owner_alerts"].collect()}
    assert {"assert_dq_flag_rate_under_threshold", "assert_fct_sessions_volume", "not_null_rfm_segments_user_pseudo_id"} <= alerts
    assert res["governance_gaps"].where("not compliant").count() == 0
    assert spark.sql("select count(*) as n from session_quality_flags").first().n == res["fct_sessions"].count()


def test_field_drift_reports_added_removed_changed():
    from pyspark.sql import types as T

    from sessionlens.plans.monitors import field_drift
    from sessionlens.schemas import RAW_EVENT

    observed = T.StructType(
        [f for f in RAW_EVENT.fields if f.name != "items"]
        + [T.StructField("platform", T.StringType())]
    )
    observed = T.StructType(
        [T.StructField("event_timestamp", T.StringType()) if f.name == "event_timestamp" else f for f in observed.fields]
    )
    got = {name: status for name, _, _, status in field_drift(observed, RAW_EVENT) if status != "ok"}
    items = {f"items[].{x}": "removed" for x in ("item_id", "quantity", "price_in_usd")}
    assert got == items | {"platform": "added", "event_timestamp": "type_changed"}


def test_param_key_drift_counts_new_keys(spark):
    from sessionlens.plans.monitors import param_key_drift

    rows = [
        ev("u1", 1, "page_view", "2020-11-02 10:00:00"),
        ev("u1", 1, "page_view", "2020-11-02 10:00:01",
           params=[("ga_session_id", (None, 1)), ("engagement_time_msec", (None, 5))]),
    ]
    got = {r.param_key: (r.events, r.status) for r in param_key_drift(raw_df(spark, rows)).collect()}
    assert got == {"ga_session_id": (2, "ok"), "page_location": (1, "ok"), "engagement_time_msec": (1, "new_key")}
    drift = param_key_drift(raw_df(spark, rows), ("ga_session_id", "page_referrer"))
    got = {r.param_key: (r.events, r.status) for r in drift.collect()}
    assert got["page_referrer"] == (0, "missing") and got["page_location"] == (1, "new_key")


def test_column_docs_survive_the_table_round_trip(spark):
    import __spark_entry__ as E
    from sessionlens.plans.governance import COLUMN_DOCS

    df = E.queries()["sessions_table"](spark, SF0001)
    assert df.schema["session_key"].metadata.get("comment", "") == dict((c, d) for m, c, d in COLUMN_DOCS if m == "fct_sessions")["session_key"]
    assert df.schema["did_purchase"].metadata.get("comment")


def test_landed_variant_columns(spark, scratch):
    raw = driver_tables.raw_events(spark, SF0001)
    path = os.path.join(scratch, "landed")
    json_io.export_ndjson(raw, path)
    landed = json_io.load_landed(spark, path)
    assert landed.schema["device"].dataType.simpleString() == "variant"
    assert landed.count() == raw.count()
