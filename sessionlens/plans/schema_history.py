"""Schema changes over time (D5), from the landed VARIANT table.

The schema is an aggregate: ``schema_of_variant_agg`` folds the nested values of
a day to one schema, with partial aggregation, and params are folded by their
key as well, so a new param key is a new path. Each (prefix, schema) pair is
taken apart into leaf paths once; what is sent to the driver for that are the
distinct schemas, at most one for each day and prefix.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens import config as C
from sessionlens.plans.monitors import leaves
from sessionlens.runtime import materialize
from sessionlens.schemas import DAY_PARTITION, NESTED_FIELDS, RAW_EVENT

_NUMBERS = ("bigint", "int", "smallint", "tinyint", "double", "float", "decimal")
# Slots of the declared params.
DECLARED_PARAMS = (f"event_params[{C.PARAM_SESSION_ID}].int_value", f"event_params[{C.PARAM_PAGE_LOCATION}].string_value")


def declared_paths() -> list[str]:
    return [*leaves(RAW_EVENT), *DECLARED_PARAMS]


def leaf_types(schema: str) -> dict[str, str]:
    """Leaf paths (relative; '' for a bare value) of a variant schema text with
    their kinds of type; all numbers are one kind, as JSON does not tell them
    apart. Places that only ever hold null have none."""
    ddl = re.sub(r"\bOBJECT<>", "VOID", schema)
    parsed = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", ddl))
    found = leaves(parsed) if isinstance(parsed, (T.StructType, T.ArrayType)) else {"": parsed.simpleString()}
    kinds = {p: "number" if t.split("(")[0] in _NUMBERS else t for p, t in found.items()}
    return {p: t for p, t in kinds.items() if t != "void"}


def _joined(prefix: str, path: str) -> str:
    return prefix + path if not path or path.startswith("[]") else f"{prefix}.{path}"


def observed_schemas(landed: DataFrame, day: str = "event_date") -> DataFrame:
    """(day, prefix, schema) of each column and each param key per day."""
    scalar = [f for f in landed.schema.fields if f.name not in (*NESTED_FIELDS, DAY_PARTITION)]
    folded = [F.expr(f"schema_of_variant_agg({c})").alias(c) for c in NESTED_FIELDS]
    folded += [F.when(F.count(f.name) > 0, F.lit(f.dataType.simpleString().upper())).otherwise("VOID").alias(f"_{f.name}") for f in scalar]
    wide = landed.groupBy(F.col(day).alias("day")).agg(*folded)
    pairs = [x for c in NESTED_FIELDS for x in (F.lit(c), F.col(c))] + [x for f in scalar for x in (F.lit(f.name), F.col(f"_{f.name}"))]
    columns = wide.select("day", F.stack(F.lit(len(pairs) // 2), *pairs).alias("prefix", "schema"))
    # Inner: an event with an empty or null array has no params.
    keyed = landed.sparkSession.sql(
        f"""
        select day, concat('event_params[', key, ']') as prefix, schema_of_variant_agg(value) as schema
        from (
            select l.{day} as day, variant_get(p.value, '$.key', 'string') as key, variant_get(p.value, '$.value', 'variant') as value
            from {{landed}} l, lateral variant_explode(l.event_params) p
        ) where key is not null group by day, key
        """,
        landed=landed.select(day, "event_params"),
    )
    return columns.unionByName(keyed)


def schema_history(landed: DataFrame, declared: list[str] | None = None, day: str = "event_date") -> DataFrame:
    """Every leaf path seen with a value: its types, the first and last day it
    was seen, on how many days, whether it is declared, and what changed in the
    course of the days ('added' after the first day, 'gone' before the last,
    'type changed'). Declared paths never seen come with no days and 'missing'."""
    spark = landed.sparkSession
    # A row per distinct schema, with its days (bounded by the calendar). It is
    # read twice, so it is written once.
    seen = materialize(observed_schemas(landed, day).groupBy("prefix", "schema").agg(F.collect_set("day").alias("on")), "schema_days")
    pairs = [(r.prefix, r.schema) for r in seen.select("prefix", "schema").collect()]
    rows = [(x, s, _joined(x, p), t) for x, s in pairs for p, t in leaf_types(s).items()]
    leaf = spark.createDataFrame(rows, "prefix string, schema string, path string, type string")
    days = seen.join(F.broadcast(leaf), ["prefix", "schema"]).select("path", "type", F.explode("on").alias("day"))
    paths = days.groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("types"), F.count_distinct("type").alias("n_types"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_distinct("day").alias("days"),
    )
    known = spark.createDataFrame([(p,) for p in (declared_paths() if declared is None else declared)], "declared_path string")
    both = paths.join(known, paths["path"] == known["declared_path"], "full_outer")
    whole = Window.partitionBy()  # a row per path
    begun, ended = F.min("first_day").over(whole), F.max("last_day").over(whole)
    change = F.concat_ws(
        ", ", F.when(F.col("path").isNull(), F.lit("missing")), F.when(F.col("first_day") > begun, F.lit("added")),
        F.when(F.col("last_day") < ended, F.lit("gone")), F.when(F.col("n_types") > 1, F.lit("type changed")),
    )
    return both.select(
        F.coalesce("path", "declared_path").alias("path"), "types", "first_day", "last_day", F.coalesce("days", F.lit(0)).cast("long").alias("days"),
        F.col("declared_path").isNotNull().alias("declared"), F.when(change == "", F.lit("none")).otherwise(change).alias("change"),
    )
