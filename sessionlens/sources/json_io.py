"""The NDJSON interchange file and semi-structured columns.

* ``export_ndjson``: raw events with real nesting as gzip NDJSON shards of at
  most ``EXPORT_SHARD_ROWS`` rows (``maxRecordsPerFile``), compact separators.
  One write job; every task writes its own shards in parallel.
* ``load_ndjson``: read with the declared schema in FAILFAST mode (abort on the
  first bad row), project and cast, as the bulk load does.
* ``to_json_columns`` / ``from_json_columns``: nested fields to JSON strings
  and back; a SQL NULL and a JSON ``null`` both come back as NULL.
* ``as_variant`` / ``variant_fields``: the second dialect's VARIANT columns
  and ``a:b::type`` paths, with ``parse_json`` and ``variant_get``.
* ``write_landed`` / ``read_landed``: the landed table itself, day-partitioned
  Parquet whose VARIANT columns are shredded, so that a path is a column chunk
  that the scan reads (and filters) by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens import config as C
from sessionlens.schemas import DAY_PARTITION, EVENT_PARAM, LANDED_EVENT, NESTED_FIELDS, RAW_EVENT


def export_ndjson(raw: DataFrame, path: str, shard_rows: int = C.EXPORT_SHARD_ROWS) -> None:
    cols = [f.name for f in RAW_EVENT.fields]
    (
        raw.select(*cols)
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", shard_rows)
        .option("ignoreNullFields", "false")
        .json(path)
    )


def load_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """gzip NDJSON is not splittable: one task per shard, so the shard size
    bounds the task size."""
    return spark.read.schema(RAW_EVENT).option("mode", "FAILFAST").json(path)


def load_landed(spark: SparkSession, path: str) -> DataFrame:
    """The NDJSON shards read as the landing table of the second warehouse:
    scalar columns typed, nested columns kept as VARIANT (schema on read)."""
    return spark.read.schema(LANDED_EVENT).option("mode", "FAILFAST").json(path)


# Session settings of the landed table's write and reads.
_SHRED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}
_PUSH = {"spark.sql.variant.allowReadingShredded": "true", "spark.sql.variant.pushVariantIntoScan": "true"}


def write_landed(landed: DataFrame, path: str) -> None:
    """The landing table, truncated and loaded: partitioned by day, VARIANT
    columns shredded by the schema found in each file's first rows (a value of
    another type stays whole beside it, so nothing is lost)."""
    spark = landed.sparkSession
    before = {k: spark.conf.get(k, None) for k in _SHRED}
    try:
        for k, v in _SHRED.items():
            spark.conf.set(k, v)
        by_day = landed.withColumn(DAY_PARTITION, F.col("event_date")).hint("rebalance", DAY_PARTITION)
        by_day.write.mode("overwrite").partitionBy(DAY_PARTITION).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_landed(spark: SparkSession, path: str, start_day: str | None = None, end_day: str | None = None) -> DataFrame:
    """Scan of the landing table; a day range prunes folders, and paths taken
    with ``variant_get`` reach the scan."""
    for k, v in _PUSH.items():
        spark.conf.set(k, v)
    schema = T.StructType([*LANDED_EVENT.fields, T.StructField(DAY_PARTITION, T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if start_day and end_day:
        df = df.where(F.col(DAY_PARTITION).between(F.lit(start_day), F.lit(end_day)))
    return df


def to_json_columns(raw: DataFrame) -> DataFrame:
    """The export query: scalar columns plus each nested column as JSON text."""
    scalar = [f.name for f in RAW_EVENT.fields if f.name not in NESTED_FIELDS]
    return raw.select(*scalar, *[F.to_json(F.col(c), {"ignoreNullFields": "false"}).alias(c) for c in NESTED_FIELDS])


def from_json_columns(exported: DataFrame) -> DataFrame:
    """Back to nested objects with the declared schema; malformed text fails
    the job."""
    types = {f.name: f.dataType for f in RAW_EVENT.fields}
    scalar = [c for c in exported.columns if c not in NESTED_FIELDS]
    return exported.select(*scalar, *[F.from_json(F.col(c), types[c], {"mode": "FAILFAST"}).alias(c) for c in NESTED_FIELDS])


def as_variant(raw: DataFrame) -> DataFrame:
    """Nested columns as VARIANT, as they land in the second warehouse."""
    scalar = [f.name for f in RAW_EVENT.fields if f.name not in NESTED_FIELDS]
    return raw.select(*scalar, *[F.parse_json(F.to_json(F.col(c))).alias(c) for c in NESTED_FIELDS])


def variant_fields(landed: DataFrame) -> DataFrame:
    """Typed paths out of the VARIANT columns (``device:category::string`` ...)."""
    return landed.select(
        "event_id",
        F.variant_get("device", "$.category", "string").alias("device_category"),
        F.variant_get("geo", "$.country", "string").alias("country"),
        F.variant_get("traffic_source", "$.medium", "string").alias("traffic_medium"),
        F.variant_get("traffic_source", "$.source", "string").alias("traffic_source"),
        F.variant_get("ecommerce", "$.purchase_revenue_in_usd", "double").alias("purchase_revenue_usd"),
    )


def variant_params(landed: DataFrame) -> DataFrame:
    """Flatten of the VARIANT params (inner: an event with an empty or NULL
    array yields no row) and the keyed values pivoted back, the largest of a
    repeated key. All params of an event are in its row, so the grouping by
    event happens there and nothing is shuffled."""
    params = F.variant_get("event_params", "$", T.ArrayType(EVENT_PARAM).simpleString())

    def largest(key: str, slot: str):
        own = F.filter("params", lambda p: p["key"] == key)
        return F.array_max(F.transform(own, lambda p: p["value"][slot]))

    return landed.select("event_id", params.alias("params")).where(F.size("params") > 0).select(
        "event_id", largest(C.PARAM_SESSION_ID, "int_value").alias("ga_session_id"), largest(C.PARAM_PAGE_LOCATION, "string_value").alias("page_location")
    )
