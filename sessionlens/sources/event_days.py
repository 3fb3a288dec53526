"""Day-partitioned raw event dataset.

On disk the raw export is Parquet partitioned by ``event_day`` (yyyyMMdd, the
day shard). Reading it with the declared schema and a range on the partition
column prunes whole directories (``PartitionFilters`` in the plan); nested
leaves such as ``device.category`` are pruned by the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.schemas import DAY_PARTITION, RAW_EVENT

RAW_EVENT_WITH_DAY = T.StructType(RAW_EVENT.fields + [T.StructField(DAY_PARTITION, T.StringType())])


def write_event_days(raw: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = True) -> None:
    """Write raw events partitioned by day. With ``dynamic`` overwrite only
    the days present in ``raw`` are replaced (an idempotent reload of those
    days) and other days stay; without it the whole table is replaced
    (truncate and reload). Rows are rebalanced by day: each task writes few
    files, and AQE splits a large day over several tasks."""
    (
        raw.withColumn(DAY_PARTITION, F.col("event_date"))
        .hint("rebalance", DAY_PARTITION)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(DAY_PARTITION)
        .parquet(path)
    )


def read_event_days(spark: SparkSession, path: str, start_day: str | None = None, end_day: str | None = None) -> DataFrame:
    """Scan the dataset with the declared schema (the day column typed as a
    string, so the inclusive string range is a partition filter)."""
    df = spark.read.schema(RAW_EVENT_WITH_DAY).parquet(path)
    if start_day and end_day:
        df = df.where(F.col(DAY_PARTITION).between(F.lit(start_day), F.lit(end_day)))
    return df


def row_count(raw: DataFrame) -> DataFrame:
    """Rows loaded."""
    return raw.agg(F.count(F.lit(1)).alias("raw_events"))


def preview(raw: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` events by time (event id breaks ties), scalar
    columns only. ``orderBy().limit()`` plans as a top-k per task."""
    return raw.select("event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id").orderBy(
        "event_timestamp", "event_id"
    ).limit(n)
