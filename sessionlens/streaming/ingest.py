"""Incremental load of landed NDJSON export shards (the bulk load of S7/S8,
for an export that keeps landing new shards).

Structured Streaming's file source tracks which shards were already loaded
in its checkpoint (kept under the shared folder), so each run loads only new
shards, exactly once, and a restarted run resumes where it stopped. The sink
is the day-partitioned raw table; its ``_spark_metadata`` log makes readers
see only committed files. ``trigger(availableNow=True)`` processes what has
landed and stops, so the same code runs as a scheduled batch or, with a
processing-time trigger, continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionlens.schemas import DAY_PARTITION, RAW_EVENT

# Tasks that share one day of a micro-batch, so a large day is written by
# several of them while a task still writes few days.
DAY_SPLITS = 8


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    table_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """``max_files_per_trigger`` bounds a micro-batch if set; by default a run
    takes all that has landed in one."""
    reader = spark.readStream.schema(RAW_EVENT).option("mode", "FAILFAST")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = (
        reader.json(landing_dir)
        .withColumn(DAY_PARTITION, F.col("event_date"))
        .repartition(DAY_PARTITION, F.pmod(F.xxhash64("event_id"), F.lit(DAY_SPLITS)))
    )
    writer = (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table_dir)
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy(DAY_PARTITION)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str) -> DataFrame:
    """Load every shard that has landed and not been loaded yet; return the
    table (all loaded days)."""
    q = start_ingest(spark, landing_dir, table_dir, checkpoint_dir, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))
    from sessionlens.sources.event_days import RAW_EVENT_WITH_DAY

    return spark.read.schema(RAW_EVENT_WITH_DAY).parquet(table_dir)
