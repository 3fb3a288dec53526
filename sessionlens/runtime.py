"""Session settings, the shared folder, and written tables.

Lineage is cut only with ``DataFrame.checkpoint()`` or a Parquet table written
under the folder the cluster names in ``spark.checkpoint.dir``; both survive
the loss of an executor. A machine-local folder is used only in local mode
when that setting is absent (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CKPT_CONF = "spark.checkpoint.dir"
_WRITTEN: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on; safe to call repeatedly."""
    # Timestamps are UTC instants (the export's event_timestamp is epoch micros).
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return _root_of(current)
    configured = sc.getConf().get(_CKPT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{_CKPT_CONF} is not set: name a folder on shared storage so that "
            "checkpoints and written tables survive executor loss"
        )
    local = tempfile.mkdtemp(prefix="sessionlens-ckpt-")
    sc.setCheckpointDir(local)
    return local


def _root_of(checkpoint_dir: str) -> str:
    # SparkContext appends a random sub-folder to the configured directory.
    return checkpoint_dir.rstrip("/").rsplit("/", 1)[0]


def table_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A path for a written table under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = f"{base}/sessionlens/{leaf}"
    if unique:
        _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used for the marts the reference materialises as tables: the sessions
    table is computed once and then read by every consumer."""
    spark = df.sparkSession
    path = table_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def written_tables() -> list[str]:
    """Folders given out by ``table_path`` in this driver process."""
    return list(_WRITTEN)


def drop_tables(spark: SparkSession, keep: int = 0) -> None:
    """Delete the materialised tables but the first ``keep``, once nothing reads
    them any more (the end of a build). Folders of other sessions are never
    touched."""
    while len(_WRITTEN) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that queries write inside the block are deleted at its end; what
    the block returns has to be written or collected by then."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        drop_tables(spark, keep=before)


# Settings for the cluster target (~100 TB of raw events, ~1000 executors).
# AQE sizes shuffle partitions from map-output statistics, so the initial
# partition count only has to be high enough for the largest shuffle (the
# session rollup over raw events); skewed partitions of joins are split.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # No broadcast from a plan-time size estimate; the code marks the tables
    # that are bounded by construction, and AQE may still broadcast a side
    # whose measured (post-shuffle) size is small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "sessionlens", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings used by tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SESSIONLENS_DRIVER_MEMORY", "8g"))
    )
    return configure(builder.getOrCreate())
