"""Checks measured while a model is written.

``DataFrame.observe`` puts the metrics of a model's checks into the job that
writes it: row count, nulls, values that are not accepted, flagged share. The
written table is not scanned again. The observation is the last step before the
write, so it runs in the tasks whose output is committed, and a stage that is
computed anew after a lost executor does not count twice.

``unique`` needs a grouping and stays a query over the written table. How many
different values are not accepted is only asked (of the table) when the write
has seen a row with one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionlens.plans.checks import Check, accepted_values_violations, status_of, suite_frame

KINDS = ("not_null", "accepted_values", "flag_rate", "volume")
MEASURED = ("fct_sessions", "funnel_conversion", "retention_cohorts", "rfm_segments", "session_quality_flags")
_ROWS = "rows"


@dataclass(frozen=True)
class Written:
    """A written model: its table, its rows and the failures of its checks."""

    model: str
    table: DataFrame
    rows: int
    failures: dict[str, int]


def _metric(check: Check) -> Column | None:
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return F.count_if(c.isNull())
    if check.kind == "accepted_values":
        return F.count_if(~c.isin(*check.values))
    if check.kind == "flag_rate":
        return F.avg(F.when(c, F.lit(1.0)).otherwise(F.lit(0.0)))
    return None  # volume: the row count


def _failures(check: Check, metrics: dict, table: DataFrame) -> int:
    if check.kind == "volume":
        return int(not check.low <= metrics[_ROWS] <= check.high)
    seen = metrics[check.name]
    if check.kind == "flag_rate":  # null on an empty table, which passes
        return int(seen is not None and seen > check.high)
    if check.kind == "accepted_values" and seen:
        return accepted_values_violations(table, check.column, check.values).count()
    return seen


def write_measured(df: DataFrame, path: str, model: str, suite: tuple[Check, ...], mode: str = "overwrite") -> Written:
    """Write ``df`` as the table of ``model`` and measure its checks on the way."""
    checks = [c for c in suite if c.model == model and c.kind in KINDS]
    observation = Observation(model)
    metrics = [m.alias(c.name) for c in checks if (m := _metric(c)) is not None]
    df.observe(observation, F.count(F.lit(1)).alias(_ROWS), *metrics).write.mode(mode).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    found = observation.get
    return Written(model, table, found[_ROWS], {c.name: _failures(c, found, table) for c in checks})


def results(spark: SparkSession, written: list[Written], suite: tuple[Check, ...]) -> DataFrame:
    """(check, model, row_count, failures, status): a row per measured check."""
    rows = [(w.model, w.rows, name, n) for w in written for name, n in w.failures.items()]
    found = spark.createDataFrame(rows, "model string, row_count long, check string, failures long")
    # Both tables have a row per declared check.
    specs = F.broadcast(suite_frame(spark, suite).select("check", "severity"))
    return found.join(specs, "check").select("check", "model", "row_count", "failures", status_of(F.col("failures"), F.col("severity")).alias("status"))
