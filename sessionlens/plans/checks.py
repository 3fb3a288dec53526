"""Data-quality checks (Q1-Q6, Q9, Q10) and their results table.

A check is a declarative spec. ``violations`` returns the failing rows, as a
test query does; ``check_results`` runs a whole suite and returns one row per
check (run_id, check, model, column, severity, failures, status, message).
Checks on one model that need no grouping (not_null, accepted_values and
the flag-rate and volume monitors) share a single aggregation pass over that
model; ``unique`` is a grouped count with partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.operators.staging import duplicate_param_key_events, duplicate_param_keys
from sessionlens.schemas import CHECK_RESULT


@dataclass(frozen=True)
class Check:
    name: str
    model: str
    kind: str  # unique | not_null | accepted_values | flag_rate | volume | duplicate_keys
    column: str | None = None
    severity: str = "error"
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    refs: tuple[str, ...] = ()  # what it reads, in order, if that is not the model alone


def default_suite(flag_rate_max: float = C.FLAG_RATE_MAX, volume_min: int = C.VOLUME_MIN,
                  volume_max: int = C.VOLUME_MAX) -> tuple[Check, ...]:
    """The column tests and singular monitors attached to the models."""
    steps = tuple(label for _, label in C.FUNNEL_STEPS)
    return (
        Check("unique_fct_sessions_session_key", "fct_sessions", "unique", "session_key"),
        Check("not_null_fct_sessions_session_key", "fct_sessions", "not_null", "session_key"),
        Check("not_null_fct_sessions_did_purchase", "fct_sessions", "not_null", "did_purchase"),
        Check("unique_funnel_conversion_step", "funnel_conversion", "unique", "step"),
        Check("not_null_funnel_conversion_step", "funnel_conversion", "not_null", "step"),
        Check("accepted_values_funnel_conversion_step", "funnel_conversion", "accepted_values", "step", values=steps),
        Check("not_null_funnel_conversion_users", "funnel_conversion", "not_null", "users"),
        Check("not_null_retention_cohorts_active_users", "retention_cohorts", "not_null", "active_users"),
        Check("unique_rfm_segments_user_pseudo_id", "rfm_segments", "unique", "user_pseudo_id"),
        Check("not_null_rfm_segments_user_pseudo_id", "rfm_segments", "not_null", "user_pseudo_id"),
        Check("accepted_values_rfm_segments_segment", "rfm_segments", "accepted_values", "segment", values=C.SEGMENTS),
        Check("unique_session_quality_flags_session_key", "session_quality_flags", "unique", "session_key"),
        Check("not_null_session_quality_flags_session_key", "session_quality_flags", "not_null", "session_key"),
        Check("not_null_session_quality_flags_has_dq_flag", "session_quality_flags", "not_null", "has_dq_flag"),
        Check("not_null_session_quality_flags_dq_flag_count", "session_quality_flags", "not_null", "dq_flag_count"),
        Check("assert_dq_flag_rate_under_threshold", "session_quality_flags", "flag_rate", "has_dq_flag",
              severity="warn", high=flag_rate_max),
        Check("assert_fct_sessions_volume", "fct_sessions", "volume", None, severity="warn",
              low=volume_min, high=volume_max),
        Check("duplicate_param_keys_stg_ga4__events", "stg_ga4__events", "duplicate_keys", "event_params",
              refs=("source.events", "stg_ga4__events")),
    )


# ----------------------------------------------------------------- violations


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULL is ignored)."""
    c = F.col(column)
    return df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_violations(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Invalid values with their row counts (NULL passes, as in SQL NOT IN)."""
    c = F.col(column)
    return df.where(~c.isin(*values)).groupBy(c).agg(F.count(F.lit(1)).alias("n_records"))


def flag_rate(flags: DataFrame, flag_col: str = "has_dq_flag") -> DataFrame:
    """Share of flagged rows; NULL on an empty table."""
    return flags.agg(F.avg(F.when(F.col(flag_col), F.lit(1.0)).otherwise(F.lit(0.0))).alias("flag_rate"))


def flag_rate_violations(flags: DataFrame, threshold: float, flag_col: str = "has_dq_flag") -> DataFrame:
    """One row when the rate exceeds the threshold (NULL rate passes)."""
    return flag_rate(flags, flag_col).where(F.col("flag_rate") > F.lit(threshold))


def volume_violations(df: DataFrame, low: int, high: int, name: str = "session_count") -> DataFrame:
    """One row when the row count is outside [low, high]."""
    n = df.agg(F.count(F.lit(1)).alias(name))
    return n.where((F.col(name) < F.lit(low)) | (F.col(name) > F.lit(high)))


def violations(df: DataFrame, check: Check, raw: DataFrame | None = None) -> DataFrame:
    if check.kind == "unique":
        return unique_violations(df, check.column)
    if check.kind == "not_null":
        return not_null_violations(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values_violations(df, check.column, check.values)
    if check.kind == "flag_rate":
        return flag_rate_violations(df, check.high, check.column)
    if check.kind == "volume":
        return volume_violations(df, int(check.low), int(check.high))
    if check.kind == "duplicate_keys":
        return duplicate_param_keys(raw if raw is not None else df)
    raise ValueError(f"unknown check kind {check.kind!r}")


# ----------------------------------------------------------------- results


_ONE_PASS = ("not_null", "accepted_values", "flag_rate", "volume")


def _failure_agg(ch: Check) -> Column:
    """The failure count of a one-pass check, as an aggregate expression."""
    if ch.kind == "not_null":
        return F.count_if(F.col(ch.column).isNull())
    if ch.kind == "accepted_values":  # number of distinct invalid values
        c = F.col(ch.column)
        return F.count_distinct(F.when(~c.isin(*ch.values), c))
    if ch.kind == "flag_rate":  # one failing row when the rate is above the threshold
        rate = F.avg(F.when(F.col(ch.column), F.lit(1.0)).otherwise(F.lit(0.0)))
        return F.when(rate > F.lit(ch.high), F.lit(1)).otherwise(F.lit(0)).cast("long")
    if ch.kind == "volume":  # one failing row when the count is out of band
        n = F.count(F.lit(1))
        return F.when((n < F.lit(int(ch.low))) | (n > F.lit(int(ch.high))), F.lit(1)).otherwise(F.lit(0)).cast("long")
    raise ValueError(ch.kind)


def _one_pass_failures(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All one-pass checks of one model in a single aggregation over it:
    one row per check (check, failures)."""
    wide = df.agg(*[_failure_agg(ch).alias(ch.name) for ch in checks])
    stack = []
    for ch in checks:
        stack += [F.lit(ch.name), F.col(ch.name).cast("long")]
    return wide.select(F.stack(F.lit(len(checks)), *stack).alias("check", "failures"))


def _one(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")


def check_failures(models: dict[str, DataFrame], suite: tuple[Check, ...], raw: DataFrame | None = None) -> DataFrame:
    """(check, failures) for every check of the suite, as one union: one
    aggregation pass per model for the one-pass checks, a grouped count per
    ``unique`` check, and a pass over the raw events for duplicate keys."""
    parts: list[DataFrame] = []
    one_pass: dict[str, list[Check]] = {}
    for ch in suite:
        if ch.kind in _ONE_PASS:
            one_pass.setdefault(ch.model, []).append(ch)
        elif ch.kind == "duplicate_keys":
            counted = duplicate_param_key_events(raw if raw is not None else models[ch.model])
            parts.append(counted.select(F.lit(ch.name).alias("check"), "failures"))
        else:
            parts.append(_one(violations(models[ch.model], ch, raw), ch.name))
    for model, chs in one_pass.items():
        parts.append(_one_pass_failures(models[model], chs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def status_of(failures: Column, severity: Column) -> Column:
    """pass when nothing fails; otherwise 'warn' for warn-severity checks and
    'fail' for error-severity ones."""
    return (
        F.when(failures == 0, F.lit("pass"))
        .when(severity == F.lit("warn"), F.lit("warn"))
        .otherwise(F.lit("fail"))
    )


def suite_frame(spark, suite: tuple[Check, ...]) -> DataFrame:
    rows = [(c.name, c.model, c.column, c.severity) for c in suite]
    return spark.createDataFrame(rows, "check string, model string, column string, severity string")


def check_results(models: dict[str, DataFrame], suite: tuple[Check, ...], run_id: str,
                  raw: DataFrame | None = None, measured: dict[str, int] | None = None) -> DataFrame:
    """One row per check. Checks that a write has ``measured`` (plans/observed.py)
    are taken as they are; the others run over the models."""
    measured = measured or {}
    open_suite = tuple(c for c in suite if c.name not in measured)
    failures = check_failures(models, open_suite, raw) if open_suite else None
    if measured:
        spark = next(iter(models.values())).sparkSession
        known = spark.createDataFrame(list(measured.items()), "check string, failures long")
        failures = known if failures is None else failures.unionByName(known)
    # The suite table has one row per declared check: a bounded broadcast.
    specs = F.broadcast(suite_frame(failures.sparkSession, suite))
    joined = failures.join(specs, "check")
    out = joined.select(
        F.lit(run_id).alias("run_id"),
        "check",
        "model",
        "column",
        "severity",
        F.col("failures").cast("long").alias("failures"),
        status_of(F.col("failures"), F.col("severity")).alias("status"),
        F.format_string("%d failing rows", F.col("failures")).alias("message"),
    )
    return out.select(*[f.name for f in CHECK_RESULT.fields])


def flags_keep_rows(sessions: DataFrame, flags: DataFrame) -> DataFrame:
    """Q9: the flags model keeps every input row."""
    side = F.col("side")
    both = sessions.select(F.lit(1).alias("side")).unionByName(flags.select(F.lit(2).alias("side")))
    counts = both.agg(F.count_if(side == 1).alias("input_rows"), F.count_if(side == 2).alias("output_rows"))
    return counts.withColumn("rows_kept", F.col("input_rows") == F.col("output_rows"))
