
from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.build import Build
from sessionlens.catalog import query
from sessionlens.operators import funnel, retention, rfm, sessions, staging
from sessionlens.plans import checks as CK
from sessionlens.plans import governance as GV
from sessionlens.plans import lineage as LN
from sessionlens.plans import monitors as MN
from sessionlens.plans import observed as OB
from sessionlens.plans import reports as RP
from sessionlens.plans.reconcile import reconcile_rows
from sessionlens.plans.run_build import register_views
from sessionlens.plans.schema_history import schema_history
from sessionlens.functions import (
    micros_to_ts,
    param_value,
    parse_event_day,
    week_start,
    week_start_iso,
    weeks_between,
)
from sessionlens.config import PARAM_PAGE_LOCATION, PARAM_SESSION_ID, replace
from sessionlens.runtime import materialize, table_path
from sessionlens.schemas import CHECK_RESULT
from sessionlens.sources import driver_tables, event_days, json_io
from sessionlens.sources.publish import publish

# ---------------------------------------------------------------- models (M1-M6)


@query("stg_events")
def q_stg_events(b: Build) -> DataFrame:
    """M1: flattened, typed events with a session id."""
    return b.staged


@query("fct_sessions")
def q_fct_sessions(b: Build) -> DataFrame:
    """M2: one row per (user, session)."""
    return b.sessions


@query("funnel_conversion")
def q_funnel_conversion(b: Build) -> DataFrame:
    """Four-step user funnel."""
    return b.funnel


@query("retention_cohorts")
def q_retention_cohorts(b: Build) -> DataFrame:
    """M4: weekly cohort x weeks-since active users."""
    return b.retention


@query("rfm_segments")
def q_rfm_segments(b: Build) -> DataFrame:
    """M5: RFM scores and segment per purchasing user."""
    return b.rfm


@query("session_quality_flags")
def q_session_quality_flags(b: Build) -> DataFrame:
    """M6: four flags per session, no row dropped."""
    return b.flags


# ---------------------------------------------------------------- sources

_RAW_SCALARS = ("event_id", "event_date", "event_timestamp", "event_name", "user_pseudo_id")


@query("scan_event_days")
def q_scan_event_days(b: Build) -> DataFrame:
    """Write the raw export partitioned by day, then scan it with a
    day range that becomes a partition filter."""
    path = table_path(b.spark, "raw_events_by_day")
    event_days.write_event_days(driver_tables.raw_events(b.spark, b.sf_dir), path)
    days = event_days.read_event_days(b.spark, path, b.params.start_day, b.params.end_day)
    return days.select("event_day", *_RAW_SCALARS, F.col("device.category").alias("device_category"))


@query("export_events_json")
def q_export_events_json(b: Build) -> DataFrame:
    """Gzip NDJSON shards with real nesting; read back as text and
    parsed with the declared schema."""
    path = table_path(b.spark, "export_ndjson")
    json_io.export_ndjson(b.raw, path)
    lines = b.spark.read.text(path)
    parsed = lines.select(F.from_json("value", json_io.RAW_EVENT, {"mode": "FAILFAST"}).alias("e")).select("e.*")
    return parsed.select(
        *_RAW_SCALARS,
        F.size("event_params").alias("n_params"),
        F.col("device.category").alias("device_category"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
    )


@query("load_raw_events")
def q_load_raw_events(b: Build) -> DataFrame:
    """Bulk load of the NDJSON shards (declared schema, FAILFAST)
    into the day-partitioned table, first with the days of the first half of
    the window; then the table is truncated and reloaded with the whole window,
    and staged."""
    p = b.params
    early = b.raw.where(F.col("event_date") <= F.lit(_mid_day(p.start_day, p.end_day)))
    dst = _loaded(b, early, "raw_events_loaded")
    days = _loaded(b, b.raw, "raw_events_loaded", dst)
    return staging.stage_events(event_days.read_event_days(b.spark, days), p.start_day, p.end_day, day_col="event_day")


def _loaded(b: Build, raw: DataFrame, name: str, path: str | None = None) -> str:
    """The raw events exported and bulk-loaded into a table (truncated first)."""
    shards = table_path(b.spark, "export_ndjson")
    json_io.export_ndjson(raw, shards)
    path = path or table_path(b.spark, name)
    event_days.write_event_days(json_io.load_ndjson(b.spark, shards), path, dynamic=False)
    return path


@query("json_roundtrip")
def q_json_roundtrip(b: Build) -> DataFrame:
    """Nested columns to JSON text and back; NULL stays NULL."""
    back = json_io.from_json_columns(json_io.to_json_columns(b.raw))
    return back.select(
        "event_id",
        param_value(PARAM_SESSION_ID, "int_value").alias("ga_session_id"),
        param_value(PARAM_PAGE_LOCATION, "string_value").alias("page_location"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
        F.size("items").alias("n_items"),
    )


@query("raw_row_count")
def q_raw_row_count(b: Build) -> DataFrame:
    """Rows of the loaded table, counted after the load."""
    return event_days.row_count(event_days.read_event_days(b.spark, _loaded(b, b.raw, table_path(b.spark, "raw_events_counted"))))


@query("preview_rows")
def q_preview_rows(b: Build) -> DataFrame:
    """First five events by time (a limit that is the feature)."""
    return event_days.preview(b.raw, 5)


@query("sessions_table")
def q_sessions_table(b: Build) -> DataFrame:
    """Sessions materialised once as a Parquet table with its
    column docs as schema comments, read back."""
    return materialize(GV.document(b.sessions, "fct_sessions"), "fct_sessions")


# ---------------------------------------------------------------- projections (P)


def _landed(b: Build) -> DataFrame:
    """S3: the export shards landed as a table with VARIANT nested columns."""
    shards, path = table_path(b.spark, "landed_ndjson"), table_path(b.spark, "landed_events")
    json_io.export_ndjson(b.raw, shards)
    json_io.write_landed(json_io.load_landed(b.spark, shards), path)
    return json_io.read_landed(b.spark, path, b.params.start_day, b.params.end_day)


@query("variant_paths")
def q_variant_paths(b: Build) -> DataFrame:
    """Typed paths out of the landed table's VARIANT columns."""
    return json_io.variant_fields(_landed(b))


@query("flatten_params_variant")
def q_flatten_params_variant(b: Build) -> DataFrame:
    """J2/F16 on landed VARIANT: params unnested and grouped inside the row."""
    return json_io.variant_params(_landed(b))


@query("day_flags_view")
def q_day_flags_view(b: Build) -> DataFrame:
    """The staging and flags views, joined and grouped in SQL with named
    parameters: events, sessions and flagged sessions for each day."""
    models = Build(b.spark, b.sf_dir, b.params, materialize_sessions=True).models()
    names = register_views(models, suffix=f"_{uuid.uuid4().hex[:8]}")
    return b.spark.sql(
        f"""
        select f.session_date, e.events, f.sessions, f.flagged, f.flagged > :most_flagged as above
        from (
            select session_date, count(*) as sessions, count_if(has_dq_flag) as flagged
            from {names["session_quality_flags"]} where session_date >= :first group by session_date
        ) f join (
            select event_date, count(*) as events from {names["stg_ga4__events"]} where event_date >= :first group by event_date
        ) e on e.event_date = f.session_date
        """,
        args={"first": datetime.strptime(b.params.start_day, "%Y%m%d").date(), "most_flagged": 10},
    )


@query("param_lookup")
def q_param_lookup(b: Build) -> DataFrame:
    """Keyed lookup in the params array."""
    return b.raw.select(
        "event_id",
        param_value(PARAM_SESSION_ID, "int_value").alias("ga_session_id"),
        param_value(PARAM_PAGE_LOCATION, "string_value").alias("page_location"),
    )


@query("null_session_guard")
def q_null_session_guard(b: Build) -> DataFrame:
    """Events before and after the session-id guard."""
    tagged = b.raw.select(param_value(PARAM_SESSION_ID, "int_value").isNotNull().alias("kept"))
    return tagged.agg(
        F.count(F.lit(1)).alias("raw_events"),
        F.count_if(F.col("kept")).alias("staged_events"),
        F.count_if(~F.col("kept")).alias("dropped_events"),
    )


@query("rfm_scored")
def q_rfm_scored(b: Build) -> DataFrame:
    """The three quintile scores."""
    return b.rfm_scored


@query("rfm_purchases")
def q_rfm_purchases(b: Build) -> DataFrame:
    """Purchasing sessions with revenue."""
    return rfm.rfm_purchases(b.core)


@query("volume_monitor")
def q_volume_monitor(b: Build) -> DataFrame:
    """A row when the session count is out of band."""
    return CK.volume_violations(b.core, b.params.volume_min, b.params.volume_max)


@query("dq_flag_count")
def q_dq_flag_count(b: Build) -> DataFrame:
    """Sessions by number of rules broken."""
    return b.flags.groupBy("dq_flag_count", "has_dq_flag").agg(F.count(F.lit(1)).alias("sessions"))


@query("funnel_steps")
def q_funnel_steps(b: Build) -> DataFrame:
    """The four counts as four rows."""
    return funnel.funnel_steps(b.core)


# ---------------------------------------------------------------- joins / lateral (J)


@query("cohort_activity")
def q_cohort_activity(b: Build) -> DataFrame:
    """Every active (user, week) with the user's cohort."""
    p = b.params
    return retention.cohort_activity(b.core, (p.start_day, p.end_day)).select(
        "user_pseudo_id", "cohort_week", "active_week", "weeks_since"
    )


@query("flatten_params")
def q_flatten_params(b: Build) -> DataFrame:
    """The params unnested and grouped inside the row."""
    p = b.params
    return staging.flatten_params(b.raw, p.start_day, p.end_day)


def _checked(b: Build) -> DataFrame:
    """Check results of the whole suite; the sessions table is written once
    and every model reads it."""
    mat = Build(b.spark, b.sf_dir, b.params, materialize_sessions=True)
    p = b.params
    suite = CK.default_suite(p.flag_rate_max, p.volume_min, p.volume_max)
    return CK.check_results(mat.models(), suite, p.run_id, raw=mat.raw)


@query("owner_alerts")
def q_owner_alerts(b: Build) -> DataFrame:
    """Failing and warning checks attributed to the model owner."""
    results = _checked(b)
    return GV.owner_alerts(results, GV.model_registry(b.spark))


@query("alert_digest")
def q_alert_digest(b: Build) -> DataFrame:
    """Q7 output: alert count and digest text of the run."""
    return GV.alert_digest(GV.owner_alerts(_checked(b), GV.model_registry(b.spark)))


def _edges(b: Build) -> DataFrame:
    p = b.params
    return LN.edges(b.spark, CK.default_suite(p.flag_rate_max, p.volume_min, p.volume_max))


@query("alert_impact")
def q_alert_impact(b: Build) -> DataFrame:
    """Open checks attributed through the reference edges, with all
    models downstream and their owners."""
    return LN.alert_impact(_checked(b), _edges(b), GV.model_registry(b.spark))


@query("model_lineage")
def q_model_lineage(b: Build) -> DataFrame:
    """What each model is built from and the open checks above it."""
    return LN.model_lineage(_checked(b), _edges(b), GV.model_registry(b.spark))


@query("governance_gaps")
def q_governance_gaps(b: Build) -> DataFrame:
    """Governed models, what each misses and which of its checks fail."""
    return GV.governance_gaps(GV.model_registry(b.spark), _checked(b))


@query("check_history")
def q_check_history(b: Build) -> DataFrame:
    """Q6 over runs: the suite on the first half of the window, then on all of
    it, appended to one results table; per check its runs, failing runs, last
    status and whether that is new."""
    p = b.params
    path = table_path(b.spark, "check_history")
    for k, end in enumerate((_mid_day(p.start_day, p.end_day), p.end_day), 1):
        run = Build(b.spark, b.sf_dir, replace(p, end_day=end, run_id=f"run-{k:04d}"))
        _checked(run).write.mode("append").partitionBy("run_id").parquet(path)
    return GV.check_history(b.spark.read.schema(CHECK_RESULT).parquet(path))


# ---------------------------------------------------------------- aggregates (A)


@query("session_attributes")
def q_session_attributes(b: Build) -> DataFrame:
    """A5: deterministic any_value per session."""
    return sessions.session_attributes(b.staged)


@query("funnel_per_user")
def q_funnel_per_user(b: Build) -> DataFrame:
    """Steps reached per user."""
    return funnel.funnel_per_user(b.core)


@query("rfm_user")
def q_rfm_user(b: Build) -> DataFrame:
    """Recency, frequency, monetary per user."""
    return rfm.rfm_user(b.core, b.params.as_of)


@query("funnel_counts")
def q_funnel_counts(b: Build) -> DataFrame:
    """Users per step, one row."""
    return funnel.funnel_counts(b.core)


@query("dq_flag_rate")
def q_dq_flag_rate(b: Build) -> DataFrame:
    """Share of flagged sessions."""
    return CK.flag_rate(b.flags)


@query("segment_summary")
def q_segment_summary(b: Build) -> DataFrame:
    """Users and mean revenue per segment."""
    return RP.segment_summary(b.rfm)


@query("weekly_activity")
def q_weekly_activity(b: Build) -> DataFrame:
    """Distinct (user, active week)."""
    return retention.weekly_activity(b.core)


# ---------------------------------------------------------------- scalar functions (F)


@query("session_key")
def q_session_key(b: Build) -> DataFrame:
    """NULL-propagating concat of user and cast session id."""
    return b.core.select("user_pseudo_id", "ga_session_id", "session_key")


@query("event_time")
def q_event_time(b: Build) -> DataFrame:
    """micros to timestamp, yyyyMMdd to date."""
    return b.raw.select(
        "event_id",
        "event_timestamp",
        micros_to_ts("event_timestamp").alias("event_ts"),
        "event_date",
        parse_event_day("event_date").alias("event_day"),
    )


@query("week_start")
def q_week_start(b: Build) -> DataFrame:
    """Monday of the week, by truncation and by ISO weekday."""
    days = b.core.select("session_date").distinct()
    return days.select(
        "session_date",
        week_start("session_date").alias("week_trunc"),
        week_start_iso("session_date").alias("week_iso"),
    )


@query("weeks_between")
def q_weeks_between(b: Build) -> DataFrame:
    """whole weeks between a user's first and last active Monday."""
    per_user = b.core.groupBy("user_pseudo_id").agg(
        week_start(F.min("session_date")).alias("first_week"), week_start(F.max("session_date")).alias("last_week")
    )
    return per_user.withColumn("weeks_span", weeks_between("last_week", "first_week"))


@query("retention_matrix")
def q_retention_matrix(b: Build) -> DataFrame:
    """Cohort x week matrix; missing cells NULL."""
    return RP.retention_matrix(b.retention, b.params.retention_weeks)


# ---------------------------------------------------------------- checks (Q)


def _suite(b: Build, kind: str):
    p = b.params
    return tuple(c for c in CK.default_suite(p.flag_rate_max, p.volume_min, p.volume_max) if c.kind == kind)


def _kind_results(b: Build, kind: str) -> DataFrame:
    mat = Build(b.spark, b.sf_dir, b.params, materialize_sessions=True)
    res = CK.check_results(mat.models(), _suite(b, kind), b.params.run_id)
    return res.select("check", "model", "column", "failures", "status")


@query("check_unique")
def q_check_unique(b: Build) -> DataFrame:
    """Q1: unique(column) tests of the suite."""
    return _kind_results(b, "unique")


@query("check_not_null")
def q_check_not_null(b: Build) -> DataFrame:
    """Q2: not_null(column) tests of the suite."""
    return _kind_results(b, "not_null")


@query("check_accepted_values")
def q_check_accepted_values(b: Build) -> DataFrame:
    """Q3: accepted_values(column, list) tests of the suite."""
    return _kind_results(b, "accepted_values")


@query("flag_rate_monitor")
def q_flag_rate_monitor(b: Build) -> DataFrame:
    """Q4: a row when the flagged share exceeds the threshold."""
    return CK.flag_rate_violations(b.flags, b.params.flag_rate_max)


@query("check_results")
def q_check_results(b: Build) -> DataFrame:
    """Q6: one result row per check of the run."""
    return _checked(b)


@query("write_checks")
def q_write_checks(b: Build) -> DataFrame:
    """Row counts and checks measured by the jobs that write the
    models, without another scan."""
    p = b.params
    suite = CK.default_suite(p.flag_rate_max, p.volume_min, p.volume_max)
    sessions_ = OB.write_measured(b.sessions, table_path(b.spark, "fct_sessions"), "fct_sessions", suite)
    mat = Build(b.spark, b.sf_dir, p)
    mat.sessions = mat.core = sessions_.table
    written = [sessions_] + [
        OB.write_measured(df, table_path(b.spark, name), name, suite) for name, df in mat.models().items() if name in OB.MEASURED and name != "fct_sessions"
    ]
    return OB.results(b.spark, written, suite)


@query("flags_keep_rows")
def q_flags_keep_rows(b: Build) -> DataFrame:
    """Q9: the flags model keeps every session; both sides read one written
    sessions table."""
    mat = Build(b.spark, b.sf_dir, b.params, materialize_sessions=True)
    return CK.flags_keep_rows(mat.sessions, mat.flags)


@query("duplicate_param_keys")
def q_duplicate_param_keys(b: Build) -> DataFrame:
    """Q10: events in which a looked-up param key repeats."""
    from sessionlens.functions import param_key_count

    n = F.greatest(param_key_count(PARAM_SESSION_ID), param_key_count(PARAM_PAGE_LOCATION))
    return b.raw.select(n.alias("n")).agg(
        F.count(F.lit(1)).alias("events_checked"), F.count_if(F.col("n") > 1).alias("events_with_duplicate_keys")
    )


@query("model_registry")
def q_model_registry(b: Build) -> DataFrame:
    """Q11: model metadata with current row counts and documented columns."""
    mat = Build(b.spark, b.sf_dir, b.params, materialize_sessions=True)
    return GV.registry_with_volume(GV.model_registry(b.spark), mat.models())


# ---------------------------------------------------------------- reports (R)


@query("retention_pct")
def q_retention_pct(b: Build) -> DataFrame:
    """Retention as % of the cohort's week-0 users."""
    return RP.retention_pct(b.retention)


@query("funnel_kpi")
def q_funnel_kpi(b: Build) -> DataFrame:
    """Overall view-to-purchase conversion."""
    return RP.funnel_kpi(b.funnel)


@query("segment_table")
def q_segment_table(b: Build) -> DataFrame:
    """Count, mean monetary, mean frequency per segment."""
    return RP.segment_table(b.rfm)


@query("rfm_scatter")
def q_rfm_scatter(b: Build) -> DataFrame:
    """Scatter data per user."""
    return RP.rfm_scatter(b.rfm)


@query("biggest_leak")
def q_biggest_leak(b: Build) -> DataFrame:
    """Lowest step-over-step conversion."""
    return RP.biggest_leak(b.funnel)


@query("week1_retention")
def q_week1_retention(b: Build) -> DataFrame:
    """Week-1 retention per cohort, steepest drop first."""
    return RP.week1_retention(b.retention)


# ---------------------------------------------------------------- monitors (D)


@query("build_reconciliation")
def q_build_reconciliation(b: Build) -> DataFrame:
    """Sessions from the keyed lookup vs. from explode + GROUP BY ALL."""
    p = b.params
    other = sessions.build_sessions(staging.flatten_params(b.raw, p.start_day, p.end_day))
    return MN.build_reconciliation(b.sessions, other)


@query("reconcile_sessions")
def q_reconcile_sessions(b: Build) -> DataFrame:
    """D1, row by row: the sessions that differ between the two builds and the
    columns in which they do."""
    p = b.params
    other = sessions.build_sessions(staging.flatten_params(b.raw, p.start_day, p.end_day))
    return reconcile_rows(b.sessions, other, ["user_pseudo_id", "ga_session_id"])


@query("funnel_monotonic")
def q_funnel_monotonic(b: Build) -> DataFrame:
    """Funnel steps larger than the previous step."""
    return RP.funnel_monotonic(b.funnel)


@query("daily_volume_anomaly")
def q_daily_volume_anomaly(b: Build) -> DataFrame:
    """D3: daily sessions against the median and spread of their weekday."""
    return MN.daily_volume_anomaly(b.core, b.params.start_day, b.params.end_day)


@query("freshness_check")
def q_freshness_check(b: Build) -> DataFrame:
    """Age of the newest session at each day's end, against its history."""
    p = b.params
    return MN.freshness_check(b.core, p.start_day, p.end_day, MN.run_time_after(p.as_of))


@query("schema_drift")
def q_schema_drift(b: Build) -> DataFrame:
    """Param keys present in the data vs. the declared keys."""
    return MN.param_key_drift(b.raw)


@query("field_drift")
def q_field_drift(b: Build) -> DataFrame:
    """Leaf fields of the landed files, as inferred from all their rows,
    vs. the declared schema."""
    path = table_path(b.spark, "export_ndjson")
    json_io.export_ndjson(b.raw, path)
    observed = b.spark.read.json(path).schema
    rows = MN.field_drift(observed, json_io.RAW_EVENT)  # a row per field
    return b.spark.createDataFrame(rows, "field string, declared string, observed string, status string")


@query("schema_history")
def q_schema_history(b: Build) -> DataFrame:
    """Paths of the landed table with the days they were seen and what
    changed."""
    return schema_history(_landed(b))


# ---------------------------------------------------------------- incremental load


@query("incremental_load")
def q_incremental_load(b: Build) -> DataFrame:
    """S7/S8 incrementally: export shards land in two batches; a streaming
    file source loads each batch once into the day-partitioned table."""
    from sessionlens.streaming.ingest import ingest_available

    landing = table_path(b.spark, "landing")
    table = table_path(b.spark, "raw_events_stream")
    ckpt = table_path(b.spark, "raw_events_stream_ckpt")
    raw = b.raw
    first_half = F.col("event_date") <= F.lit(_mid_day(b.params.start_day, b.params.end_day))
    json_io.export_ndjson(raw.where(first_half), f"{landing}/b1")
    ingest_available(b.spark, f"{landing}/b*", table, ckpt)
    json_io.export_ndjson(raw.where(~first_half), f"{landing}/b2")
    loaded = ingest_available(b.spark, f"{landing}/b*", table, ckpt)
    p = b.params
    return staging.stage_events(loaded, p.start_day, p.end_day, day_col="event_day")


def _mid_day(start_day: str, end_day: str) -> str:
    from datetime import datetime

    a = datetime.strptime(start_day, "%Y%m%d")
    z = datetime.strptime(end_day, "%Y%m%d")
    return (a + (z - a) / 2).strftime("%Y%m%d")
