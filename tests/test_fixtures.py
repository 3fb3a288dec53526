"""Hand-made nested rows with literal expected output (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

from conftest import ev, raw_df
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.operators import funnel, quality_flags, retention, rfm, sessions, staging
from sessionlens.plans import checks as CK
from sessionlens.plans import governance as GV
from sessionlens.sources import json_io

WIN = (C.REFERENCE_START_DAY, C.REFERENCE_END_DAY)


def staged_of(spark, rows, window=WIN):
    return staging.stage_events(raw_df(spark, rows), *window)


def sessions_of(spark, rows):
    return sessions.build_sessions(staged_of(spark, rows))


def sess(user, sid, date, view=False, cart=False, checkout=False, purchase=False, revenue=None):
    """A session row for the mart-level fixtures (only the columns used)."""
    return (user, sid, f"{user}-{sid}", date, view, cart, checkout, purchase, revenue)


SESS_SCHEMA = (
    "user_pseudo_id string, ga_session_id long, session_key string, session_date date, did_view_item boolean, "
    "did_add_to_cart boolean, did_begin_checkout boolean, did_purchase boolean, revenue_usd double"
)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


# --------------------------------------------------------------- staging (1-8)


def test_staging_guard_and_lookup(spark):
    rows = [
        ev("u1", None, "page_view", "2020-11-02 10:00:00"),  # 1: no session id
        ev("u1", None, "page_view", "2020-11-02 10:00:01", params=[("ga_session_id", ("77", None))]),  # 2
        ev("u1", None, "page_view", "2020-11-02 10:00:02", params=[]),  # 3: empty params
        ev("u1", None, "page_view", "2020-11-02 10:00:03", params=None, page=None),  # 3: no params at all
        ev("u1", 5, "page_view", "2020-11-02 10:00:04", page=None),  # 4: no page_location
        ev("u1", 6, "page_view", "2020-11-02 10:00:05",
           params=[("ga_session_id", (None, 6)), ("ga_session_id", (None, 7))]),  # 5: key twice
    ]
    raw = raw_df(spark, rows).withColumn(
        "event_params", F.when(F.col("event_timestamp") % 10_000_000 == 3_000_000, F.lit(None)).otherwise(F.col("event_params"))
    )
    out = staging.stage_events(raw, *WIN).orderBy("event_ts").collect()
    assert [(r.ga_session_id, r.page_location) for r in out] == [(5, None), (6, None)]
    dups = staging.duplicate_param_keys(raw).collect()
    assert len(dups) == 1 and dups[0]["n_ga_session_id"] == 2


def test_identical_events_both_kept(spark):
    e = ev("u1", 1, "page_view", "2020-11-02 10:00:00", event_id=100)
    e2 = ev("u1", 1, "page_view", "2020-11-02 10:00:00", event_id=101)
    s = sessions_of(spark, [e, e2]).collect()
    assert len(s) == 1 and s[0].page_views == 2  # 6


def test_shard_window(spark):
    rows = [ev("u1", 1, "page_view", f"{x[:4]}-{x[4:6]}-{x[6:]} 12:00:00", day=x)
            for x in ("20201031", "20201101", "20210131", "20210201")]
    days = sorted(r.event_date.strftime("%Y%m%d") for r in staged_of(spark, rows).collect())
    assert days == ["20201101", "20210131"]  # 7


def test_session_date_is_export_day(spark):
    # 8: timestamp past midnight UTC, export day the day before
    rows = [ev("u1", 1, "page_view", "2020-11-03 00:30:00", day="20201102")]
    s = sessions_of(spark, rows).collect()[0]
    assert s.session_date == d("2020-11-02")


# --------------------------------------------------------------- sessions (9-10)


def test_session_without_purchase(spark):
    s = sessions_of(spark, [ev("u1", 1, "view_item", "2020-11-02 10:00:00")]).collect()[0]
    assert s.revenue_usd is None and s.did_purchase is False  # 9
    assert s.session_key == "u1-1"


def test_all_null_event_names(spark):
    rows = [ev("u1", 1, None, "2020-11-02 10:00:00"), ev("u1", 1, None, "2020-11-02 10:05:00")]
    s = sessions_of(spark, rows)
    r = s.collect()[0]
    assert r.did_view_item is None and r.did_purchase is None  # 10
    f = quality_flags.session_quality_flags(s).collect()[0]
    assert f.dq_flag_count == 0 and f.has_dq_flag is None
    neg = sessions_of(spark, [ev("u2", 1, None, "2020-11-02 10:00:00", revenue=-1.0)])
    g = quality_flags.session_quality_flags(neg).collect()[0]
    assert g.has_dq_flag is True and g.dq_flag_count == 1


# --------------------------------------------------------------- funnel (11-13)


def _funnel(spark, rows):
    df = spark.createDataFrame(rows, SESS_SCHEMA)
    return {r.step_order: r for r in funnel.funnel_conversion(df).collect()}


def test_funnel_any_order_across_sessions(spark):
    f = _funnel(spark, [sess("a", 1, d("2020-11-02"), cart=True), sess("a", 2, d("2020-11-03"), view=True)])
    assert f[1].users == 1 and f[2].users == 1  # 11


def test_funnel_zero_step_and_non_monotonic(spark):
    rows = [
        sess("a", 1, d("2020-11-02"), view=True, checkout=True, purchase=True),
        sess("b", 1, d("2020-11-02"), purchase=True),
        sess("c", 1, d("2020-11-02"), purchase=True),
    ]
    f = _funnel(spark, rows)
    assert f[2].users == 0 and f[3].pct_of_previous_step is None  # 12
    assert f[4].pct_of_top == 100.0 and f[1].pct_of_top < 100  # 13
    assert f[1].pct_of_previous_step is None


# --------------------------------------------------------------- retention (14-16)


def test_retention_cohorts(spark):
    rows = [
        sess("a", 1, d("2020-11-01")),  # Sunday -> cohort Monday 2020-10-26 (14)
        sess("a", 2, d("2020-12-21")),  # 8 weeks later (15)
        sess("a", 3, d("2020-12-28")),  # 9 weeks later: absent
        sess("b", 1, d("2020-11-03")),
        sess("b", 2, d("2020-11-05")),  # same week twice: one user (16)
    ]
    df = spark.createDataFrame(rows, SESS_SCHEMA)
    cells = {(r.cohort_week, r.weeks_since): r.active_users for r in retention.retention_cohorts(df).collect()}
    assert cells == {(d("2020-10-26"), 0): 1, (d("2020-10-26"), 8): 1, (d("2020-11-02"), 0): 1}


def test_unknown_users_are_in_no_cohort(spark):
    rows = [sess("a", 1, d("2020-11-03")), sess(None, 1, d("2020-11-03")), sess(None, 2, d("2020-11-10"))]
    df = spark.createDataFrame(rows, SESS_SCHEMA)
    for window in (None, WIN):
        cells = [tuple(r) for r in retention.retention_cohorts(df, 8, window).collect()]
        assert cells == [(d("2020-11-02"), 0, 1)]
        assert {r.user_pseudo_id for r in retention.cohort_activity(df, window).collect()} == {"a"}
    assert retention.weekly_activity(df).count() == 3
    assert funnel.funnel_per_user(df).count() == 2


def test_revenue_below_a_cent_adds_up(spark):
    rows = [ev("u1", 1, "page_view", f"2020-11-02 10:00:0{i}", revenue=0.004) for i in range(3)]
    for s in (sessions_of(spark, rows), sessions.session_core(staged_of(spark, rows))):
        assert s.first().revenue_usd == 0.012
        assert quality_flags.session_quality_flags(s).first().flag_revenue_without_purchase


def test_flatten_takes_the_largest_of_a_repeated_key(spark):
    twice = [("ga_session_id", (None, 6)), ("ga_session_id", (None, 7)), ("page_location", ("/a", None))]
    rows = [
        ev("u1", 6, "page_view", "2020-11-02 10:00:00", params=twice),
        ev("u1", 6, "page_view", "2020-11-02 10:00:01", params=[]),
        ev("u1", 5, "page_view", "2020-11-02 10:00:02"),
    ]
    got = [(r.ga_session_id, r.page_location) for r in staging.flatten_params(raw_df(spark, rows), *WIN).orderBy("event_ts").collect()]
    assert got == [(7, "/a"), (5, "/home")]


def test_check_history_over_runs(spark):
    res = _results(spark, [
        ("r1", "c1", "m", None, "error", 0, "pass", ""), ("r2", "c1", "m", None, "error", 2, "fail", ""),
        ("r2", "c2", "m", None, "warn", 1, "warn", ""),
    ])
    got = {r.check: (r.runs, r.failing_runs, r.last_run, r.last_status, r.last_failures, r.status_changed) for r in GV.check_history(res).collect()}
    assert got == {"c1": (2, 1, "r2", "fail", 2, True), "c2": (1, 1, "r2", "warn", 1, False)}


# --------------------------------------------------------------- RFM (17-22)


def test_rfm_frequency_recency_and_null_revenue(spark):
    rows = [
        ev("u1", 1, "purchase", "2021-01-31 10:00:00", revenue=5.0),
        ev("u1", 1, "purchase", "2021-01-31 10:05:00", revenue=7.5),  # 17: same session
        ev("u2", 1, "purchase", "2021-01-20 10:00:00", revenue=None),  # 19
    ]
    s = sessions_of(spark, rows)
    users = {r.user_pseudo_id: r for r in rfm.rfm_user(s, C.REFERENCE_AS_OF).collect()}
    assert set(users) == {"u1"}
    assert users["u1"].frequency == 1 and users["u1"].recency_days == 1  # 18
    assert users["u1"].monetary_usd == 12.5


def _users(spark, n):
    rows = [(f"u{i}", d("2021-01-01") + dt.timedelta(days=i), float(10 * (i + 1))) for i in range(n)]
    return spark.createDataFrame(rows, "user_pseudo_id string, session_date date, revenue_usd double")


def _scores(spark, n, method):
    base = _users(spark, n).select(
        "user_pseudo_id",
        F.lit(True).alias("did_purchase"),
        "session_date",
        "revenue_usd",
    )
    return {r.user_pseudo_id: r for r in rfm.rfm_scored(base, C.REFERENCE_AS_OF, 5, method).collect()}


def test_quintiles_small_inputs(spark):
    for method in ("window", "distributed"):
        s3 = _scores(spark, 3, method)
        assert sorted(r.m_score for r in s3.values()) == [1, 2, 3]  # 20
        s7 = _scores(spark, 7, method)
        sizes = [sum(1 for r in s7.values() if r.m_score == t) for t in range(1, 6)]
        assert sizes == [2, 2, 1, 1, 1]  # 21
        # most recent purchase -> r_score 5
        assert s7["u6"].r_score == 5 and s7["u0"].r_score == 1


def test_segment_rule_all_25_cells(spark):
    pairs = [(r, f) for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame(pairs, "r int, f int")
    got = {(x.r, x.f): x.segment for x in df.select("r", "f", rfm.segment_of(F.col("r"), F.col("f")).alias("segment")).collect()}

    champions, loyal, new, risk, asleep, attention = C.SEGMENTS
    grid = (  # rows: recency score 1 to 5; columns: frequency score 1 to 5
        (asleep, asleep, risk, loyal, loyal),
        (asleep, asleep, risk, loyal, loyal),
        (attention, attention, attention, loyal, loyal),
        (new, new, attention, champions, champions),
        (new, new, attention, champions, champions),
    )
    assert got == {(r, f): grid[r - 1][f - 1] for r, f in pairs}  # 22
    counts = {s: sum(1 for v in got.values() if v == s) for s in C.SEGMENTS}
    assert counts == {C.SEG_CHAMPIONS: 4, C.SEG_LOYAL: 6, C.SEG_NEW: 4, C.SEG_AT_RISK: 2,
                      C.SEG_HIBERNATING: 4, C.SEG_NEEDS_ATTENTION: 5}


# --------------------------------------------------------------- flags (23-26)


def test_flag_rules(spark):
    rows = [
        sess("a", 1, d("2020-11-02"), view=True, purchase=True, revenue=3.0),  # 23
        sess("b", 1, d("2020-11-02"), cart=True),  # 24
        sess("c", 1, d("2020-11-02"), revenue=5.0),  # 25
        sess("e", 1, d("2020-11-02"), view=True, checkout=True, purchase=True, revenue=-5.0),  # 26
        sess("f", 1, d("2020-11-02"), view=True),
    ]
    df = spark.createDataFrame(rows, SESS_SCHEMA)
    out = {r.session_key: r for r in quality_flags.session_quality_flags(df).collect()}
    assert len(out) == 5
    assert out["a-1"].flag_purchase_without_checkout and out["a-1"].dq_flag_count == 1
    assert out["b-1"].flag_addcart_without_view
    assert out["c-1"].flag_revenue_without_purchase
    e = out["e-1"]
    assert (e.flag_negative_revenue, e.flag_purchase_without_checkout, e.flag_addcart_without_view,
            e.flag_revenue_without_purchase, e.dq_flag_count) == (True, False, False, False, 1)
    assert out["f-1"].has_dq_flag is False and out["f-1"].dq_flag_count == 0


# --------------------------------------------------------------- monitors (27-28)


def test_flag_rate_threshold(spark):
    def flags(n_flagged, n):
        return spark.createDataFrame([(i < n_flagged,) for i in range(n)], "has_dq_flag boolean")

    assert CK.flag_rate_violations(flags(1, 50), 0.02).count() == 0  # exactly 2 %
    assert CK.flag_rate_violations(flags(2, 50), 0.02).count() == 1  # above
    empty = spark.createDataFrame([], "has_dq_flag boolean")
    assert CK.flag_rate_violations(empty, 0.02).count() == 0  # 27: empty -> NULL -> no row


def test_volume_band(spark):
    def rows(n):
        return spark.range(n)

    got = [CK.volume_violations(rows(n), 3, 5).count() for n in (2, 3, 5, 6)]
    assert got == [1, 0, 0, 1]  # 28 (band scaled by parameter)


# --------------------------------------------------------------- governance (29-30)


def _results(spark, rows):
    return spark.createDataFrame(
        rows, "run_id string, check string, model string, column string, severity string, failures long, "
        "status string, message string"
    )


def test_owner_fallbacks(spark):
    reg = GV.model_registry(spark, (
        ("m_owner", "marts", "team-a", None, "x"),
        ("m_none", "marts", None, None, "y"),
        ("m_slack", "marts", "team-b", "@b", "z"),
    ))
    res = _results(spark, [
        ("r", "c1", "m_owner", None, "warn", 3, "warn", "3 failing rows"),
        ("r", "c2", "m_none", None, "error", 1, "fail", "1 failing rows"),
        ("r", "c3", "m_slack", None, "error", 0, "pass", "0 failing rows"),
    ])
    alerts = {r.check: r for r in GV.owner_alerts(res, reg).collect()}
    assert set(alerts) == {"c1", "c2"}  # passes raise nothing
    assert alerts["c1"].owner == "team-a"  # 29
    assert alerts["c2"].owner == "unowned"
    assert alerts["c1"].alert == "[WARN] c1 on `m_owner` (owner team-a): 3 failing rows"


def test_governance_missing(spark):
    reg = GV.model_registry(spark, (
        ("ok_model", "marts", "team", None, "documented"),
        ("bad_model", "observability", "team", None, "   "),
        ("stg", "staging", None, None, None),
    ))
    res = _results(spark, [("r", "c1", "ok_model", None, "error", 0, "pass", "")])
    gaps = {r.model: r for r in GV.governance_gaps(reg, res).collect()}
    assert set(gaps) == {"ok_model", "bad_model"}  # staging is not governed
    assert gaps["ok_model"].compliant and gaps["ok_model"].missing == ""
    assert gaps["bad_model"].missing == "description, a data test"  # 30
    failing = _results(spark, [("r", "c1", "ok_model", None, "error", 3, "fail", "")])
    open_now = {r.model: (r.n_open, r.open_checks) for r in GV.governance_gaps(reg, failing).collect()}
    assert open_now == {"ok_model": (1, "c1"), "bad_model": (0, "")}


# --------------------------------------------------------------- JSON round trip (31)


def test_json_null_roundtrip(spark):
    rows = [
        ev("u1", 1, "page_view", "2020-11-02 10:00:00"),
        ev("u2", 2, "page_view", "2020-11-02 10:00:00"),
    ]
    raw = raw_df(spark, rows)
    # u1: ecommerce is SQL NULL; u2: ecommerce present with a JSON null field.
    raw = raw.withColumn("ecommerce", F.when(F.col("user_pseudo_id") == "u1", F.lit(None)).otherwise(F.col("ecommerce")))
    exported = json_io.to_json_columns(raw)
    text = {r.user_pseudo_id: r.ecommerce for r in exported.collect()}
    assert text["u1"] is None and text["u2"] == '{"purchase_revenue_in_usd":null}'
    back = {r.user_pseudo_id: r for r in json_io.from_json_columns(exported).collect()}
    assert back["u1"].ecommerce is None
    assert back["u2"].ecommerce.purchase_revenue_in_usd is None  # 31


def test_retention_bitmap_equals_set_form(spark):
    rows = [
        sess("a", 1, d("2020-11-01")),
        sess("a", 2, d("2020-12-21")),
        sess("a", 3, d("2020-12-28")),
        sess("b", 1, d("2020-11-03")),
        sess("b", 2, d("2020-11-05")),
        sess("c", 1, d("2021-01-31")),
    ]
    df = spark.createDataFrame(rows, SESS_SCHEMA)
    by_set = retention.retention_cohorts(df, 8).collect()
    by_bits = retention.retention_cohorts(df, 8, WIN).collect()
    assert by_set == by_bits
    outside = spark.createDataFrame([sess("z", 1, d("2021-03-01"))], SESS_SCHEMA)
    import pytest

    with pytest.raises(Exception):
        retention.retention_cohorts(outside, 8, WIN).collect()


def test_alert_digest_texts(spark):
    reg = GV.model_registry(spark, (("m", "marts", "team", None, "x"),))
    healthy = _results(spark, [("r", "c1", "m", None, "error", 0, "pass", "")])
    d = GV.alert_digest(GV.owner_alerts(healthy, reg)).first()
    assert (d.n_alerts, d.digest) == (0, "All models and tests healthy. No alerts.")
    bad = _results(spark, [
        ("r", "b_check", "m", None, "warn", 2, "warn", ""),
        ("r", "a_check", "m", None, "error", 1, "fail", ""),
    ])
    d = GV.alert_digest(GV.owner_alerts(bad, reg)).first()
    assert d.digest.split("\n") == [
        "Open data-quality alerts: 2",
        "- [FAIL] a_check on `m` (owner team): 1 failing rows",
        "- [WARN] b_check on `m` (owner team): 2 failing rows",
    ]
