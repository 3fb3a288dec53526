"""Volume and freshness learned from history, on hand-made days."""

from __future__ import annotations

from datetime import datetime, timedelta

from sessionlens.plans import monitors as MN

START = datetime(2024, 1, 1)  # a Monday


def sessions(spark, counts, last_hour=23.5):
    """``counts`` sessions a day from the start; the last one of a day starts at
    ``last_hour`` (a number, or a function of the day's number)."""
    rows = []
    for day, n in enumerate(counts):
        hour = last_hour(day) if callable(last_hour) else last_hour
        for k in range(n):
            at = START + timedelta(days=day, hours=hour if k == 0 else min(hour, 1.0))
            rows.append((at, at.date()))
    return spark.createDataFrame(rows, "session_start timestamp, session_date date")


def volume(spark, counts):
    end = (START + timedelta(days=len(counts) - 1)).strftime("%Y%m%d")
    return [r for r in MN.daily_volume_anomaly(sessions(spark, counts), "20240101", end).orderBy("session_date").collect()]


def fresh(spark, counts, last_hour=23.5, days=None):
    days = days or len(counts)
    end, after = START + timedelta(days=days - 1), START + timedelta(days=days)
    got = MN.freshness_check(sessions(spark, counts, last_hour), "20240101", end.strftime("%Y%m%d"), after.strftime("%Y-%m-%d %H:%M:%S"))
    return got.orderBy("session_date").collect()


def test_a_spike_in_a_constant_series_is_an_anomaly(spark):
    counts = [10] * 40
    counts[20] = 200
    got = volume(spark, counts)
    assert [i for i, r in enumerate(got) if r.is_anomaly] == [20]
    assert got[20].expected == 10 and got[20].spread == 1.0 and got[20].score == 190.0
    # The spike is in the next weeks' histories and moves them not.
    assert [got[i].expected for i in (21, 27, 34)] == [10, 10, 10]


def test_weekly_rhythm_is_no_anomaly_but_its_loss_is(spark):
    counts = [100 if d % 7 < 5 else 20 for d in range(42)]
    counts[35], counts[40] = 20, 100  # a weak Monday, a strong Saturday
    got = volume(spark, counts)
    assert [i for i, r in enumerate(got) if r.is_anomaly and r.basis == "weekday"] == [35, 40]
    assert not any(r.is_anomaly for r in got[28:35])


def test_without_enough_history_only_empty_days_are_anomalies(spark):
    got = volume(spark, [5, 900, 0, 5, 5, 5, 5])
    assert [r.is_anomaly for r in got] == [False, False, True, False, False, False, False]
    assert {r.basis for r in got} == {"none"} and {r.score for r in got} == {None}


def test_usual_gap_is_fresh_and_a_late_day_is_stale(spark):
    # Nothing comes on Sundays; once nothing comes on a Wednesday.
    counts = [0 if d % 7 == 6 else 3 for d in range(42)]
    counts[37] = 0
    got = fresh(spark, counts)
    assert len(got) == 42 and got[6].latest_session_start is None and got[6].newest_session_start is not None
    stale = [i for i, r in enumerate(got) if r.is_stale]
    assert 37 in stale and not [i for i in stale if i % 7 == 6 and got[i].basis == "weekday"]
    assert got[41].lag_hours == 24.5 and got[41].usual_lag_hours == 24.5


def test_end_of_data_is_stale_and_unfinished_days_are_left_out(spark):
    got = fresh(spark, [3] * 28, days=30)
    assert [r.is_stale for r in got[20:]] == [False] * 8 + [True, True]
    assert [r.lag_hours for r in got[27:]] == [0.5, 24.5, 48.5]
    half_day = MN.freshness_check(sessions(spark, [3] * 10), "20240101", "20240110", "2024-01-08 12:00:00").collect()
    assert len(half_day) == 7


def test_no_sessions(spark):
    empty = sessions(spark, [1]).where("false")
    assert all(r.is_anomaly and r.sessions == 0 for r in MN.daily_volume_anomaly(empty, "20240101", "20240110").collect())
    got = MN.freshness_check(empty, "20240101", "20240110", "2024-01-11 00:00:00").collect()
    assert len(got) == 10 and all(r.lag_hours is None and not r.is_stale for r in got)
