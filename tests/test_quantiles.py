"""Tiles by counting equal Spark's single-partition ntile."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sessionlens.operators import quantiles as Q
from sessionlens.operators.ntile import ntile

NUMBERS = st.one_of(
    st.integers(0, 5).map(float), st.floats(-1e3, 1e3), st.floats(allow_nan=False, allow_infinity=False),
    st.sampled_from([0.1 + 0.2, 0.3, 1e300, -1e300, 5e-324, 1.0, 1.0000000000000002]),
)


def both(spark, rows, n, key_null=False):
    keys = [None if key_null and i == len(rows) // 2 else f"u{(i * 7919) % 10007:05d}" for i in range(len(rows))]
    df = spark.createDataFrame([(u, *r) for u, r in zip(keys, rows)], "u string, a long, b double").repartition(3)
    got = Q.ntiles_by_counting(df, n, {"ta": -F.col("a"), "tb": F.col("b")}, "u")
    want = ntile(ntile(df, n, [F.col("a").desc(), F.col("u")], "ta", "window"), n, [F.col("b"), F.col("u")], "tb", "window")
    return ({r.u: (r.ta, r.tb) for r in x.collect()} for x in (got, want))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), NUMBERS), min_size=1, max_size=70), st.integers(1, 7), st.booleans())
def test_tiles_equal_the_window(spark, rows, n, key_null):
    got, want = both(spark, rows, n, key_null)
    assert got == want


def test_heavy_ties_and_many_values(spark, monkeypatch):
    monkeypatch.setattr(Q, "BINS", 16)  # several rounds
    rows = [(i % 3, float((i * 7919) % 9973) if i % 3 else 5.0) for i in range(3000)]
    got, want = both(spark, rows, 5)
    assert got == want
    sizes = [sum(t[1] == k for t in got.values()) for k in range(1, 6)]
    assert max(sizes) - min(sizes) <= 1


def test_long_numbers_that_a_double_cannot_tell_apart(spark):
    big = (1 << 62) + 1
    rows = [(big + i % 7, float(i)) for i in range(50)]
    got, want = both(spark, rows, 5)
    assert got == want


@pytest.mark.parametrize("rows,n", [(0, 5), (3, 5), (5, 5), (13, 5), (10, 1)])
def test_first_ranks(rows, n):
    tiles = [k for k in range(n) for _ in range(rows // n + (k < rows % n))]
    starts = Q.first_ranks(rows, n)
    assert [sum(r >= s for s in starts) for r in range(rows)] == tiles


def test_empty(spark):
    df = spark.createDataFrame([], "u string, a long")
    assert Q.ntiles_by_counting(df, 5, {"t": F.col("a")}, "u").count() == 0


def test_rows_are_written_once_and_ties_as_keys(spark, monkeypatch):
    written = []
    kept = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name: written.append((name, df.columns)) or kept(df, name))
    df = spark.createDataFrame([(f"u{i}", i % 2, "a wide column") for i in range(100)], "u string, a long, w string")
    Q.ntiles_by_counting(df, 5, {"t": F.col("a")}, "u").collect()
    assert written == [("ntile_rows", ["u", "a", "w"]), ("ntile_ties", ["v", "key", "row"])]
