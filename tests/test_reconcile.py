"""Row-level reconciliation and safe publishing."""

from __future__ import annotations

import random

import pytest
from conftest import SF0001

from sessionlens import runtime
from sessionlens.build import Build
from sessionlens.plans import reconcile as RC
from sessionlens.plans.run_build import build_and_test
from sessionlens.sources.publish import current_path, publish, publish_table

DDL = "k long, s string, v double, f boolean"


def compared(spark, left, right, **more):
    got = RC.reconcile_rows(spark.createDataFrame(left, DDL), spark.createDataFrame(right, DDL), ["k", "s"], **more)
    return {(r.k, r.s): (r.in_left, r.in_right, r.change, r.differing) for r in got.collect()}


def test_differing_keys_and_columns(spark):
    left = [(1, "a", 1.0, True), (2, "a", 1.0, True), (3, None, 1.0, None), (None, None, 5.0, None), (4, "x", 1.0, True), (4, "x", 2.0, False), (6, "t", 1.0, True), (6, "t", 1.0, True)]
    right = [(1, "a", 1.0, True), (2, "a", 1.5, None), (3, None, 1.0, False), (None, None, 6.0, None), (4, "x", 2.0, False), (4, "x", 1.0, True), (5, "r", 0.0, None), (6, "t", 1.0, True)]
    for buckets in (1, 7, RC.BUCKETS):
        assert compared(spark, left, right, buckets=buckets) == {
            (2, "a"): (1, 1, "changed", "f, v"), (3, None): (1, 1, "changed", "f"), (None, None): (1, 1, "changed", "v"),
            (5, "r"): (0, 1, "only right", ""), (6, "t"): (2, 1, "changed", "f, v"),
        }


def test_against_a_plain_comparison(spark):
    r = random.Random(4)
    left = [(k, "s", float(r.randint(0, 3)), r.choice([True, False, None])) for k in range(800)]
    right = [(k, "s", v if r.random() > 0.05 else v + 1, f if r.random() > 0.05 else None) for k, _, v, f in left if r.random() > 0.03]
    a, b = ({x[0]: x for x in rows} for rows in (left, right))
    want = {}
    for k in a.keys() | b.keys():
        if k not in b:
            want[(k, "s")] = (1, 0, "only left", "")
        elif a[k] != b[k]:
            want[(k, "s")] = (1, 1, "changed", ", ".join(n for n, x, y in zip("kfv", (0, a[k][3], a[k][2]), (0, b[k][3], b[k][2])) if x != y))
    assert compared(spark, left, right) == want


def test_equal_builds_exchange_digests_only(spark):
    rows = [(k, "s", 1.0, True) for k in range(500)]
    left, right = spark.createDataFrame(rows, DDL), spark.createDataFrame(rows[::-1], DDL)
    got = RC.reconcile_rows(left, right, ["k"])
    assert got.count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "Join" not in plan  # no row is opened
    digests = RC.bucket_digests(left, ["k"])
    assert digests.columns == ["bucket", "rows", "digest"]


def test_opened_rows_are_grouped_in_tasks_of_bounded_size(spark):
    # Every bucket differs: the tasks grow in number, not in size, and are not
    # merged by the few bytes that are shuffled.
    left = spark.range(4000).selectExpr("id as k", "cast(id % 7 as string) as s", "cast(id as double) as v", "id % 2 = 0 as f")
    right = left.withColumn("v", left.v + 1)
    got = RC.reconcile_rows(left, right, ["k", "s"], task_rows=500)
    sizes = got.rdd.glom().map(len).collect()
    assert len(sizes) == 16 and sum(sizes) == 4000 and max(sizes) < 500
    assert {r.differing for r in got.collect()} == {"v"}


def test_columns_have_to_agree(spark):
    with pytest.raises(ValueError, match="columns differ"):
        RC.reconcile_rows(spark.range(1), spark.range(1).withColumnRenamed("id", "other"), ["id"])


def test_publish_switches_when_complete(spark):
    root = runtime.table_path(spark, "published")
    assert current_path(spark, root) is None
    assert publish_table(spark.range(3), root).count() == 3
    first = current_path(spark, root)
    publish_table(spark.range(5), root)
    assert spark.read.parquet(current_path(spark, root)).count() == 5 and current_path(spark, root) != first
    assert spark.read.parquet(first).count() == 3  # still there for its readers


def test_failed_or_refused_load_leaves_the_table(spark):
    root = runtime.table_path(spark, "published")
    publish_table(spark.range(3), root)
    before = current_path(spark, root)

    def broken(path):
        spark.range(100).selectExpr("id", "assert_true(id < 50) as ok").write.parquet(path)

    with pytest.raises(Exception, match="assert_true|USER_RAISED"):
        publish(spark, root, broken)

    def refuse(table):
        if table.count() > 3:
            raise ValueError("too many rows")

    with pytest.raises(ValueError, match="too many"):
        publish_table(spark.range(9), root, refuse)
    assert current_path(spark, root) == before and spark.read.parquet(before).count() == 3
    assert publish_table(spark.range(2), root, refuse).count() == 2


def test_old_versions_go(spark):
    root = runtime.table_path(spark, "published")
    paths = []
    for n in range(4):
        publish_table(spark.range(n), root)
        paths.append(current_path(spark, root))
    held = [p for p in paths if spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    assert held == paths[-2:]


def test_build_publishes_marts_and_measures_them(spark, tmp_path):
    out = str(tmp_path / "out")
    first = build_and_test(spark, SF0001, out)
    scanned = Build(spark, SF0001).sessions.count()
    assert first["fct_sessions"].count() == scanned
    failures = {r.check: r.failures for r in first["check_results"].collect()}
    again = build_and_test(spark, SF0001, out)
    assert spark.read.parquet(current_path(spark, f"{out}/fct_sessions")).count() == scanned
    assert {r.check: r.failures for r in again["check_results"].collect()} == failures
