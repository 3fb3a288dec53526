"""Row-level reconciliation of two builds of a model.

Each side is folded to one line per bucket of keys: rows and a sum of row
hashes, which does not depend on order. Lines are compared from coarse to fine
(``COARSE`` groups of buckets first), and only the rows of buckets that differ
are opened and grouped by key. So two equal builds exchange digests only, and a
few differing keys cost a few buckets, whatever the size of the tables.

Keys may be null or repeat: rows of a key are compared as a multiset, column by
column. Hashes have 64 bits and are added in decimal(38), those of the right
side with a minus; a difference could only hide behind a sum that is zero by
chance. The opened rows are grouped in as many tasks as their number asks for
(the digest lines know it), so a task holds ``TASK_ROWS`` or so of them,
however many buckets differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlens.runtime import materialize

BUCKETS = 1 << 16
COARSE = 256
TASK_ROWS = 250_000  # opened rows that a task groups, about 0.5 KB each


def _sum_of(value: Column) -> Column:
    return F.sum(value.cast("decimal(20,0)"))


def _hash(*columns: str) -> Column:
    """A hash in which a null is a value of its own (xxhash64 passes nulls over)."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def _bucket(key: list[str], buckets: int) -> Column:
    return F.pmod(_hash(*key), F.lit(buckets))


def bucket_digests(df: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, digest): at most ``buckets`` lines."""
    own = df.select(_bucket(key, buckets).alias("bucket"), _hash(*sorted(df.columns)).alias("h"))
    return own.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), _sum_of(F.col("h")).alias("digest"))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame | None:
    """The buckets whose lines differ; None if there are none. Fine lines are
    only compared inside coarse groups that differ."""

    def coarse(lines: DataFrame) -> DataFrame:
        return lines.groupBy(F.pmod("bucket", F.lit(COARSE)).alias("bucket")).agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))

    def unequal(a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.select("bucket", "rows", "digest").join(b.select("bucket", F.col("rows").alias("rows2"), F.col("digest").alias("digest2")), "bucket", "full_outer")
        return both.where(~(F.col("rows").eqNullSafe(F.col("rows2")) & F.col("digest").eqNullSafe(F.col("digest2")))).select("bucket")

    groups = [r.bucket for r in unequal(coarse(left), coarse(right)).collect()]  # at most COARSE
    if not groups:
        return None
    inside = F.pmod("bucket", F.lit(COARSE)).isin(groups)
    return unequal(left.where(inside), right.where(inside))


def reconcile_rows(left: DataFrame, right: DataFrame, key: list[str], buckets: int = BUCKETS, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row for each key whose rows differ: the key, its rows on each side,
    'only left', 'only right' or 'changed', and the columns that differ. Both
    sides have the same columns."""
    others = [c for c in left.columns if c not in key]
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    lines = [materialize(bucket_digests(df, key, buckets), "reconcile_digests") for df in (left, right)]
    wanted = differing_buckets(*lines)
    sides = [df.select(*key, *others, F.lit(i).alias("side"), _bucket(key, buckets).alias("bucket")) for i, df in enumerate((left, right))]
    if wanted is None:
        opened = sides[0].where(F.lit(False))
    else:
        wanted = F.broadcast(materialize(wanted, "reconcile_buckets"))  # at most ``buckets`` lines
        opened = sides[0].join(wanted, "bucket", "left_semi").unionByName(sides[1].join(wanted, "bucket", "left_semi"))
        rows = sum(line.join(wanted, "bucket", "left_semi").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] for line in lines)
        # A stated number is not lowered to fewer, larger tasks by the shuffle's bytes.
        opened = opened.repartition(-(-rows // task_rows) or 1, *key)
    # Counts of both sides, and a digest per column: the left side's less the right's.
    on = [F.col("side") == i for i in (0, 1)]
    sums = [F.sum(F.when(on[0], h).otherwise(-h)).alias(f"{c}_d") for c in others for h in (_hash(c).cast("decimal(20,0)"),)]
    held = opened.groupBy(*key).agg(*[F.count_if(s).alias(n) for s, n in zip(on, ("in_left", "in_right"), strict=True)], *sums)
    parted = F.array_compact(F.array(*[F.when(F.col(f"{c}_d") != 0, F.lit(c)) for c in others]))
    held = held.withColumn("differing", parted).where((F.col("in_left") != F.col("in_right")) | (F.size("differing") > 0))
    change = F.when(F.col("in_right") == 0, "only left").when(F.col("in_left") == 0, "only right").otherwise("changed")
    listed = F.when(change == "changed", F.array_join(F.array_sort("differing"), ", ")).otherwise("")
    return held.select(*key, "in_left", "in_right", change.alias("change"), listed.alias("differing"))
