"""Global ``ntile(n) over (order by ...)`` without a one-task window.

Spark plans a window without PARTITION BY as ``Exchange SinglePartition``: all
rows sort in one task. Here the rank of every row is computed distributed:

1. ``orderBy`` range-partitions on the full (tie-broken) sort key and sorts
   each partition; ``monotonically_increasing_id`` then holds
   (partition index << 33) + position in partition.
2. The sorted rows with their ids are written as a Parquet table in the
   shared folder (``spark.checkpoint.dir``), which fixes the ids: a
   recomputation after executor loss could otherwise re-sample the range
   bounds and number rows differently in the two later passes.
3. Rows per partition (one row per partition, so the table is bounded by the
   partition count, not by the data) give each partition's offset; that small
   table is broadcast and joined back: rank = offset + position.
4. With N rows, q = N div n, r = N mod n, the first r tiles hold q + 1 rows and
   the rest q, exactly as SQL ``ntile`` assigns them.

The sort key must be total (append a unique column) for the result to be
deterministic; a key on the value alone would also put one hot value in one
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.functions import int_div
from sessionlens.runtime import materialize

_ROW = "__ntile_row"
_PART = "__ntile_part"
_CNT = "__ntile_cnt"
_OFF = "__ntile_off"
_N = "__ntile_n"
_POS_BITS = 33  # monotonically_increasing_id keeps the position in the low 33 bits


def tile_of_rank(rank: Column, total: Column, n: int) -> Column:
    """1-based tile of a 0-based rank among ``total`` rows, ``n`` tiles."""
    q = int_div(total, n)
    r = total % n
    big = r * (q + 1)  # rows in the first r (larger) tiles
    small = F.greatest(q, F.lit(1))  # q = 0 only when every rank < big
    return (
        F.when(rank < big, int_div(rank, q + 1) + 1)
        .otherwise(r + int_div(rank - big, small) + 1)
        .cast("int")
    )


def ntile_window(df: DataFrame, n: int, order_by: Sequence[Column], out_col: str) -> DataFrame:
    """Spark's built-in form (single partition); for small inputs and checks."""
    return df.withColumn(out_col, F.ntile(n).over(Window.orderBy(*order_by)))


def ntile_distributed(df: DataFrame, n: int, order_by: Sequence[Column], out_col: str) -> DataFrame:
    sorted_ids = df.orderBy(*order_by).withColumn(_ROW, F.monotonically_increasing_id())
    # Lineage cut: a Parquet table in the shared folder. The ids are stored as
    # data, so how the read-back is split into partitions does not matter.
    tagged = materialize(sorted_ids, "ntile")
    part = F.shiftright(F.col(_ROW), _POS_BITS)
    counts = tagged.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias(_CNT))
    # One row per partition: the window below is over that bounded table.
    offsets = counts.select(
        _PART,
        (F.sum(_CNT).over(Window.orderBy(_PART)) - F.col(_CNT)).alias(_OFF),
        F.sum(_CNT).over(Window.partitionBy()).alias(_N),
    )
    position = F.col(_ROW).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    ranked = tagged.withColumn(_PART, part).join(F.broadcast(offsets), _PART)
    tile = tile_of_rank(F.col(_OFF) + position, F.col(_N), n)
    return ranked.withColumn(out_col, tile).drop(_ROW, _PART, _OFF, _N)


def ntile(df: DataFrame, n: int, order_by: Sequence[Column], out_col: str, method: str = "distributed") -> DataFrame:
    if method == "window":
        return ntile_window(df, n, order_by, out_col)
    if method == "distributed":
        return ntile_distributed(df, n, order_by, out_col)
    raise ValueError(f"unknown ntile method {method!r}")


_WHICH = "__ntile_which"
_TILE = "__ntile_tile"


def ntiles_distributed(df: DataFrame, n: int, specs: dict[str, Sequence[Column]], key: str) -> DataFrame:
    """Several global ntiles of the same rows in one round.

    Each spec becomes a branch of one union: the rows range-sorted on that
    spec's order and numbered, all branches written in one job as one table
    (the lineage cut). Offsets come from the per-(branch, partition) counts
    (bounded by the partition count), and one hash aggregation keyed by
    ``key`` (unique per row) puts the scores of the branches back on one row.
    Same result as applying ``ntile_distributed`` once per spec, with one
    written table instead of one per spec."""
    cols = df.columns
    branches = None
    for i, order in enumerate(specs.values()):
        b = df.orderBy(*order).select(*cols, F.lit(i).alias(_WHICH), F.monotonically_increasing_id().alias(_ROW))
        branches = b if branches is None else branches.unionByName(b)
    tagged = materialize(branches, "ntiles")
    part = F.shiftright(F.col(_ROW), _POS_BITS)
    counts = tagged.groupBy(F.col(_WHICH), part.alias(_PART)).agg(F.count(F.lit(1)).alias(_CNT))
    per_branch = Window.partitionBy(_WHICH)  # one row per partition of a branch: bounded
    offsets = counts.select(
        _WHICH,
        _PART,
        (F.sum(_CNT).over(per_branch.orderBy(_PART)) - F.col(_CNT)).alias(_OFF),
        F.sum(_CNT).over(per_branch).alias(_N),
    )
    position = F.col(_ROW).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    ranked = tagged.withColumn(_PART, part).join(F.broadcast(offsets), [_WHICH, _PART])
    tiles = ranked.select(*cols, _WHICH, tile_of_rank(F.col(_OFF) + position, F.col(_N), n).alias(_TILE))
    others = [c for c in cols if c != key]
    return tiles.groupBy(key).agg(
        *[F.max(c).alias(c) for c in others],  # identical in every branch
        *[F.max(F.when(F.col(_WHICH) == i, F.col(_TILE))).alias(out) for i, out in enumerate(specs)],
    ).select(*cols, *specs)
