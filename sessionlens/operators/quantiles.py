"""Global ``ntile`` of several columns by counting, without a global sort.

Rows are written once. A tile begins at a known rank, so for each score only a
few rows have to be found: those at the tile's first ranks.

1. Values. Histograms of ``BINS`` equal intervals are counted over the table; the
   interval that holds a wanted rank is taken apart in the next round, between
   the smallest and the largest value really met in it, until it holds one
   value. What comes back are at most ``BINS`` lines for each tile and round.
2. Ties. If a tile begins among rows of one value, their keys alone are sorted
   over many tasks and the key at the wanted place is read.
3. Each row's tile is then a comparison with these few values and keys: a
   projection of the written table, with no join and no shuffle.

A value that a third of all rows have is only counted, and its keys are sorted
spread over tasks. Values are numbers without NULL; the key is unique, NULL
first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.runtime import materialize

BINS = 4096
_POS_BITS = 33  # monotonically_increasing_id keeps the position in the low 33 bits


@dataclass(frozen=True)
class Start:
    """Where a tile begins: at ``value`` (null: after all rows), and among the
    rows of that value at ``key`` (null: at the first of them)."""

    value: object
    key: str | None = None


def first_ranks(rows: int, n: int) -> list[int]:
    """The 0-based ranks at which tiles 2..n begin: the first ``rows`` mod n
    tiles have one row more."""
    q, r = divmod(rows, n)
    return [k * q + min(k, r) for k in range(1, n)]


def _values_at(table: DataFrame, value: Column, ranks: list[int]) -> dict[int, tuple[object, int, int]]:
    """rank -> (value there, rows below that value, rows of it)."""
    v = table.select(value.alias("v"))
    low, high, rows = v.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    open_ = {rank: (low, high, 0, rows) for rank in ranks if rank < rows}  # interval, rows below it, rows in it
    found: dict[int, tuple[object, int, int]] = {}
    while open_:
        for rank, (lo, hi, below, held) in list(open_.items()):
            if lo == hi:
                found[rank] = (lo, below, held)
                del open_[rank]
        intervals = sorted({x[:3] for x in open_.values()})
        parts = []
        for lo, hi, _ in intervals:
            inside = v.where(F.col("v").between(F.lit(lo), F.lit(hi)))
            at = F.width_bucket(F.col("v").cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(BINS))
            parts.append(inside.groupBy(F.lit(lo).alias("lo"), at.alias("bin")).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")))
        lines: dict[object, list] = {}
        if parts:
            both = parts[0]
            for p in parts[1:]:
                both = both.unionByName(p)
            for r in both.orderBy("lo", "low").collect():  # BINS + 1 for each interval
                lines.setdefault(r.lo, []).append(r)
        for rank, (lo, hi, below, _) in list(open_.items()):
            for line in lines[lo]:
                if rank < below + line.n:
                    open_[rank] = (line.low, line.high, below, line.n)
                    break
                below += line.n
            if open_[rank][:2] == (lo, hi):  # neighbours that a double cannot tell apart
                found[rank] = _value_by_value(v, lo, hi, rank, open_.pop(rank)[2])
    return found


def _value_by_value(v: DataFrame, lo: object, hi: object, rank: int, below: int) -> tuple[object, int, int]:
    for r in v.where(F.col("v").between(F.lit(lo), F.lit(hi))).groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").toLocalIterator():
        if rank < below + r.n:
            return r.v, below, r.n
        below += r.n
    raise AssertionError("the rank is in the interval")


def _keys_at(table: DataFrame, value: Column, key: str, wanted: dict[object, list[int]]) -> dict[tuple[object, int], str | None]:
    """(value, place) -> the key at that place among the rows of the value."""
    tied = table.select(value.alias("v"), F.col(key).alias("key")).where(F.col("v").isin(list(wanted)))
    # The numbers are stored, so both passes see the same order.
    numbered = materialize(tied.orderBy("v", "key").withColumn("row", F.monotonically_increasing_id()), "ntile_ties")
    part, place = F.shiftright("row", _POS_BITS), F.col("row").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    counts = numbered.groupBy("v", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    before = Window.partitionBy("v").orderBy("part")  # a line for each sorted partition
    lines = counts.withColumn("upto", F.sum("n").over(before)).collect()
    places = {}
    for v, ranks in wanted.items():
        for rank in ranks:
            line = next(x for x in sorted((x for x in lines if x.v == v), key=lambda x: x.part) if rank < x.upto)
            places[line.part << _POS_BITS | line.first + rank - (line.upto - line.n)] = (v, rank)
    return {places[r.row]: r.key for r in numbered.where(F.col("row").isin(list(places))).collect()}


def tile_starts(table: DataFrame, value: Column, key: str, rows: int, n: int) -> list[Start]:
    """Where tiles 2..n begin in the order (value, key)."""
    ranks = first_ranks(rows, n)
    at = _values_at(table, value, sorted(set(ranks)))
    tied: dict[object, list[int]] = {}
    for rank, (v, below, _) in at.items():
        if rank > below:
            tied.setdefault(v, []).append(rank - below)
    keys = _keys_at(table, value, key, tied) if tied else {}
    return [Start(None) if rank not in at else Start(at[rank][0], keys.get((at[rank][0], rank - at[rank][1]))) for rank in ranks]


def tile_of(value: Column, key: str, starts: list[Start]) -> Column:
    """1 and one more for each start that the row is not before."""
    tile = F.lit(1)
    for s in starts:
        if s.value is None:
            continue
        reached = value >= F.lit(s.value)
        if s.key is not None:
            # The key is not the first of its value, so a NULL key is before it.
            reached = (value > F.lit(s.value)) | ((value == F.lit(s.value)) & F.coalesce(F.col(key) >= F.lit(s.key), F.lit(False)))
        tile = tile + F.when(reached, 1).otherwise(0)
    return tile.cast("int")


def ntiles_by_counting(df: DataFrame, n: int, specs: dict[str, Column], key: str) -> DataFrame:
    """``df`` with an ntile for each of ``specs`` (name -> number to order by,
    ascending; ties by ``key``). ``df`` is written once and read back."""
    table = materialize(df, "ntile_rows")
    rows = table.count()
    return table.withColumns({out: tile_of(value, key, tile_starts(table, value, key, rows, n)) for out, value in specs.items()})
