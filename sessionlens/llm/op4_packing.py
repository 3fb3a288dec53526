"""Best-fit packing by residuals, in a tree of rounds.

Each task tokenises its documents, cuts those longer than a sequence and packs
its pieces best-fit (longest first, into the fullest bin that still takes
them). Bins whose residual is at most ``NEARLY`` tokens are finished there and
then. Every other bin is an item of the next round, as long as its fill: items
are dealt to fewer groups by a hash of their number, packed best-fit again,
and so on, until one group is left or a round gains nothing. A group's size is
bounded in items and in bytes, so no task ever holds more than a part.

A bin carries its pieces as one binary record each, so nothing is joined back;
a round's bins are a written table, so a lost executor cannot renumber them.

Defined results: null text is empty (only the end id, one piece); repeated
rows and null doc_ids are packed like any other row; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import chunks, prepare, raw_text, record_batch, stored, table
from sessionlens.llm.tokens import GENERATION_WORDS, WordEncoder, encoder

CAPACITY = 4096
END_ID = 1
NEARLY = 32
GROUP_ITEMS = 100_000
GROUP_BYTES = 32 << 20
IDLE = 10_000  # a round that saves no more than one in so many open bins saves nothing

PIECE = np.dtype([("doc", "<i8"), ("null", "u1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
_BIN = pa.schema([("sequence_id", pa.int64()), ("fill", pa.int32()), ("members", pa.binary())])
_BIN_DDL = "sequence_id long, fill int, members binary"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers. Residuals are kept as a bit mask of the
    residuals that some open bin has; the lowest set bit at or above an item's
    size is the fullest bin that takes it."""
    bins: list[list[int]] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fit = mask >> size
        if fit:
            residual = size + (fit & -fit).bit_length() - 1
            b = open_at[residual].pop()
            if not open_at[residual]:
                mask ^= 1 << residual
            bins[b].append(item)
        else:
            residual, b = capacity, len(bins)
            bins.append([item])
        residual -= size
        if residual:
            open_at[residual].append(b)
            mask |= 1 << residual
    return bins


def _bins(sizes: np.ndarray, members: list[bytes], first_id: int, capacity: int) -> pa.RecordBatch:
    made = best_fit(sizes, capacity)
    return record_batch({
        "sequence_id": np.arange(len(made)) + first_id, "fill": [int(sizes[b].sum()) for b in made],
        "members": [b"".join([members[i] for i in b]) for b in made],
    }, _BIN)


def pieces(texts: list[bytes], docs: list[int | None], enc: WordEncoder, end_id: int, capacity: int) -> np.ndarray:
    """The pieces of each document, cut only where it is longer than a sequence."""
    out = []
    for doc, payload in zip(docs, enc.encode(texts), strict=True):
        ids = np.append(np.frombuffer(payload, enc.dtype).astype("<u4"), np.uint32(end_id))
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((doc or 0, doc is None, k, start, len(part), zlib.crc32(part.tobytes())))
    return np.array(out, PIECE)


def _local(
    batches: Iterator[pa.RecordBatch], path: str | None, words: int, end_id: int, capacity: int, group_items: int
) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, words)
    base, made, held, count = TaskContext.get().partitionId() << 32, 0, [], 0

    def pack() -> pa.RecordBatch:
        items = np.concatenate(held)
        raw = items.tobytes()
        n = PIECE.itemsize
        return _bins(items["length"].astype(np.int64), [raw[i * n : i * n + n] for i in range(len(items))], base + made, capacity)

    for b in batches:
        ids, texts = b.column("doc_id").to_pylist(), b.column("raw").to_pylist()
        for lo, hi in chunks([len(t) for t in texts], 2 << 20):
            held.append(pieces(texts[lo:hi], ids[lo:hi], enc, end_id, capacity))
            count += len(held[-1])
        if count >= group_items:
            yield (out := pack())
            made, held, count = made + out.num_rows, [], 0
    if held:
        yield pack()


def _merge(capacity: int, round_: int):
    """Numbers of a round's bins: 6 bits of the round, 32 of the group, 24 of
    the bin (a group has fewer items); after round 63 they may meet those of
    earlier rounds, so the bins finished by then would have to be numbered anew."""
    if round_ > 63:
        raise ValueError("more than 63 rounds of packing")

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sequence_id")
        first = (round_ << 56) + (int(key[0]) << 24)
        out = _bins(group["fill"].to_numpy(np.int64), group["members"].tolist(), first, capacity)
        return out.to_pandas()

    return merge


def _by_fill(open_bins: DataFrame, capacity: int, group_items: int, group_bytes: int) -> tuple[DataFrame, int]:
    """``open_bins`` with ``group``: fills next to each other, and with them
    their complements, fill groups up to the bounds; a fill with more is dealt
    to several groups. From a histogram of at most ``capacity`` lines."""
    near = F.least("fill", F.lit(capacity) - F.col("fill"))
    lines = open_bins.groupBy(near.alias("near")).agg(F.count("*").alias("n"), F.sum(F.length("members")).alias("size")).orderBy("near").collect()
    deal, group, n, size = [], 0, 0, 0
    for line in lines:
        parts = max(1, -(-line.n // group_items), -(-line.size // group_bytes))
        if n and (parts > 1 or n + line.n > group_items or size + line.size > group_bytes):
            group, n, size = group + 1, 0, 0
        deal.append((line.near, group, parts))
        n, size = n + line.n, size + line.size
        if parts > 1:
            group, n, size = group + parts, 0, 0
    groups = group + (n > 0)
    where = F.broadcast(open_bins.sparkSession.createDataFrame(deal, "near int, first int, parts int"))
    dealt = open_bins.withColumn("near", near.cast("int")).join(where, "near")
    return dealt.withColumn("group", F.col("first") + F.pmod(F.xxhash64("sequence_id"), F.col("parts"))).drop("near", "first", "parts"), groups


def pack(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY, nearly: int = NEARLY,
    group_items: int = GROUP_ITEMS, group_bytes: int = GROUP_BYTES, words: int = GENERATION_WORDS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each
    piece of each row of ``docs``; ``words`` is what an encoder keeps."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
    bins = stored(rows.mapInArrow(lambda it: _local(it, tokenizer, words, end_id, capacity, group_items), _BIN_DDL), "packing-0")
    full = capacity - nearly
    finished, round_, idle, groups = [], 0, 0, None
    while True:
        open_bins = bins.where(F.col("fill") < full)
        n, size = open_bins.agg(F.count("*"), F.coalesce(F.sum(F.length("members")), F.lit(0))).first()
        if n <= 1 or groups == 1 or idle == 2:
            break
        round_ += 1
        groups = max(1, -(-n // group_items), -(-size // group_bytes))
        if groups > 1 and round_ % 2 == 0:
            dealt, groups = _by_fill(open_bins, capacity, group_items, group_bytes)
        else:
            dealt = open_bins.withColumn("group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
        finished.append(bins.where(F.col("fill") >= full))
        bins = stored(dealt.groupBy("group").applyInPandas(_merge(capacity, round_), _BIN_DDL), f"packing-{round_}")
        idle = idle + 1 if n - bins.count() <= n // IDLE else 0
    for done in finished:
        bins = bins.unionByName(done)
    return bins.select("sequence_id", "members").mapInArrow(
        _members, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


_OUT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32())] + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each bin, laid end to end."""
    for b in batches:
        raw = b.column("members").to_pylist()
        if not raw:
            continue
        counts = np.array([len(m) // PIECE.itemsize for m in raw])
        all_pieces = np.frombuffer(b"".join(raw), PIECE)
        length = all_pieces["length"].astype(np.int64)
        after = np.cumsum(length)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
        before = (after - length)[begin]
        yield record_batch({
            "doc_id": pa.array(all_pieces["doc"], pa.int64(), mask=all_pieces["null"] != 0), "piece": all_pieces["piece"], "start": all_pieces["start"],
            "length": length, "ids_crc32": all_pieces["crc"].astype(np.int64),
            "sequence_id": np.repeat(np.array(b.column("sequence_id")), counts), "offset": after - length - np.repeat(before, counts),
        }, _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
