"""Document fingerprints: quartile bucket digests and their likeness.

A window of five bytes runs over the text; six triplets of each window are
hashed into 256 buckets. Each bucket's count is written as its quartile among
all buckets (two bits), after a header of one checksum byte, one byte for the
logarithm of the length and two half bytes for the quartiles' ratios. Two
digests are compared by a bounded score: the sum of bucket differences (a
difference of three quartiles costs six), plus the header's differences;
likeness is 1 - score / ``BOUND``, 0 at least.

The query also compares each document with the next one (descending doc_id,
the last one's next is the first) and with an edited text that ends in the
next one's beginning. Documents are dealt to ranges of ids, about
``RANGE_ROWS`` documents each; the largest document of the range below is sent
to a range as well, so every range finds its last document's successor without
any other row, and the whole text is shuffled once.

Defined results: null text is empty; equal texts have equal fingerprints;
texts under five bytes have empty buckets and differ by checksum and length;
rows with equal doc_id follow one another ordered by text; rows with null
doc_id come last; a single document is its own successor; an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import prepare, record_batch, table

BUCKETS = 256
BOUND = 480
RANGE_ROWS = 1024
MOST_RANGES = 16384
_LOWEST = -(1 << 63)
_BLOCK = 1 << 18
# Odd multipliers of the triplet hash, and a salt for each of
# the six triplets of a window (offsets back from its newest byte).
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
_SALTS = (0x1B873593, 0x2545F491, 0x38B34AE5, 0x4C957F2D, 0x5851F42D, 0x6C078965)
# Cost of two buckets whose quartile codes differ by 0, 1, 2, 3.
_STEP = np.array([0, 1, 2, 6], np.int64)


def bucket_counts(data: bytes) -> np.ndarray:
    """Hashed triplets per bucket, in blocks, so memory is bounded."""
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(0, len(data) - 4), _BLOCK):
        x = np.frombuffer(data, np.uint8, min(_BLOCK + 4, len(data) - lo), lo).astype(np.uint32)
        first, second, third = (x * np.uint32(m) for m in _MULTIPLIERS)
        n = len(x) - 4
        for (a, b, c), salt in zip(_TRIPLETS, _SALTS, strict=True):
            h = first[4 - a : 4 - a + n] + second[4 - b : 4 - b + n]
            h += third[4 - c : 4 - c + n]
            h += np.uint32(salt)
            h >>= np.uint32(24)
            counts += np.bincount(h, minlength=BUCKETS)
    return counts


def digest(data: bytes) -> np.ndarray:
    """checksum, length code, two ratios, then a quartile code per bucket."""
    counts = bucket_counts(data)
    q1, q2, q3 = np.partition(counts, (63, 127, 191))[[63, 127, 191]].tolist()
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, int(math.log(len(data) + 1) / math.log(1.1)))
    head = [zlib.crc32(data) & 255, length, q1 * 16 // (q3 + 1) % 16, q2 * 16 // (q3 + 1) % 16]
    return np.concatenate([np.array(head, np.uint8), codes.astype(np.uint8)])


def as_text(d: np.ndarray) -> str:
    codes = d[4:].reshape(-1, 4)
    body = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return f"{d[0]:02x}{d[1]:02x}{d[2]:x}{d[3]:x}{body.astype(np.uint8).tobytes().hex()}"


def parse(text: str) -> np.ndarray:
    body = np.frombuffer(bytes.fromhex(text[6:]), np.uint8)
    codes = np.stack([body & 3, body >> 2 & 3, body >> 4 & 3, body >> 6], axis=1).ravel()
    head = [int(text[0:2], 16), int(text[2:4], 16), int(text[4], 16), int(text[5], 16)]
    return np.concatenate([np.array(head, np.uint8), codes])


def score(a: np.ndarray, b: np.ndarray) -> int:
    body = int(_STEP[np.abs(a[4:].astype(np.int8) - b[4:].astype(np.int8))].sum())
    head = np.abs(a[:4].astype(int) - b[:4].astype(int)).tolist()
    return min(BOUND, body + (head[0] > 0) + 2 * head[1] + head[2] + head[3])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - score(a, b) / BOUND


def edited(text: str, following: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _deal(batches: Iterator[pa.RecordBatch], ends: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    """Adds each row's range, and copies of the rows that a range needs as its
    last document's successor (``ahead``)."""

    def out(rows: pa.RecordBatch, part: np.ndarray, ahead: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array([ahead] * rows.num_rows, pa.bool_()), *rows.columns], ["part", "ahead", *rows.schema.names]
        )

    for b in batches:
        if not b.num_rows:
            continue
        key = np.array(b.column("key"), np.int64)
        part = np.searchsorted(ends, key, side="left")
        yield out(b, part, False)
        for chosen, to in ((np.isin(key, ends), part + 1), (key == top, np.zeros(len(key), np.int64))):
            if chosen.any():
                yield out(b.filter(pa.array(chosen)), to[chosen], True)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None  # the row whose successor comes next: (part, ahead, doc_id, text, digest)
    for b in batches:
        rows = []
        columns = (b.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text"))
        for part, ahead, doc, text in zip(*columns, strict=True):
            if ahead and before is not None and before[0] == part and before[1]:
                continue  # a further copy of a successor
            own = digest(text.encode())
            if before is not None and before[0] == part and not before[1]:
                rows.append((before, text, own))
            before = (part, ahead, doc, text, own)
        if rows:
            yield _result(rows)


def _result(rows: list) -> pa.RecordBatch:
    out = []
    for (_, _, doc, text, own), following, other in rows:
        new = edited(text, following)
        raw = new.encode()
        changed = own if new == text else digest(raw)
        out.append((doc, len(text), hashlib.sha256(raw).hexdigest(), as_text(own), as_text(changed), likeness(own, changed), likeness(own, other)))
    return record_batch(dict(zip(_OUT.names, zip(*out, strict=True), strict=True)), _OUT)


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    prepare(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, top = rows.agg(F.count("*"), F.max("key")).first()
    ranges = max(1, min(MOST_RANGES, n // range_rows))
    ends: list[int] = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        ends = sorted(set(rows.agg(F.percentile_approx("key", shares, max(10_000, 20 * ranges))).first()[0]))
    upper = np.array(ends, np.int64)
    dealt = rows.mapInArrow(lambda it: _deal(it, upper, top), "part int, ahead boolean, key long, doc_id long, text string")
    ordered = dealt.repartition("part").sortWithinPartitions("part", "ahead", F.desc("key"), "text")
    return ordered.select("part", "ahead", "doc_id", "text").mapInArrow(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
