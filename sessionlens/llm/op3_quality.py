"""Quality classifier: hashed word n-grams, logistic regression, FTRL.

A text is cut into units: letter runs, digit runs and symbol runs, case kept.
Features are hashed into ``SLOTS`` weights: unit unigrams and bigrams, and
unigrams to trigrams of unit shapes (lower case, capitalised, upper case,
digits, kinds of symbols; a unit equal to the one before has its own mark).
Each of the two kinds is scaled to length one, as square roots of shares.

Weights are learnt by follow-the-regularised-leader (proximal) updates on a
bounded sample of the labelled rows, ``SAMPLE_ROWS`` by order of a hash of the
id: parts of about ``SHARD_ROWS`` are each trained by a task of its own and
the parts' weights are averaged. The weights (``SLOTS`` doubles) go to the tasks that
score every row as a sparse dot product, in one projection of the documents.

Defined results: a null or empty text scores by the intercept alone; no labels
(or an empty table of them) give every text 0.5; a label that is null is no
label; if an id has several labels, their mean decides (0.5 counts as 1); a
null doc_id is never labelled; rows of one labelled id are one example in
training (the text of the smallest hash) and are scored each; other columns
pass by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from sessionlens.llm.common import chunks, prepare, raw_text, record_batch, release, remainder, stored, table

SLOTS = 1 << 18
SAMPLE_ROWS = 20_000
SHARD_ROWS = 2500
UPDATES, LEAST_EPOCHS, MOST_EPOCHS = 20_000, 4, 40  # updates of a part
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.005, 0.02
CACHE_UNITS = 200_000
CACHE_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20

_UNITS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x00-\x20A-Za-z0-9\x80-\xff]+")
_SHAPES = 16
_SAME = 8  # added to the shape of a unit that repeats the one before


def shape(unit: bytes) -> int:
    """0 lower, 1 capitalised, 2 upper, 3 mixed, 4 digits, 5 one common mark,
    6 other symbols, 7 a long symbol run."""
    c = unit[0]
    if 48 <= c <= 57:
        return 4
    if c < 128 and not unit.isalpha():
        if c < 128 and not (65 <= c <= 90 or 97 <= c <= 122):
            return 5 if unit in (b".", b",", b"-", b"'", b":", b";", b"?") else 7 if len(unit) > 2 else 6
    text = unit.decode("utf-8", "replace")
    if text.islower() or not text[0].isupper():
        return 0 if not any(x.isupper() for x in text) else 3
    if len(text) > 1 and text.isupper():
        return 2
    return 1


class _Units(dict):
    """Unit -> hash | shape << 32."""

    def __init__(self):
        super().__init__()
        self.held = 0

    def __missing__(self, unit: bytes) -> int:
        v = self[unit] = crc32(unit) | shape(unit) << 32
        self.held += len(unit)
        return v

    def full(self) -> bool:
        return len(self) > CACHE_UNITS or self.held > CACHE_BYTES


def _spread(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - 18)).astype(np.int64)


assert SLOTS == 1 << 18  # the shift in _spread


def features(text: bytes, known: _Units) -> tuple[np.ndarray, np.ndarray]:
    """Slots (distinct) and values of a text; none for a text without units."""
    units = _UNITS.findall(text)
    n = len(units)
    if not n:
        return np.empty(0, np.int64), np.empty(0)
    coded = np.fromiter(map(known.__getitem__, units), np.int64, n)
    h = (coded & 0xFFFFFFFF).astype(np.uint64)
    s = coded >> 32
    s[1:] += _SAME * (coded[1:] == coded[:-1])
    words = [_spread(h, 1)]
    if n > 1:
        words.append(_spread(h[:-1] * np.uint64(0x85EBCA77) + h[1:], 2))
    shapes = np.zeros(_SHAPES + _SHAPES**2 + _SHAPES**3, np.int64)
    shapes[:_SHAPES] = np.bincount(s, minlength=_SHAPES)
    if n > 1:
        pair = s[:-1] * _SHAPES + s[1:]
        shapes[_SHAPES : _SHAPES + _SHAPES**2] = np.bincount(pair, minlength=_SHAPES**2)
        if n > 2:
            np.add.at(shapes, _SHAPES + _SHAPES**2 + pair[:-1] * _SHAPES + s[2:], 1)
    shape_at = np.flatnonzero(shapes)
    slots, values = [], []
    for at, count in (np.unique(np.concatenate(words), return_counts=True), (_spread(shape_at.astype(np.uint64), 3), shapes[shape_at])):
        slots.append(at)
        values.append(np.sqrt(count / count.sum()))
    at, place = np.unique(np.concatenate(slots), return_inverse=True)
    return at, np.bincount(place, np.concatenate(values))


_SAMPLE = pa.schema([("shard", pa.int32()), ("rank", pa.int64()), ("label", pa.int32()), ("slots", pa.binary()), ("values", pa.binary())])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of a text are several times its size, so they leave in
    batches of about ``CHUNK_BYTES`` of text."""
    release()
    known = _Units()
    for b in batches:
        texts = b.column("raw")
        for lo, hi in chunks(pc.binary_length(texts).to_pylist(), CHUNK_BYTES):
            slots, values = [], []
            for t in texts.slice(lo, hi - lo).to_pylist():
                at, x = features(t, known)
                slots.append(at.astype("<i4").tobytes())
                values.append(x.astype("<f4").tobytes())
                if known.full():
                    known = _Units()
            own = b.slice(lo, hi - lo)
            yield record_batch({"shard": own.column("shard"), "rank": own.column("rank"), "label": own.column("label"), "slots": slots, "values": values}, _SAMPLE)


class Ftrl:
    """Proximal FTRL for logistic loss; the last slot is the intercept, which
    is not regularised."""

    def __init__(self, slots: int = SLOTS):
        self.z, self.n = np.zeros(slots + 1), np.zeros(slots + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, free = self.z[at], at == len(self.z) - 1
        l1, l2 = np.where(free, 0.0, L1), np.where(free, 0.0, L2)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + l2))

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        before = self.n[at]
        self.n[at] = before + g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - np.sqrt(before)) / ALPHA * w


def _train(group: pd.DataFrame) -> pd.DataFrame:
    release()
    group = group.sort_values(["rank", "label"])
    # Views of the part's bytes; a row is widened when it is its turn.
    rows = [(np.frombuffer(s, "<i4"), np.frombuffer(v, "<f4"), int(y)) for s, v, y in zip(group["slots"], group["values"], group["label"], strict=True)]
    model = Ftrl()
    order = np.random.default_rng(7)
    for _ in range(max(LEAST_EPOCHS, min(MOST_EPOCHS, UPDATES // len(rows)))):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            model.update(at.astype(np.int64), x.astype(float), label)
    w = model.weights(np.arange(SLOTS + 1))
    return pd.DataFrame({"rows": [len(rows)], "weights": [w.astype("<f8").tobytes()]})


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights, the intercept last, from labelled rows outside the held-out fold."""
    prepare(docs.sparkSession)
    labelled = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(remainder("doc_id", FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .withColumn("rank", F.xxhash64("doc_id"))
    )
    labelled = stored(labelled, "quality-labelled")
    # The lowest ranks; those that cannot be among them stay where they are. The
    # share is of the ids that can be chosen; should it leave too few, all are asked.
    ids = labelled.count()
    share = min(1.0, 1.5 * SAMPLE_ROWS / max(1, ids))
    sample = labelled.where(F.col("rank") <= int(share * ((1 << 64) - 1)) - (1 << 63)) if share < 1 else labelled
    sample = stored(sample.orderBy("rank", "doc_id").limit(SAMPLE_ROWS), "quality-sample")
    if sample.count() < min(ids, SAMPLE_ROWS):
        sample = stored(labelled.orderBy("rank", "doc_id").limit(SAMPLE_ROWS), "quality-sample")
    shards = max(1, sample.count() // SHARD_ROWS)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw")).join(F.broadcast(sample), "doc_id")
    # An id is one example, however many rows it has: of its rows the text of
    # the smallest hash teaches. Equal rows combine before the shuffle.
    chosen = chosen.groupBy("doc_id", "rank", "label").agg(F.min_by("raw", F.xxhash64("raw")).alias("raw"))
    rows = chosen.select(F.pmod(F.xxhash64("rank"), F.lit(shards)).cast("int").alias("shard"), "rank", "label", "raw").mapInArrow(
        _featurise, "shard int, rank long, label int, slots binary, values binary"
    )
    parts = rows.groupBy("shard").applyInPandas(_train, "rows long, weights binary").collect()  # a row for each part
    total = sum(p["rows"] for p in parts)
    out = np.zeros(SLOTS + 1)
    for p in sorted(parts, key=lambda p: (p["rows"], bytes(p["weights"]))):
        out += np.frombuffer(p["weights"], "<f8") * (p["rows"] / total)
    return out




def margin(text: bytes, weights: np.ndarray, known: _Units) -> float:
    at, x = features(text, known)
    return float(weights[at] @ x + weights[-1])


def _score(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    release()
    known = _Units()
    for b in batches:
        z = []
        for raw in b.column("raw"):  # one text at a time beside the batch
            z.append(margin(raw.as_py(), weights.value, known))
            if known.full():
                known = _Units()
        p = 1 / (1 + np.exp(-np.clip(np.array(z), -500, 500)))
        kept = [i for i, n in enumerate(b.schema.names) if n != "raw"]
        yield pa.RecordBatch.from_arrays(
            [b.column(i) for i in kept] + [pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())],
            [b.schema.names[i] for i in kept] + ["score", "predicted"],
        )


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Columns of ``docs`` (without ``raw``) plus ``score`` and ``predicted``;
    ``docs`` has the text's bytes in ``raw``."""
    prepare(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(weights)  # SLOTS + 1 doubles
    kept = [f for f in docs.schema.fields if f.name != "raw"]
    schema = StructType([*kept, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(lambda it: _score(it, held), schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their own columns, that are not rejected."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), raw_text().alias("raw"))
    return score(rows, fit(docs, labels)).where("predicted = 1").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), raw_text().alias("raw")
    )
    return score(rows, weights)
