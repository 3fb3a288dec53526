"""Token-ID files with keyed access through minimal perfect hash indexes.

Format of a shard (``SHARD_BYTES`` of ids at most, plus one document):

    raw ids of its documents, one after another, little-endian ``width`` bytes
    index: hash levels (bit words, ranks), then per slot the fingerprint of
           the key, the document's first id and its number of ids; then the
           keys in document order (doc_id, copy, is-null)
    footer: JSON with counts and array places, its length, ``MAGIC``

The index is a minimal perfect hash: each level marks the hash positions that
exactly one key takes, keys that share a position go to the next level, and a
key's slot is the number of marks before its own. Looking a key up costs one
probe a level (two on average) and one fingerprint comparison, however many
documents the shard holds.

Documents are range-partitioned and sorted by doc_id; each task streams its
range into shards. A task attempt writes files under names of its own, and
only those that its committed manifest row names belong to the output, so a
retried or speculative task cannot disturb it.

Defined results: null text is empty (only the end id). Rows with equal doc_id
follow one another, ordered by text, and are told apart by ``copy`` (0, 1,
...); a null doc_id counts as a key of its own and comes first. An empty table
gives no shard. Other columns are not stored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionlens import runtime
from sessionlens.llm.common import chunks, filesystem, mix64, prepare, qualified, raw_text, record_batch, stored, table
from sessionlens.llm.tokens import encoder

MAGIC = b"TIDX0001"
SHARD_BYTES = 64 << 20
END_ID = 2
GAMMA = 2.0  # hash positions per key and level
READERS = 4096  # most tasks that read shards back
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLDEN) & (1 << 64) - 1)


def key_hash(doc: np.ndarray, copy: np.ndarray, null: np.ndarray, seed: int) -> np.ndarray:
    inner = mix64(doc.astype(np.int64).view(np.uint64) + _step(seed))
    return mix64(inner ^ (copy.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64) + np.uint64(1)) * _GOLDEN)


class PerfectHash:
    """Keys (distinct uint64 hashes) -> 0..n-1, one to one."""

    def __init__(self, words: list[np.ndarray], ranks: list[np.ndarray]):
        self.words, self.ranks = words, ranks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        words, ranks, base, level = [], [], 0, 0
        while len(keys):
            at = cls._position(keys, level, max(1, int(len(keys) * GAMMA) + 63 >> 6))
            taken = np.bincount(at, minlength=max(1, int(len(keys) * GAMMA) + 63 >> 6) * 64) == 1
            bits = np.packbits(taken, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            words.append(bits)
            ranks.append((before[:-1] + base).astype("<u8"))
            base += int(before[-1])
            keys = keys[~taken[at]]
            level += 1
        return cls(words, ranks)

    @staticmethod
    def _position(keys: np.ndarray, level: int, n_words: int) -> np.ndarray:
        return (mix64(keys + _step(level + 1)) % np.uint64(n_words * 64)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level marks it (an unknown key)."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.words, self.ranks, strict=True)):
            at = self._position(keys[left], level, len(bits))
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (rank[at >> 6] + below).astype(np.int64)[hit]
            left = left[~hit]
        return out


class ShardWriter:
    def __init__(self, folder: str, width: int):
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        self.name, self.width = f"{uuid.uuid4().hex}.tid", width
        self.out = fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.docs: list[tuple[int, int, int]] = []
        self.lengths: list[int] = []
        self.size = 0

    def add(self, key: tuple[int, int, int], payload: bytes) -> None:
        self.out.write(payload)
        self.docs.append(key)
        self.lengths.append(len(payload) // self.width)
        self.size += len(payload)

    def close(self) -> dict:
        doc, copy, null = (np.array(x, np.int64) for x in zip(*self.docs, strict=True))
        lengths = np.array(self.lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        for seed in range(64):
            keys = key_hash(doc, copy, null, seed)
            if len(np.unique(keys)) == len(keys):
                break
        else:
            raise RuntimeError("no seed tells the shard's keys apart")
        index = PerfectHash.build(keys)
        slot = index.slots(keys)
        by_slot = np.empty(len(slot), np.int64)
        by_slot[slot] = np.arange(len(slot))
        arrays = {f"words{i}": w for i, w in enumerate(index.words)} | {f"ranks{i}": r for i, r in enumerate(index.ranks)}
        arrays |= {
            "fingerprint": (keys[by_slot] >> np.uint64(32)).astype("<u4"), "start": starts[by_slot].astype("<i8"),
            "length": lengths[by_slot].astype("<i8"), "doc": doc.astype("<i8"), "copy": copy.astype("<i8"), "null": null.astype("<i8"),
        }
        places, at = {}, self.size
        for name, a in arrays.items():
            data = a.tobytes()
            self.out.write(data)
            places[name] = [at, len(data), a.dtype.str]
            at += len(data)
        foot = json.dumps({"width": self.width, "docs": len(doc), "seed": seed, "levels": len(index.words), "arrays": places}).encode()
        self.out.write(foot + len(foot).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return {
            "name": self.name, "n_docs": len(doc), "n_ids": int(lengths.sum()), "first_null": int(null[0]), "first_doc": int(doc[0]),
            "first_copy": int(copy[0]), "last_null": int(null[-1]), "last_doc": int(doc[-1]), "last_copy": int(copy[-1]),
        }


class ShardReader:
    """Keyed access to one shard."""

    def __init__(self, folder: str, name: str):
        fs, base = filesystem(folder)
        self.file = fs.open_input_file(f"{base}/{name}")
        size = self.file.size()
        tail = self._read(size - 16, 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{name} is not a token shard")
        n = int.from_bytes(tail[:8], "little")
        self.foot = json.loads(self._read(size - 16 - n, n))
        self.dtype = np.dtype(f"<u{self.foot['width']}")
        levels = range(self.foot["levels"])
        self.index = PerfectHash([self.array(f"words{i}") for i in levels], [self.array(f"ranks{i}") for i in levels])
        self.fingerprint, self.start, self.length = (self.array(x) for x in ("fingerprint", "start", "length"))

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def array(self, name: str) -> np.ndarray:
        at, n, dtype = self.foot["arrays"][name]
        return np.frombuffer(self._read(at, n), dtype)

    def find(self, doc: np.ndarray, copy: np.ndarray, null: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for a key that the shard does not hold."""
        keys = key_hash(doc, copy, null, self.foot["seed"])
        slot = self.index.slots(keys)
        same = self.fingerprint[np.maximum(slot, 0)] == (keys >> np.uint64(32)).astype(np.uint32)
        return np.where((slot >= 0) & same, slot, -1)

    def ids(self, slot: int) -> np.ndarray:
        w = self.foot["width"]
        return np.frombuffer(self._read(int(self.start[slot]) * w, int(self.length[slot]) * w), self.dtype)

    def close(self) -> None:
        self.file.close()


_MANIFEST = pa.schema([("name", pa.string())] + [(n, pa.int64()) for n in (
    "n_docs", "n_ids", "first_null", "first_doc", "first_copy", "last_null", "last_doc", "last_copy")])
_MANIFEST_DDL = "name string, " + ", ".join(f"{n} long" for n in _MANIFEST.names[1:])


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str | None, end_id: int, limit: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    shard, at, copy = None, None, 0
    for b in batches:
        ids, texts = b.column("doc_id").to_pylist(), b.column("raw").to_pylist()
        for lo, hi in chunks([len(t) for t in texts], 2 << 20):
            for doc, payload in zip(ids[lo:hi], enc.encode(texts[lo:hi]), strict=True):
                key = (0 if doc is None else doc, int(doc is None))
                copy = copy + 1 if key == at else 0
                at = key
                shard = shard or ShardWriter(folder, enc.dtype.itemsize)
                shard.add((key[0], copy, key[1]), payload + end)
                if shard.size >= limit:
                    yield pa.RecordBatch.from_pylist([shard.close()], _MANIFEST)
                    shard = None
    if shard:
        yield pa.RecordBatch.from_pylist([shard.close()], _MANIFEST)


def write_index(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes shards into ``folder``; returns the manifest, a written table
    with a row for each shard in key order: ``shard`` (from 0), its file, its
    first and last key, and ``base``, the ids of all shards before it."""
    prepare(docs.sparkSession)
    folder = qualified(docs.sparkSession, folder)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("raw"), F.col("raw")]
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
        .repartitionByRange(order[0]).sortWithinPartitions(*order)
    )
    made = stored(rows.mapInArrow(lambda it: _write(it, folder, tokenizer, end_id, shard_bytes), _MANIFEST_DDL), "token-shards")
    # One row for each shard of 64 MB: small enough for one sorted window.
    before = Window.orderBy(F.desc("first_null"), "first_doc", "first_copy")
    return stored(made.select(
        (F.row_number().over(before) - 1).alias("shard"), "*",
        F.coalesce(F.sum("n_ids").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
    ), "token-manifest")


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("copy", pa.int64())])


def _read_back(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for name, base in ((n, s) for b in batches for n, s in zip(b.column("name").to_pylist(), b.column("base").to_pylist(), strict=True)):
        shard = ShardReader(folder, name)
        doc, copy, null = (shard.array(x) for x in ("doc", "copy", "null"))
        slots = shard.find(doc, copy, null)
        if (slots < 0).any():
            raise ValueError(f"{name}: a stored key is not found")
        for lo in range(0, len(doc), 8192):
            part = slots[lo : lo + 8192]
            crc = [zlib.crc32(shard.ids(s).astype("<u4").tobytes()) for s in part]
            yield record_batch({
                "doc_id": pa.array(doc[lo : lo + 8192], pa.int64(), mask=null[lo : lo + 8192] != 0), "start": shard.start[part] + base,
                "n_tokens": shard.length[part], "ids_crc32": crc, "copy": copy[lo : lo + 8192],
            }, _READ)
        shard.close()


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, copy) of every stored document,
    each found through its shard's index; a task a shard (``READERS`` at most
    at once)."""
    folder = qualified(manifest.sparkSession, folder)
    n = max(1, min(manifest.count(), READERS))
    rows = manifest.select("name", "base", (F.col("shard") % n).cast("int").alias("reader")).repartitionById(n, "reader")
    return rows.select("name", "base").mapInArrow(
        lambda it: _read_back(it, folder), "doc_id long, start long, n_tokens long, ids_crc32 long, copy long"
    )


def fetch(manifest: DataFrame, folder: str, doc_ids: Iterable[int]) -> dict[int, np.ndarray | None]:
    """The ids of a few documents (their first copy; None: not stored)."""
    out: dict[int, np.ndarray | None] = {}
    folder = qualified(manifest.sparkSession, folder)
    for doc in doc_ids:
        own = manifest.where((F.col("first_doc") <= doc) & (F.col("last_doc") >= doc) | (F.col("first_null") == 1)).orderBy("shard")
        out[doc] = None
        for name in (r["name"] for r in own.select("name").collect()):
            shard = ShardReader(folder, name)
            slot = shard.find(np.array([doc]), np.array([0]), np.array([0]))[0]
            out[doc] = shard.ids(slot) if slot >= 0 else out[doc]
            shard.close()
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = runtime.table_path(spark, "llm-token-index")
    return read_index(write_index(table(spark, sf_dir, "documents"), folder), folder)
