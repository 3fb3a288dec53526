"""Byte-level BPE by merge replay over the words of the corpus, and back.

A vocabulary of ranks says which two neighbouring pieces merge: those whose
joined bytes have a rank, the lowest rank first, the leftmost of equal ones
first. Instead of running this word by word, all different words of a block of
the corpus are laid end to end, an inverted index maps each mergeable pair
(named by the rank of its joined bytes) to its positions, and the ranks are
replayed in order: a rank's positions are merged in every word at once, and
only the two neighbours of a merged place get new entries. A merge touches one
word only, so replaying the corpus in blocks, as Spark deals them to tasks,
gives what one replay of the whole corpus would, without a shuffle. A merge
that makes a pair of a lower rank sends its word's remaining places of this
rank back to the index, so each word sees its own ranks in strict order.

``encode`` gives ids, ``decode`` turns ids into bytes again.

Defined results: null text is empty (no ids); repeated rows and null doc_ids
are encoded like any other row; strings of special tokens are ordinary text;
a word has no length limit; an empty table gives no rows; other columns are
left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import chunks, prepare, raw_text, table
from sessionlens.llm.pretokens import WordMemory, words

RANKS = "byte_bpe_50k.tiktoken"
_TEXT_BYTES = 2 << 20  # text that is split at once
_BLOCK_BYTES = 1 << 20  # bytes of words that are replayed at once (one word at least)
_MOST_PAIRS = 1 << 20  # pairs whose rank is remembered
_SHIFT = 32
_MANY = 48  # places from which a rank is merged in all words at once


class Ranks(dict):
    """Pair of ids (first << 32 | second) -> rank of the joined bytes, -1 for
    none; looked up once and remembered."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            self.rank = {base64.b64decode(piece): int(rank) for piece, rank in lines}
        self.piece = [b""] * (max(self.rank.values()) + 1)
        for piece, rank in self.rank.items():
            self.piece[rank] = piece
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.memory = WordMemory(lambda part: encode_words([w.encode("utf-8", "replace") for w in part], self))

    def __missing__(self, pair: int) -> int:
        if len(self) > _MOST_PAIRS:
            self.clear()
        found = self[pair] = self.rank.get(self.piece[pair >> _SHIFT] + self.piece[pair & 0xFFFFFFFF], -1)
        return found


@cache
def ranks(path: str) -> Ranks:
    return Ranks(path)


def encode_words(block: list[bytes], table: Ranks) -> list[bytes]:
    """The ids of each word as little-endian unsigned 32-bit integers."""
    out: list[bytes] = []
    for a, b in chunks([len(w) for w in block], _BLOCK_BYTES):
        out += _replay(block[a:b], table)
    return out


def _replay(block: list[bytes], table: Ranks) -> list[bytes]:
    flat = np.frombuffer(b"".join(block), np.uint8)
    end = len(flat)
    sizes = np.array([len(w) for w in block], np.int64)
    stops = np.cumsum(sizes)
    # Places are byte positions; place ``end`` stands for "no neighbour".
    chain = _Chain(
        piece=np.append(table.of_byte[flat], -1), after=np.append(np.arange(1, end + 1), end), before=np.arange(-1, end), stops=stops, end=end
    )
    chain.after[stops[sizes > 0] - 1] = end
    chain.before[(stops - sizes)[sizes > 0]] = end
    places = np.flatnonzero(chain.after[:end] < end)
    index: dict[int, list[int]] = {}
    waiting: list[int] = []
    _note(index, waiting, places, chain.piece[places] << _SHIFT | chain.piece[places + 1], table)
    while waiting:
        rank = heappop(waiting)
        listed = index.pop(rank)
        if len(listed) >= _MANY:
            listed = _merge_apart(chain, rank, listed, table, index, waiting)
        _merge_in_order(chain, rank, sorted(listed), table, index, waiting)
    ids = chain.piece[:end]
    kept = ids >= 0
    payload = ids[kept].astype("<u4").tobytes()
    counts = np.concatenate([[0], np.cumsum(kept)])
    begins = (4 * counts[stops - sizes]).tolist()
    return [payload[a:b] for a, b in zip(begins, (4 * counts[stops]).tolist(), strict=True)]


@dataclass
class _Chain:
    """The pieces of all words of a block as one linked list. A place's piece
    is -1 once it is part of the place before."""

    piece: np.ndarray
    after: np.ndarray
    before: np.ndarray
    stops: np.ndarray
    end: int


def _note(index: dict, waiting: list, places: np.ndarray, pairs: np.ndarray, table: Ranks) -> None:
    """Adds the pairs that begin at ``places`` to the index."""
    made = np.fromiter(map(table.__getitem__, pairs.tolist()), np.int64, len(pairs))
    order = np.argsort(made, kind="stable")
    order = order[np.searchsorted(made[order], 0) :]
    if not len(order):
        return
    found, begins = np.unique(made[order], return_index=True)
    listed, begins = places[order].tolist(), [*begins.tolist(), len(order)]
    for k, rank in enumerate(found.tolist()):
        if rank not in index:
            index[rank] = listed[begins[k] : begins[k + 1]]
            heappush(waiting, rank)
        else:
            index[rank] += listed[begins[k] : begins[k + 1]]


def _merge_apart(chain: _Chain, rank: int, listed: list[int], table: Ranks, index: dict, waiting: list) -> list[int]:
    """Merges the places of a rank at once in all words where their order
    cannot matter; gives back the places of the other words."""
    piece, after, before, end = chain.piece, chain.after, chain.before, chain.end
    places = np.unique(np.array(listed, np.int64))
    right = after[places]
    left, further = before[places], after[right]
    whole = (piece[places] >= 0) & (piece[right] >= 0)
    ranks_now = np.fromiter(map(table.__getitem__, (piece[places[whole]] << _SHIFT | piece[right[whole]]).tolist()), np.int64, int(whole.sum()))
    whole[whole] = ranks_now == rank  # else one of the two has merged since
    places, right, left, further = places[whole], right[whole], left[whole], further[whole]
    has_left, has_further = left < end, further < end
    pairs_left = piece[left[has_left]] << _SHIFT | rank
    pairs_right = rank << _SHIFT | piece[further[has_further]]
    # Order matters where a place touches the next one or makes a lower rank.
    delicate = np.zeros(len(places), bool)
    for has, pairs in ((has_left, pairs_left), (has_further, pairs_right)):
        made = np.fromiter(map(table.__getitem__, pairs.tolist()), np.int64, len(pairs))
        delicate[has] |= (made >= 0) & (made < rank)
    delicate[:-1] |= (right[:-1] == places[1:]) | (further[:-1] == places[1:])
    rest: list[int] = []
    if delicate.any():
        word = np.searchsorted(chain.stops, places, side="right")
        ordered = np.isin(word, word[delicate])
        rest = places[ordered].tolist()
        places, right, left, further = (x[~ordered] for x in (places, right, left, further))
        has_left, has_further = left < end, further < end
        pairs_left = piece[left[has_left]] << _SHIFT | rank
        pairs_right = rank << _SHIFT | piece[further[has_further]]
    piece[places], piece[right] = rank, -1
    after[places] = further
    before[further[has_further]] = places[has_further]
    _note(index, waiting, np.concatenate([left[has_left], places[has_further]]), np.concatenate([pairs_left, pairs_right]), table)
    return rest


def _merge_in_order(chain: _Chain, rank: int, places: list[int], table: Ranks, index: dict, waiting: list) -> None:
    """Merges the places of a rank one by one, from the left."""
    piece, after, before, end = memoryview(chain.piece), memoryview(chain.after), memoryview(chain.before), chain.end
    held_from = held_to = -1  # the word whose lower rank goes first
    for place in places:
        if held_from <= place < held_to:
            if rank not in index:
                index[rank] = []
                heappush(waiting, rank)
            index[rank].append(place)
            continue
        right = after[place]
        if piece[place] < 0 or piece[right] < 0 or table[piece[place] << _SHIFT | piece[right]] != rank:
            continue  # one of the two has merged since
        left, further = before[place], after[right]
        piece[place], piece[right] = rank, -1
        after[place] = further
        if further < end:
            before[further] = place
        lower = False
        for at, pair in (
            (left, piece[left] << _SHIFT | rank if left < end else -1),
            (place, rank << _SHIFT | piece[further] if further < end else -1),
        ):
            if pair >= 0 and (made := table[pair]) >= 0:
                if made in index:
                    index[made].append(at)
                else:
                    index[made] = [at]
                    heappush(waiting, made)
                lower = lower or made < rank
        if lower:
            word = int(np.searchsorted(chain.stops, place, side="right"))
            held_from, held_to = (int(chain.stops[word - 1]) if word else 0), int(chain.stops[word])


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_BYTES = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = ranks(path)
    for b in batches:
        docs, raw = b.column("doc_id"), b.column("raw").to_pylist()
        for lo, hi in chunks([len(t) for t in raw], _TEXT_BYTES):
            split = [words(t.decode("utf-8", "replace")) for t in raw[lo:hi]]
            ids_of = table.memory.know(set().union(*split))
            ids = [b"".join(map(ids_of, w)) for w in split]
            yield pa.RecordBatch.from_arrays([docs.slice(lo, hi - lo), pa.array(ids, pa.binary())], schema=_IDS)


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    piece = ranks(path).piece.__getitem__
    for b in batches:
        raw = b.column("ids").to_pylist()
        for lo, hi in chunks([len(i) for i in raw], _TEXT_BYTES):
            text = [b"".join(map(piece, np.frombuffer(i, "<u4").tolist())) for i in raw[lo:hi]]
            part = b.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(text, pa.binary())], schema=_BYTES)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of each row of ``docs``; ids are little-endian unsigned
    32-bit integers end to end."""
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path(RANKS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
    return rows.mapInArrow(lambda it: _encode(it, path), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the bytes of the ids."""
    prepare(encoded.sparkSession)
    path = path or public_tokenizers.path(RANKS)
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(lambda it: _decode(it, path), "doc_id long, ids binary, decoded binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode(encode(table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
