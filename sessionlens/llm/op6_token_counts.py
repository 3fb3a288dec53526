"""Token counts: greedy longest-match word pieces, counted by an automaton.

A trie over the vocabulary's pieces (as UTF-8 bytes) gets, for each node, a
failure link and the number of pieces that following the link pops, both
computed once. A word is then read byte by byte, each byte at most one step
down and a number of pops that sums to the answer: linear in the word, and no
piece is ever built. Where a piece ends, the link of its node leads to the
root of the continuing pieces with one pop; otherwise the link follows its
parent's links until one of them has the byte (breadth first).

Each Python worker counts a distinct word once (bounded memory). The input is
one projection: no shuffle.

Defined results: a null or empty text has no words and no tokens; a word that
no sequence of pieces covers counts as one (unknown) token; words are
separated by ASCII white space, A-Z lower-cased; repeated rows are counted
each; other columns pass by.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import ascii_words, prepare, raw_text, record_batch, table

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
CACHE_WORDS = 300_000
CACHE_BYTES = 16 << 20
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def byte_of_symbol() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands
    for: printable Latin-1 bytes stand for themselves, the others in order for
    the code points from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces_of(path: str) -> list[bytes]:
    """The vocabulary's pieces as bytes, without their word-end marks."""
    with open(path, encoding="utf-8") as f:
        names = json.load(f)["model"]["vocab"]
    code = byte_of_symbol()
    found = {bytes(code[c] for c in n.removesuffix(WORD_END)) for n in names}
    return sorted(found - {b""})


class PieceCounter:
    """Counts the greedy longest-match pieces of a word. ``first`` may begin a
    word, ``later`` continue it (by default the same pieces)."""

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes] | None = None):
        first = set(first)
        later = first if later is None else set(later)
        self.same = later == first
        # A node's edges are in one dictionary keyed by node * 256 + byte.
        self.edge: dict[int, int] = {}
        self.start, self.inner = 0, 0 if self.same else 1
        depth, parent, last, ends = [0, 0], [-1, -1], [0, 0], [False, False]
        for root, group in ((self.start, first), (self.inner, later)) if not self.same else ((0, first),):
            for piece in group:
                node = root
                for byte in piece:
                    nxt = self.edge.get(node << 8 | byte)
                    if nxt is None:
                        nxt = self.edge[node << 8 | byte] = len(depth)
                        depth.append(depth[node] + 1)
                        parent.append(node)
                        last.append(byte)
                        ends.append(False)
                    node = nxt
                ends[node] = ends[node] or bool(piece)
        self.link, self.pops = [-1] * len(depth), [0] * len(depth)
        for node in np.argsort(depth, kind="stable").tolist():
            if parent[node] < 0:
                continue
            if ends[node]:
                self.link[node], self.pops[node] = self.inner, 1
                continue
            at, popped = self.link[parent[node]], self.pops[parent[node]]
            while at >= 0:
                nxt = self.edge.get(at << 8 | last[node])
                if nxt is not None:
                    self.link[node], self.pops[node] = nxt, popped
                    break
                popped += self.pops[at]
                at = self.link[at]

    def count(self, word: bytes) -> int:
        edge, link, pops = self.edge, self.link, self.pops
        at, total = self.start, 0
        for byte in word:
            nxt = edge.get(at << 8 | byte)
            while nxt is None:
                total += pops[at]
                at = link[at]
                if at < 0:
                    return 1
                nxt = edge.get(at << 8 | byte)
            at = nxt
        while at != self.inner and at != self.start:
            total += pops[at]
            at = link[at]
            if at < 0:
                return 1
        return total


_COUNTERS: dict[str, PieceCounter] = {}


class _Counts(dict):
    """Word -> pieces; an unseen word is counted on first use."""

    def __init__(self, counter: PieceCounter):
        super().__init__()
        self.counter, self.held = counter, 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.counter.count(word)
        self.held += len(word)
        return n


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(pieces_of(path))
    known = _Counts(_COUNTERS[path])
    for b in batches:
        words, tokens = [], []
        for text in b.column("raw").to_pylist():
            split = ascii_words(text)
            words.append(len(split))
            tokens.append(sum(map(known.__getitem__, split)))
            if len(known) > CACHE_WORDS or known.held > CACHE_BYTES:
                known = _Counts(_COUNTERS[path])
        yield record_batch({"doc_id": b.column("doc_id"), "n_words": words, "n_tokens": tokens}, _SCHEMA)


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) for each row of ``docs``."""
    prepare(docs.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
    return rows.mapInArrow(lambda it: _count(it, path), "doc_id long, n_words long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
