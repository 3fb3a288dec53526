"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

    P(word | context) = P(class | context) * P(member | class, context) * P(word | member)

Classes: the ``SINGLES`` commonest words are a class each; all other words
fall into classes by tier (the ``TIER`` commonest, the rest) and a hash of
their last two bytes; the end of a text is a class; and a word equal to the
one before it is in the class "again", which holds that word alone. P(class |
context) is a softmax over the sum of three hashed features' weights: the
previous word, the word before it (a skip), and the pair of their classes with
whether the last was a repetition. The words of a class of many are ``MEMBERS``
members: one word each, or two, among the ``TIER`` commonest, and else the words
of a hash. P(member | class, context) is a second softmax over the same three
features, each hashed together with the class. P(word | member) is the word's
share of the member, one added to each word's count and one unknown word a
member outside the tier.

Training reads every training text. A first pass sums how often each feature
met each class and sets the weights from these sums; then, for one feature
after the other, a pass sums the model's expectation of the same quantities
and the feature's weights move by the difference (their gradient) over the
mean of both. The members' weights start from their shares of the class and take
one step of iterative scaling: a third (there are three features) of the
logarithm of what the data holds over what the shares expect. Tasks send a row of sums for each feature row, which Spark deals
by key to the tasks that add them; the driver sees one number for each weight (``ROWS`` x ``CLASSES`` and
3 x ``INSIDE`` x ``WIDTH``, fixed bounds), and tasks get weights and the ``TOP`` commonest words (a fixed
bound as well). Texts are split once and kept as one class, one member and one
slot a token, four bytes, for all these passes. Arrow splits and numbers the
words of many texts at a time, so only distinct words become Python objects; and
the exponentials of the weights are kept, whose products the softmaxes sum, so
no exponential is taken for a token.

Counts of all words are exact and distributed. Words outside the commonest
``TOP`` meet their count in a join on the word, one row for each text and
word; such a word is no hot key in training texts, and AQE splits one that
only held-out texts repeat.

Defined results: null text is empty (its one token is the end); a word that
training lacks has count 0; with no training text every count is 0 and the
score is the unknown word's share of its class and member; a null doc_id counts as the
empty text for the fold; repeated rows are learnt from and scored each; an
empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import chunks, prepare, raw_text, record_batch, remainder, stored, table

FOLDS, HELD_OUT = 7, 2
TOP = 1 << 17
SINGLES, TIER, SUFFIXES = 32, 2048, 16
AGAIN, END = SINGLES + 2 * SUFFIXES, SINGLES + 2 * SUFFIXES + 1
CLASSES = END + 1
SLOTS = 4096  # rows of weights for each of the three features
ROWS = 3 * SLOTS
KINDS = 2 * SUFFIXES  # classes of more than one word
MEMBERS = 128  # of each of them
INSIDE = 4096  # rows of weights inside the classes for each of the three features
WIDTH = MEMBERS + KINDS  # what is summed for such a row: members and classes met
ROUNDS = 1  # of steps on each of the three features in turn
MOST_WEIGHT = 20.0
PRIOR = 4.0  # pseudo-count that draws a feature's weights to the class shares
MEMBER_PRIOR = 16.0  # the same inside a class, where a row meets more kinds of words
SCALE = 1 << 16  # expectations are summed as integers, so order does not matter
FLUSH_BYTES = 32 << 20  # of words that are counted together
_TOKENS = 1 << 12
_END_WORD = b""


def suffix(word: bytes) -> int:
    return crc32(word[-2:]) % SUFFIXES


def member(word: bytes) -> int:
    """Of a word outside the tier."""
    return crc32(word) >> 8 & (MEMBERS - 1)


def leaf(word: bytes) -> int:
    """Class and member in one number, of a word outside the tier."""
    return suffix(word) * MEMBERS + member(word)


# --- counts --------------------------------------------------------------------------------------------

_COUNT = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (binary) as ``ascii_words`` cuts them, one after
    the other, and how many each text has. Arrow's ASCII functions look at bytes
    only, valid UTF-8 or not."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts.view(pa.string())))
    lists = pc.ascii_split_whitespace(trimmed)
    words, sizes = lists.flatten(), np.array(pc.list_value_length(lists), np.int64)
    empty = np.array(pc.binary_length(trimmed)) == 0  # cut into one empty word
    if empty.any():
        sizes[empty] = 0
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return words, sizes


def _counted(words: list[pa.Array], texts: int) -> pa.RecordBatch:
    found = pc.value_counts(pa.chunked_array(words, pa.string()))
    word = pa.concat_arrays([found.field("values").view(pa.binary()), pa.array([_END_WORD], pa.binary())])
    return record_batch({"word": word, "n": pa.concat_arrays([found.field("counts"), pa.array([texts], pa.int64())])}, _COUNT)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, texts, size = [], 0, 0
    for b in batches:
        words, sizes = split(b.column("raw"))
        held.append(words)
        texts += len(sizes)
        size += words.nbytes
        if size > FLUSH_BYTES:
            yield _counted(held, texts)
            held, texts, size = [], 0, 0
    if texts:
        yield _counted(held, texts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts' tokens; the end is the empty word."""
    return texts.select("raw").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


_SHARE = pa.schema([("leaf", pa.int32()), ("words", pa.int64()), ("tokens", pa.int64())])


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = SUFFIXES * MEMBERS
    words, tokens = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for b in batches:
        own = np.fromiter(map(leaf, b.column("word").to_pylist()), np.int64, b.num_rows)
        words += np.bincount(own, minlength=size)
        tokens += np.bincount(own, np.array(b.column("c")), minlength=size).astype(np.int64)
    yield record_batch({"leaf": np.arange(size), "words": words, "tokens": tokens}, _SHARE)


# --- vocabulary and model ------------------------------------------------------------------------------

class _Numbers(dict):
    """Word -> number; a word that is not listed gets its leaf's number."""

    rest = 0

    def __missing__(self, word: bytes) -> int:
        return self.rest + leaf(word)


class Vocabulary:
    """The commonest words: their class, member, feature slot and count. Any
    other word has the number ``len(top) + 1 + leaf``; number 0 is the start of
    a text, ``end`` its end."""

    def __init__(self, top: list[tuple[bytes, int]], tail: np.ndarray, n_tokens: int, n_words: int):
        """``top``: words by falling count, without the end; ``tail``: rows
        (words, tokens) of the words outside the tier, for each leaf."""
        self.n_tokens, self.n_words = n_tokens, n_words
        ends = sum(c for w, c in top if w == _END_WORD)
        top = [(w, c) for w, c in top if w != _END_WORD]
        n = len(top)
        self.number = _Numbers({w: i + 1 for i, (w, _) in enumerate(top)})
        self.number.rest = self.first_rare = n + 1
        self.end = n + 1 + SUFFIXES * MEMBERS
        size = self.end + 1
        self.of_class, self.slot, self.of_member = (np.zeros(size, np.int64) for _ in range(3))
        # Words and tokens of each member; a class's words of the tier take turns.
        self.mass = np.zeros((KINDS, MEMBERS))
        turn = np.zeros(CLASSES, np.int64)
        count = np.zeros(size)
        words, tokens = np.zeros(CLASSES), np.zeros(CLASSES)
        for i, (w, c) in enumerate(top):
            k = i if i < SINGLES else SINGLES + suffix(w) + (SUFFIXES if i >= TIER else 0)
            self.of_class[i + 1], count[i + 1] = k, c
            self.slot[i + 1] = 1 + SUFFIXES + i if i < SLOTS // 2 else SLOTS // 2 + crc32(w) % (SLOTS // 2)
            if i < TIER:
                words[k] += 1
                tokens[k] += c
                if i >= SINGLES:
                    self.of_member[i + 1] = turn[k] % MEMBERS
                    turn[k] += 1
                    self.mass[k - SINGLES, self.of_member[i + 1]] += c + 1
            else:
                self.of_member[i + 1] = member(w)
        rare = np.arange(SUFFIXES * MEMBERS)
        self.of_class[n + 1 + rare] = SINGLES + SUFFIXES + rare // MEMBERS
        self.of_member[n + 1 + rare] = rare % MEMBERS
        self.slot[n + 1 + rare] = 1 + rare // MEMBERS
        self.mass[SUFFIXES:] = tail.sum(axis=1).reshape(SUFFIXES, MEMBERS) + 1  # one unknown word each
        # The unknown word that every class has is one of them.
        words[SINGLES + SUFFIXES : SINGLES + 2 * SUFFIXES] += tail[:, 0].reshape(SUFFIXES, MEMBERS).sum(axis=1) + MEMBERS - 1
        tokens[SINGLES + SUFFIXES : SINGLES + 2 * SUFFIXES] += tail[:, 1].reshape(SUFFIXES, MEMBERS).sum(axis=1)
        self.of_class[self.end], count[self.end] = END, ends
        whole = np.log10(np.maximum(tokens + words + 1, 1))
        self.known = count > 0
        self.base = np.log10(count + 1)
        self.inner = self.base - whole[self.of_class]
        alone = (self.of_class < SINGLES) | (self.of_class == END)
        self.inner[alone] = 0.0

    def numbers(self, words: pa.Array) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, words.to_numpy(zero_copy_only=False)), np.int64, len(words))


_TOKENS_SCHEMA = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_top", pa.int64()),
    ("base_top", pa.float64()), ("inner_top", pa.float64()), ("kinds", pa.binary()), ("members", pa.binary()), ("slots", pa.binary()),
    ("rare", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64()), ("fresh", pa.int64())]))),
])
_TOKENS_DDL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_top long, base_top double, inner_top double, kinds binary, "
    "members binary, slots binary, rare array<struct<word: binary, n: bigint, fresh: bigint>>"
)


def _bytes(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values of all texts, up to each text's end, as one binary a text."""
    at = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(values)])


def _read(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """What training and scoring need of each text, so it is split once: the
    class and member (one byte each) and slot (two bytes) of each token, sums over its words
    among the commonest, and its other words."""
    vocab, row = held.value, TaskContext.get().partitionId() << 40
    kind_of, member_of, slot_of = vocab.of_class.astype(np.uint8), vocab.of_member.astype(np.uint8), vocab.slot.astype("<u2")
    for b in batches:
        for lo, hi in chunks(pc.binary_length(b.column("raw")).to_pylist(), 1 << 20):
            size = hi - lo
            words, sizes = split(b.column("raw").slice(lo, size))
            coded = words.dictionary_encode()
            distinct = coded.dictionary.view(pa.binary())
            ends = np.cumsum(sizes + 1)
            begin = ends - sizes - 1
            # Which of the distinct words each token is; an end is none of them.
            which = np.full(ends[-1], -1, np.int32)
            is_word = np.ones(len(which), bool)
            is_word[ends - 1] = False
            which[is_word] = np.array(coded.indices)
            at = np.append(vocab.numbers(distinct), vocab.end)[which]
            again = np.zeros(len(which), bool)
            again[1:] = (which[1:] == which[:-1]) & is_word[1:]
            kind = kind_of[at]
            kind[again] = AGAIN
            inner = vocab.inner[at]
            inner[again] = 0.0
            # Words outside the commonest, one row for each text and word.
            places = np.flatnonzero((at >= vocab.first_rare) & (at < vocab.end))
            text = np.searchsorted(ends, places, side="right")
            pairs, own, n = np.unique(text * len(distinct) + which[places], return_inverse=True, return_counts=True)
            repeated = np.bincount(own[again[places]], minlength=len(pairs))
            text, word = np.divmod(pairs, max(1, len(distinct)))
            rare = pa.StructArray.from_arrays(
                [distinct.take(pa.array(word)), pa.array(n, pa.int64()), pa.array(n - repeated, pa.int64())], ["word", "n", "fresh"]
            )
            until = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))]).astype(np.int32)
            columns = {
                "row": np.arange(row, row + size), "doc_id": b.column("doc_id").slice(lo, size), "held_out": b.column("held_out").slice(lo, size),
                "n_tokens": sizes + 1, "n_top": np.add.reduceat(vocab.known[at].astype(np.int64), begin),
                "base_top": np.add.reduceat(vocab.base[at], begin), "inner_top": np.add.reduceat(inner, begin),
                "kinds": _bytes(kind, ends), "members": _bytes(member_of[at], ends), "slots": _bytes(slot_of[at], ends),
                "rare": pa.ListArray.from_arrays(pa.array(until), rare),
            }
            yield record_batch(columns, _TOKENS_SCHEMA)
            row += size


def contexts(kinds: list[bytes], slots: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Class and the rows of the three features (n x 3) of all tokens."""
    sizes = np.array([len(k) for k in kinds], np.int64)
    before = bytes([END, END])  # two starts; their slot, 0, is no word's
    kind = np.frombuffer(before + before.join(kinds), np.uint8)
    slot = np.frombuffer(bytes(4) + bytes(4).join(slots), "<u2")
    token = np.ones(len(kind), bool)
    begin = np.cumsum(sizes + 2) - sizes - 2
    token[begin] = token[begin + 1] = False
    i = np.flatnonzero(token)
    code = kind.astype(np.int64)
    pair = ((code[i - 1] * CLASSES + code[i - 2]) * 0x9E3779B1 >> 7) % SLOTS
    rows = np.empty((len(i), 3), np.int64)
    rows[:, 0] = slot[i - 1]
    rows[:, 1] = slot[i - 2]
    rows[:, 1] += SLOTS
    rows[:, 2] = pair + 2 * SLOTS
    return code[i], rows


class Model:
    def __init__(self, met: np.ndarray):
        """From sums of how often each feature row met each class."""
        self.met = met
        share = met[:SLOTS].sum(axis=0) + 1.0
        share /= share.sum()
        self.bias = np.log(share).astype(np.float32)
        row = met.sum(axis=1, keepdims=True)
        self.weights = (np.log((met + PRIOR * share) / ((row + PRIOR) * share)) / 3).astype(np.float32)
        self.factors = np.exp(self.weights)
        self.factors[2 * SLOTS :] = np.exp(self.weights[2 * SLOTS :] + self.bias)  # a token has one row of each feature

    def step(self, block: int, expected: np.ndarray) -> None:
        """Moves the weights of one feature along their gradient, scaled by
        the mean of what the data and the model say."""
        own = slice(block * SLOTS, (block + 1) * SLOTS)
        met = self.met[own]
        w = self.weights[own] + (met - expected) / ((met + expected) / 2 + PRIOR)
        self.weights[own] = np.clip(w, -MOST_WEIGHT, MOST_WEIGHT)
        self.factors[own] = np.exp(self.weights[own] + self.bias if block == 2 else self.weights[own])

    def scores(self, rows: np.ndarray, out: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The exponentials of each class's sum of weights, into ``out``, as
        the product of theirs. Sums are under 3 * ``MOST_WEIGHT``, so they need no
        shift."""
        n = len(rows)
        z, t = out[:n], part[:n]
        np.take(self.factors, rows[:, 0], axis=0, out=z, mode="clip")
        for k in (1, 2):
            np.take(self.factors, rows[:, k], axis=0, out=t, mode="clip")
            z *= t
        return z

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        z = self.scores(rows, *(np.empty((len(rows), CLASSES), np.float32) for _ in range(2)))
        return z / z.sum(axis=1, keepdims=True)


def inside(kind: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which tokens are of a class of many words; their class among these and
    the rows of the three features together with it."""
    at = np.flatnonzero((kind >= SINGLES) & (kind < SINGLES + KINDS))
    own = kind[at] - SINGLES
    block = np.arange(3)
    feature = (rows[at] - block * SLOTS) * KINDS + own[:, None] + 1
    return at, own, (feature * 0x9E3779B1 >> 11) % INSIDE + block * INSIDE


class Inside:
    """Weights of the members of each class of many words."""

    def __init__(self, mass: np.ndarray, met: np.ndarray):
        """From the members' masses and the sums of members and classes that
        each feature row met."""
        total = mass.sum(axis=1, keepdims=True)
        share = np.divide(mass, total, out=np.zeros_like(mass), where=total > 0)
        self.log_share = np.log(np.maximum(share, 1e-26)).astype(np.float32)  # no word: no weight
        expected = met[:, MEMBERS:] @ share
        row = np.maximum(met[:, MEMBERS:].sum(axis=1, keepdims=True), 1)
        prior = MEMBER_PRIOR * expected / row
        some = expected > 0
        ratio = np.divide(met[:, :MEMBERS] + prior, expected + prior, out=np.ones_like(expected), where=some)
        weights = (np.clip(np.log(np.maximum(ratio, 1e-9)), -MOST_WEIGHT, MOST_WEIGHT) / 3).astype(np.float32)
        self.share, self.factors = np.exp(self.log_share), np.exp(weights)

    def scores(self, own: np.ndarray, rows: np.ndarray, out: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The exponentials of each member's sum of weights, into ``out``, as
        the product of theirs and the member's share."""
        n = len(rows)
        z, t = out[:n], part[:n]
        np.take(self.share, own, axis=0, out=z, mode="clip")
        for k in range(3):
            np.take(self.factors, rows[:, k], axis=0, out=t, mode="clip")
            z *= t
        return z

    def gain(self, kind: np.ndarray, member: np.ndarray, rows: np.ndarray, out: np.ndarray, part: np.ndarray) -> np.ndarray:
        """For each token log10 of its member's probability over the member's
        share of the class; 0 for a class of one word."""
        gain = np.zeros(len(kind))
        at, own, rows = inside(kind, rows)
        mine = member[at]
        for a in range(0, len(at), _TOKENS):
            z = self.scores(own[a : a + _TOKENS], rows[a : a + _TOKENS], out, part)
            m = mine[a : a + _TOKENS]
            p = z[np.arange(len(z)), m] / (z @ _MEMBER_ONES)
            gain[at[a : a + _TOKENS]] = np.log10(np.maximum(p, 1e-38)) - self.log_share[own[a : a + _TOKENS], m] / np.log(10)
        return gain


_MEMBER_ONES = np.ones(MEMBERS, np.float32)
_SUM = pa.schema([("slot", pa.int32()), ("cells", pa.binary())])
_SUM_DDL = "slot int, cells binary"


def _sum_rows(total: np.ndarray) -> pa.RecordBatch:
    """The rows of a table of sums that are not empty, each as one binary."""
    at = np.flatnonzero(total.any(axis=1))
    cells = np.ascontiguousarray(total[at], "<i8")
    return record_batch({"slot": at, "cells": _bytes(cells.ravel(), np.arange(1, len(at) + 1) * total.shape[1])}, _SUM)


def _add_rows(total: np.ndarray, b: pa.RecordBatch | pa.Table) -> None:
    for slot, cells in zip(b.column("slot").to_pylist(), b.column("cells").to_pylist(), strict=True):
        total[slot] += np.frombuffer(cells, "<i8")


def _add(batches: Iterator[pa.RecordBatch], height: int, width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((height, width), np.int64)
    for b in batches:
        _add_rows(total, b)
    yield _sum_rows(total)


def _summed(rows: DataFrame, height: int, width: int) -> np.ndarray:
    """The tasks' rows of sums, dealt by their number (under ``height``), added
    and collected: ``height`` rows at most."""
    got = rows.repartition("slot").mapInArrow(lambda it: _add(it, height, width), _SUM_DDL).toArrow()
    out = np.zeros((height, width), np.int64)
    _add_rows(out, got)
    return out.astype(np.float64)


def _inside_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each feature row inside the classes met each member and class."""
    total = np.zeros((3 * INSIDE, WIDTH), np.int64)
    for b in batches:
        kinds, members, slots = (b.column(n).to_pylist() for n in ("kinds", "members", "slots"))
        for lo, hi in chunks([len(k) for k in kinds], 1 << 18):
            kind, rows = contexts(kinds[lo:hi], slots[lo:hi])
            at, own, rows = inside(kind, rows)
            mine = np.frombuffer(b"".join(members[lo:hi]), np.uint8)[at]
            for k in range(3):
                block = total[k * INSIDE : (k + 1) * INSIDE]
                first = (rows[:, k] - k * INSIDE) * WIDTH
                met = np.concatenate([first + mine, first + (MEMBERS + own)])
                block += np.bincount(met, minlength=INSIDE * WIDTH).reshape(INSIDE, WIDTH)
    yield _sum_rows(total)


def train_inside(tokens: DataFrame, vocab: Vocabulary) -> Inside:
    """The members' weights from the texts in ``tokens`` that are not held out."""
    rows = tokens.where(~F.col("held_out")).select("kinds", "members", "slots").mapInArrow(_inside_sums, _SUM_DDL)
    met = _summed(rows, 3 * INSIDE, WIDTH)
    return Inside(vocab.mass, met)


_ONES = np.ones(CLASSES, np.float32)


def _sums(batches: Iterator[pa.RecordBatch], model, block: int) -> Iterator[pa.RecordBatch]:
    """Sums over a task's texts, a row for each feature row: how often it met
    each class, or for the rows of one feature what the model expects."""
    total = np.zeros((ROWS if model is None else SLOTS, CLASSES), np.int64 if model is None else np.float64)
    out, part = (np.empty((_TOKENS, CLASSES), np.float32) for _ in range(2))
    for b in batches:
        kinds, slots = b.column("kinds").to_pylist(), b.column("slots").to_pylist()
        for lo, hi in chunks([len(k) for k in kinds], 1 << 18):
            kind, rows = contexts(kinds[lo:hi], slots[lo:hi])
            if model is None:
                for k in range(3):
                    own = total[k * SLOTS : (k + 1) * SLOTS]
                    own += np.bincount((rows[:, k] - k * SLOTS) * CLASSES + kind, minlength=SLOTS * CLASSES).reshape(SLOTS, CLASSES)
                continue
            # Sorted by the feature in question: its tokens are neighbours, so
            # they are summed without being moved.
            own = (rows[:, block] - block * SLOTS).astype(np.int16)
            order = np.argsort(own, kind="stable")
            own, rows = own[order], rows[order]
            for a in range(0, len(own), _TOKENS):
                z = model.value.scores(rows[a : a + _TOKENS], out, part)
                z *= (1 / (z @ _ONES))[:, None]
                mine = own[a : a + _TOKENS]
                first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                total[mine[first]] += np.add.reduceat(z, first, axis=0)
    if model is not None:
        total = np.rint(total * SCALE).astype(np.int64)
    yield _sum_rows(total)


def _gather(tokens: DataFrame, model, block: int = 0) -> np.ndarray:
    rows = tokens.where(~F.col("held_out")).select("kinds", "slots").mapInArrow(lambda it: _sums(it, model, block), _SUM_DDL)
    out = _summed(rows, ROWS if model is None else SLOTS, CLASSES)
    return out / (1 if model is None else SCALE)


def _commonest(counts: DataFrame, most: int) -> DataFrame:
    """The commonest words, ``most`` at most: whole steps of the counts'
    logarithm from the top, so no task sends more than its own share of them
    (a sorted limit would send ``most`` rows from each partition)."""
    step = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()  # 64 steps for each power of two
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        total += r["words"]
        if total > most:
            break
        least = r["step"]
    return counts.where(step >= least) if least is not None else counts.limit(0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary of the words' counts, of which ``TOP`` are collected."""
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = [(bytes(r["word"]), r["c"]) for r in _commonest(counts, TOP).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    if n_words > len(top) and all(w != _END_WORD for w, _ in top):
        top += [(_END_WORD, r["c"]) for r in counts.where(F.length("word") == 0).collect()]
    tail = np.zeros((SUFFIXES * MEMBERS, 2))
    shares = counts.where(F.length("word") > 0).select("word", "c").mapInArrow(_shares, "leaf int, words long, tokens long")
    for r in shares.groupBy("leaf").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).collect():
        tail[r["leaf"]] = r["words"], r["tokens"]
    for w, c in [(w, c) for w, c in top if w != _END_WORD][:TIER]:  # not of the tail
        tail[leaf(w)] -= 1, c
    return Vocabulary(top, tail, n_tokens, n_words)


def read_tokens(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The texts of ``docs`` (doc_id, held_out, raw) as classes and slots, a
    written table."""
    held = docs.sparkSession.sparkContext.broadcast(vocab)
    return stored(docs.mapInArrow(lambda it: _read(it, held), _TOKENS_DDL), "lm-tokens")


def train(tokens: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of the texts in ``tokens`` that are not held out."""
    model = Model(_gather(tokens, None))
    for _ in range(rounds):
        for block in range(3):
            held = tokens.sparkSession.sparkContext.broadcast(model)
            model.step(block, _gather(tokens, held, block))
    return model


# --- scores --------------------------------------------------------------------------------------------

_SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_top", pa.int64()),
    ("base_top", pa.float64()), ("score_top", pa.float64()),
])
_SCORED_DDL = "row long, doc_id long, held_out boolean, n_tokens long, n_top long, base_top double, score_top double"


def _score(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model, members_of = held.value
    out, part = (np.empty((_TOKENS, CLASSES), np.float32) for _ in range(2))
    room = [np.empty((_TOKENS, MEMBERS), np.float32) for _ in range(2)]
    for b in batches:
        kinds, members, slots = (b.column(n).to_pylist() for n in ("kinds", "members", "slots"))
        found = []
        for lo, hi in chunks([len(k) for k in kinds], 1 << 18):
            kind, rows = contexts(kinds[lo:hi], slots[lo:hi])
            p = np.empty(len(kind))
            for a in range(0, len(kind), _TOKENS):
                z = model.scores(rows[a : a + _TOKENS], out, part)
                p[a : a + _TOKENS] = z[np.arange(len(z)), kind[a : a + _TOKENS]] / (z @ _ONES)
            sizes = np.array([len(k) for k in kinds[lo:hi]])
            each = np.log10(np.maximum(p, 1e-38))
            each += members_of.gain(kind, np.frombuffer(b"".join(members[lo:hi]), np.uint8), rows, *room)
            found.append(np.add.reduceat(each, np.cumsum(sizes) - sizes))
        score = np.concatenate(found) + np.array(b.column("inner_top")) if found else []
        columns = {n: b.column(n) for n in ("row", "doc_id", "held_out", "n_tokens", "n_top", "base_top")}
        yield record_batch(columns | {"score_top": score}, _SCORED)


def score(tokens: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Model, members_of: Inside) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for each text of ``tokens``."""
    weights = tokens.sparkSession.sparkContext.broadcast((model, members_of))
    scored = tokens.drop("rare").mapInArrow(lambda it: _score(it, weights), _SCORED_DDL)
    rare = tokens.select("row", F.inline("rare")).join(counts, "word")
    gain = F.log10(F.col("c") + 1)
    found = rare.groupBy("row").agg(
        F.sum("n").alias("n_rare"), F.sum(F.col("n") * gain).alias("base_rare"), F.sum(F.col("fresh") * gain).alias("score_rare")
    )
    each = float(np.log10(vocab.n_tokens + vocab.n_words + 1))
    zero = F.lit(0.0)
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(vocab.n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base_top") + F.coalesce("base_rare", zero) - F.col("n_tokens") * each).alias("base_score"),
        (F.col("score_top") + F.coalesce("score_rare", zero)).alias("score"),
    )


def scored_texts(docs: DataFrame) -> DataFrame:
    """``score`` of ``docs`` (doc_id, text) under a model of those of them
    that are not held out."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), raw_text().alias("raw")
    )
    counts = stored(word_counts(rows.where(~F.col("held_out"))), "lm-counts")
    vocab = vocabulary(counts)
    tokens = read_tokens(rows, vocab)
    return score(tokens, counts, vocab, train(tokens), train_inside(tokens, vocab))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_texts(table(spark, sf_dir, "documents"))
