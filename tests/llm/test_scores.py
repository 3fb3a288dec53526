"""LM scores, the quality classifier and fingerprints."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF0001
from sessionlens.llm import op2_maxent_lm as op2
from sessionlens.llm import op3_quality as op3
from sessionlens.llm import op9_digest as op9
from sessionlens.llm.common import table

from llm.conftest import ODD_TEXTS


def words_of(text):
    return (text or "").encode().lower().split() + [b""]


def check_base(rows, got):
    def held(doc):
        return zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2

    counts = Counter(w for d, t in rows if not held(d) for w in words_of(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for d, t in rows:
        w = words_of(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        expected[d, held(d), len(w), sum(counts[x] > 0 for x in w), n, round(base, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == expected


def lm(docs):
    return op2.scored_texts(docs).collect()


def test_lm_on_the_tables(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = lm(table(spark, SF001, "documents"))
    check_base(rows, got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    # The model is a distribution: classes sum to one, and the words of a class
    # leave room for its unknown word.
    counts = op2.stored(op2.word_counts(table(spark, SF001, "documents").select(op2.raw_text().alias("raw"))), "test-lm")
    vocab = op2.vocabulary(counts)
    tokens = table(spark, SF001, "documents").select("doc_id", F.lit(False).alias("held_out"), op2.raw_text().alias("raw"))
    tokens = op2.read_tokens(tokens, vocab)
    model = op2.Model(op2._gather(tokens, None))
    p = model.probabilities(np.random.default_rng(1).integers(0, op2.SLOTS, (50, 3)) + np.arange(3) * op2.SLOTS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    # The sums of each feature's expectation over the data match its total.
    spread = op2._gather(tokens, spark.sparkContext.broadcast(model), 1)
    assert np.allclose(spread.sum(axis=1), model.met[op2.SLOTS : 2 * op2.SLOTS].sum(axis=1), rtol=1e-3, atol=1e-2)
    inner = np.bincount(vocab.of_class[1 : vocab.first_rare], 10 ** vocab.inner[1 : vocab.first_rare], minlength=op2.CLASSES)
    assert (inner <= 1 + 1e-9).all()
    # Words outside the commonest take their count from the join: the same
    # scores come out when nearly all words are outside.
    monkeypatch.setattr(op2, "TOP", op2.TIER + 100)
    few = lm(table(spark, SF001, "documents"))
    check_base(rows, few)
    assert sum(r.score for r in few if r.held_out) > sum(r.base_score for r in out)


def test_lm_of_odd_rows(spark, docs_of):
    got = lm(docs_of(ODD_TEXTS))
    check_base(ODD_TEXTS, got)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm(docs_of([])) == []


def test_lm_context_chooses_inside_a_class(spark, docs_of):
    # Two words of one class and count, each after its own word: the class is
    # the same, so only the choice inside it tells them apart.
    singles = " ".join(f"w{i:02d}" for i in range(op2.SINGLES)) + " "
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert op2.suffix(b"kaza") == op2.suffix(b"roza")
    ids = ids[: len(ids) // 2 * 2]
    rows = [(i, singles * 3 + ("left kaza" if n % 2 else "right roza")) for n, i in enumerate(ids)]
    rows += [(held[0], "left kaza"), (held[1], "left roza"), (held[2], "right roza"), (held[3], "right kaza")]
    got = {r.doc_id: r.score for r in lm(docs_of(rows)) if r.held_out}
    assert got[held[0]] > got[held[1]] + 0.3 and got[held[2]] > got[held[3]] + 0.3


def test_lm_members_are_a_distribution(spark):
    docs = table(spark, SF0001, "documents").select("doc_id", F.lit(False).alias("held_out"), op2.raw_text().alias("raw"))
    vocab = op2.vocabulary(op2.stored(op2.word_counts(docs), "test-lm-members"))
    tokens = op2.read_tokens(docs, vocab)
    inside = op2.train_inside(tokens, vocab)
    random = np.random.default_rng(3)
    rows = random.integers(0, op2.INSIDE, (60, 3)) + np.arange(3) * op2.INSIDE
    own = random.integers(0, op2.KINDS, 60)
    room = [np.empty((60, op2.MEMBERS), np.float32) for _ in range(2)]
    p = inside.scores(own, rows, *room).astype(float)
    assert np.isfinite(p).all() and (p.sum(axis=1) > 0).all()
    # The shares of a class's members sum to one, and its words with those of
    # its members: what the class's share of a word is made of.
    shares = np.exp(inside.log_share.astype(float))
    assert np.allclose(shares[vocab.mass.sum(axis=1) > 0].sum(axis=1), 1, atol=1e-4)
    for k in range(op2.SUFFIXES, op2.KINDS):
        words = np.flatnonzero(vocab.of_class[1 : vocab.first_rare] == op2.SINGLES + k) + 1
        words = words[vocab.known[words]]
        mine = np.bincount(vocab.of_member[words], 10 ** vocab.base[words], minlength=op2.MEMBERS)
        assert np.allclose(mine + 1, vocab.mass[k])  # all words are listed here
        assert (10 ** vocab.inner[words]).sum() + op2.MEMBERS / vocab.mass[k].sum() == pytest.approx(1)


def test_lm_splits_as_words_are_defined():
    texts = [b"", b" ", b" a  B ", b"\x0ba\x1cb\x0c C\n\n", b"\xff\xfeA B\xc0 \xa0x", b"A\x00B c\r", "É\u00a0Éa b\u2003c \u0085d".encode(), b"\t\n"]
    whole = pa.array([b"cut off", *texts, b"cut off"], pa.binary())
    words, sizes = op2.split(whole.slice(1, len(texts)))
    assert words.view(pa.binary()).to_pylist() == [w for t in texts for w in t.lower().split()]
    assert sizes.tolist() == [len(t.lower().split()) for t in texts]
    words, sizes = op2.split(pa.array([], pa.binary()))
    assert len(words) == len(sizes) == 0


def test_lm_counts_words_of_any_number_of_batches(monkeypatch):
    monkeypatch.setattr(op2, "FLUSH_BYTES", 100)
    texts = [b"a b A", b"", b"c \xff a"] * 40
    batches = [pa.record_batch({"raw": pa.array(texts[a : a + 7], pa.binary())}) for a in range(0, len(texts), 7)]
    got = Counter()
    for b in op2._count(iter([*batches, batches[0].slice(0, 0)])):
        got.update(dict(zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True)))
    assert got == Counter(w for t in texts for w in [*t.lower().split(), b""])
    assert not list(op2._count(iter([])))


def test_lm_looks_up_distinct_words_only(monkeypatch):
    looked_up = []

    class Counting(op2.Vocabulary):
        def numbers(self, words):
            looked_up.append(len(words))
            return super().numbers(words)

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)  # noqa: N815

    class Held:
        value = Counting([(b"a", 50), (b"", 40), (b"b", 30)], np.zeros((op2.SUFFIXES * op2.MEMBERS, 2)), 120, 3)

    monkeypatch.setattr(op2, "TaskContext", Task)
    texts = [b"a a B x", b"", b"x x y a x", b"  ", b"b"] * 30
    ids = list(range(len(texts)))
    batch = pa.record_batch({"doc_id": pa.array(ids), "held_out": pa.array([False] * len(ids)), "raw": pa.array(texts, pa.binary())})
    rows = pa.Table.from_batches(op2._read(iter([batch]), Held)).to_pylist()
    assert sum(looked_up) == 4
    assert [r["row"] for r in rows] == [(3 << 40) + i for i in ids] and [r["doc_id"] for r in rows] == ids
    vocab = Held.value
    for text, row in zip(texts, rows, strict=True):
        words = text.lower().split()
        at = [vocab.number[w] for w in words] + [vocab.end]
        again = [i > 0 and i < len(words) and words[i] == words[i - 1] for i in range(len(at))]
        kinds = [op2.AGAIN if g else vocab.of_class[a] for a, g in zip(at, again, strict=True)]
        assert list(row["kinds"]) == kinds and row["n_tokens"] == len(at)
        assert list(row["members"]) == vocab.of_member[at].tolist()
        assert np.frombuffer(row["slots"], "<u2").tolist() == vocab.slot[at].tolist()
        assert row["n_top"] == sum(vocab.known[at]) and row["base_top"] == pytest.approx(sum(vocab.base[at]))
        assert row["inner_top"] == pytest.approx(sum(vocab.inner[a] for a, g in zip(at, again, strict=True) if not g))
        rare = Counter(w for w in words if w in (b"x", b"y"))
        fresh = Counter(w for w, g in zip(words, again[:-1], strict=True) if w in (b"x", b"y") and not g)
        assert {r["word"]: (r["n"], r["fresh"]) for r in row["rare"]} == {w: (n, fresh[w]) for w, n in rare.items()}


def test_lm_adds_the_sums_of_tasks():
    sums = np.random.default_rng(7).integers(-(1 << 60), 1 << 60, (3, 50, 5)) // 3
    sums[:, ::4] = 0
    rows = [op2._sum_rows(x) for x in [*sums, np.zeros((50, 5), np.int64)]]
    assert rows[3].num_rows == 0 and 0 not in rows[0].column("slot").to_pylist()
    (added,) = op2._add(iter(rows), 50, 5)
    out = np.zeros((50, 5), np.int64)
    op2._add_rows(out, added)
    assert (out == sums.sum(axis=0)).all()


def test_lm_takes_no_exponential_for_a_token(monkeypatch):
    random = np.random.default_rng(5)
    model = op2.Model(random.integers(0, 9, (op2.ROWS, op2.CLASSES)).astype(float))
    for block in range(3):
        model.step(block, random.random((op2.SLOTS, op2.CLASSES)) * 9)
    inside = op2.Inside(random.random((op2.KINDS, op2.MEMBERS)) * 50, random.integers(0, 9, (3 * op2.INSIDE, op2.WIDTH)).astype(float))
    rows = random.integers(0, op2.SLOTS, (40, 3)) + np.arange(3) * op2.SLOTS
    own = random.integers(0, op2.KINDS, 40)
    plain = np.exp(model.weights.astype(float)[rows].sum(axis=1) + model.bias)
    monkeypatch.setattr(op2.np, "exp", None)
    p = model.probabilities(rows)
    assert np.allclose(p, plain / plain.sum(axis=1, keepdims=True), rtol=1e-5)
    z = inside.scores(own, rows, *(np.empty((40, op2.MEMBERS), np.float32) for _ in range(2)))
    assert np.isfinite(z).all() and (z > 0).all()


def test_quality_on_held_out_rows(spark):
    got = op3.query(spark, SF001).join(table(spark, SF001, "labels"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(out) > 40 and sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = table(spark, SF0001, "documents"), table(spark, SF0001, "labels")
    other = labels.withColumn("quality", F.when(op3.remainder("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(op3.fit(docs, labels), op3.fit(docs, other))


def test_quality_score_is_a_sparse_dot_product(spark, docs_of):
    docs, labels = table(spark, SF0001, "documents"), table(spark, SF0001, "labels")
    w = op3.fit(docs, labels)
    rows = docs_of(ODD_TEXTS)
    got = op3.score(rows.withColumn("raw", op3.raw_text()).select("doc_id", "text", "raw"), w).collect()
    assert len(got) == len(ODD_TEXTS)
    for r in got:
        at, x = op3.features((r.text or "").encode(), op3._Units())
        assert len(set(at.tolist())) == len(at)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(sum(w[i] * v for i, v in zip(at, x)) + w[-1]))), abs=1e-12)


def test_quality_features_leave_in_small_batches(monkeypatch):
    # Features are several times a text's size: a batch of texts is cut, and
    # what earlier operators kept in the worker is given back first.
    import pyarrow as pa

    from sessionlens.llm import common, tokens

    tokens.encoder()
    assert common._KEPT
    texts = [(f"word{i} " * 3000).encode() for i in range(40)] + [b""]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"shard": [0] * n, "rank": list(range(n)), "label": [1] * n, "raw": texts})
    monkeypatch.setattr(op3, "CHUNK_BYTES", 1 << 16)
    got = list(op3._featurise(iter([batch])))
    assert not common._KEPT
    assert len(got) > 10 and [r for b in got for r in b.column("rank").to_pylist()] == list(range(n))
    at, x = op3.features(texts[7], op3._Units())
    row = [r for b in got for r in b.to_pylist()][7]
    assert row["slots"] == at.astype("<i4").tobytes() and row["values"] == x.astype("<f4").tobytes()


def test_quality_without_labels(spark, docs_of):
    none = spark.createDataFrame([(3, None), (None, 1)], "doc_id long, quality int")
    w = op3.fit(docs_of(ODD_TEXTS), none)
    assert not w.any()
    kept = op3.accepted(docs_of(ODD_TEXTS), none)
    assert kept.columns == docs_of([]).columns and kept.count() == len(ODD_TEXTS)
    assert op3.accepted(docs_of([]), none).count() == 0


def slow_digest(data):
    counts = [0] * 256
    for i in range(4, len(data)):
        for (a, b, c), salt in zip(op9._TRIPLETS, op9._SALTS):
            h = sum(data[i - o] * m for o, m in zip((a, b, c), op9._MULTIPLIERS)) + salt
            counts[(h % 2**32) >> 24] += 1
    ranked = sorted(counts)
    q1, q2, q3 = ranked[63], ranked[127], ranked[191]
    length = min(255, int(math.log(len(data) + 1) / math.log(1.1)))
    head = [zlib.crc32(data) & 255, length, q1 * 16 // (q3 + 1) % 16, q2 * 16 // (q3 + 1) % 16]
    return head + [(c > q1) + (c > q2) + (c > q3) for c in counts]


def test_digest_equals_plain_counting():
    for text in ("", "abc", "abcd", "abcde", "the quick brown fox jumps over the lazy dog " * 30, "ä你" * 400):
        data = text.encode()
        d = op9.digest(data)
        assert d.tolist() == slow_digest(data)
        assert op9.parse(op9.as_text(d)).tolist() == d.tolist()
        assert op9.likeness(d, d) == 1.0


def check_fingerprints(rows, got):
    """Each row with its successor by descending id (nulls last, ties by text)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    expected = Counter()
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        new = text[: len(text) - n] + after[:n]
        a, b, c = (op9.digest(t.encode()) for t in (text, new, after))
        sha = hashlib.sha256(new.encode()).hexdigest()
        expected[doc, len(text), sha, op9.as_text(a), op9.as_text(b), op9.likeness(a, b), op9.likeness(a, c)] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_fingerprints_of_odd_rows(spark, docs_of):
    rows = [r for r in ODD_TEXTS if r[0] != 14]
    for ranges in (1, 3, 1000):
        check_fingerprints(rows, op9.fingerprints(docs_of(rows), ranges).collect())
    check_fingerprints([(1, "alone")], op9.fingerprints(docs_of([(1, "alone")])).collect())
    assert op9.fingerprints(docs_of([])).collect() == []


def test_fingerprints_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    for ranges in (7, 1024):
        got = op9.fingerprints(table(spark, SF001, "documents"), ranges).collect()
        check_fingerprints(rows, got)
    assert sum(r.near_edited > r.near_next for r in got) / len(got) > 0.97


def test_quality_sample_is_full_whatever_else_the_labels_hold(spark, docs_of, monkeypatch):
    """Null, held-out and repeated labels do not use up the sample."""
    monkeypatch.setattr(op3, "SAMPLE_ROWS", 60)
    seen = []
    kept = op3.stored
    monkeypatch.setattr(op3, "stored", lambda df, name: seen.append((name, kept(df, name))) or seen[-1][1])
    docs = docs_of([(i, f"text number {i} of many") for i in range(400)])
    rows = [(i, i % 2) for i in range(400)] * 30 + [(i, None) for i in range(5000)]
    op3.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert [df.count() for name, df in seen if name == "quality-sample"][-1] == 60


def test_an_id_is_one_example_in_training(spark, docs_of):
    rows = [(i, f"{'good plain words here' if i % 2 else '### !!! 123'} number {i}") for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    once = op3.fit(docs_of(rows), labels)
    again = op3.fit(docs_of(rows + [rows[6]] * 3000 + [rows[11]] * 500), labels)
    assert (once == again).all()
