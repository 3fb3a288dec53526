"""Token files, packing and token counts against plain encoding and greedy matching."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF0001
from sessionlens import runtime
from sessionlens.llm import common
from sessionlens.llm import op1_token_index as op1
from sessionlens.llm import op4_packing as op4
from sessionlens.llm import op6_token_counts as op6
from sessionlens.llm.common import table
from sessionlens.llm.tokens import TOKENIZER, WordEncoder

from llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path(TOKENIZER)
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text, end):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TRICKY = ("<|endoftext|>", "<|endoftext|", "a<|endoftext|>b", "<|", "|>", "<|startoftext|>", "\xa0", "x\xa0", "\u3000y", "don't", "i'll", "3.5", "é", "ÉÈ", "word", "\x00", "ﬁ", "你好")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(TRICKY), max_size=12).map(" ".join)), max_size=6))
def test_words_encode_like_whole_texts(texts):
    enc = WordEncoder(PATH)
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode([t.encode("utf-8", "replace") for t in texts])]
    whole = [t.encode("utf-8", "replace").decode() for t in texts]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in whole]


def expected_index(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    starts, at = [], 0
    by_key = defaultdict(list)
    for doc, text in order:
        ids = ids_of(text, op1.END_ID)
        by_key[doc].append((len(ids), crc(ids)))
        at += len(ids)
    return by_key, at


def test_index_holds_every_row(spark, docs_of):
    folder = runtime.table_path(spark, "test-index")
    manifest = op1.write_index(docs_of(ODD_TEXTS), folder, shard_bytes=64)
    got = op1.read_index(manifest, folder).collect()
    by_key, total = expected_index(ODD_TEXTS)
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in by_key.items()}
    # Starts are gapless in key order, and equal ids are told apart.
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.concatenate([[0], np.cumsum([r.n_tokens for r in ordered])[:-1]]).tolist()
    assert [(r.doc_id is not None, r.doc_id or 0, r.copy) for r in ordered] == sorted((r.doc_id is not None, r.doc_id or 0, r.copy) for r in ordered)
    assert sum(r.n_tokens for r in got) == total
    assert manifest.count() > 1  # several shards


def test_index_gives_documents_by_key(spark, docs_of):
    folder = runtime.table_path(spark, "test-index")
    rows = [(i * 3, f"document number {i}") for i in range(300)]
    manifest = op1.write_index(docs_of(rows), folder)
    got = op1.fetch(manifest, folder, [0, 30, 897, 1, 5000])
    assert got[1] is None and got[5000] is None
    for doc in (0, 30, 897):
        assert got[doc].tolist() == ids_of(rows[doc // 3][1], op1.END_ID)


def test_index_of_no_documents(spark, docs_of):
    folder = runtime.table_path(spark, "test-index")
    assert op1.read_index(op1.write_index(docs_of([]), folder), folder).collect() == []


def test_index_query_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op1.query(spark, SF0001).collect()}
    at = 0
    for doc, text in sorted(rows):
        ids = ids_of(text, 2)
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)


def test_paths_without_a_known_file_system_are_refused(spark, tmp_path):
    assert common.qualified(spark, str(tmp_path)).startswith("file:/")
    assert common.filesystem(common.qualified(spark, str(tmp_path)))[1] == str(tmp_path)
    for path in ("dbfs:/x/y", "/a/plain/path", "nosuch://x/y"):
        with pytest.raises((ValueError, OSError)):
            common.filesystem(path)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash_is_one_to_one(keys):
    keys = np.array(sorted(keys), np.uint64)
    index = op1.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))


def check_packing(rows, got, capacity, end, slack):
    by_doc = Counter()
    pieces = Counter()
    for doc, text in rows:
        ids = ids_of(text, end)
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            pieces[doc, k, s, len(part), crc(part)] += 1
        by_doc[doc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // capacity) * slack + 1


def test_packing_odd_rows(spark, docs_of):
    check_packing(ODD_TEXTS, op4.pack(docs_of(ODD_TEXTS)).collect(), 4096, 1, 1.05)
    assert op4.pack(docs_of([])).collect() == []


def test_packing_query_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").select("doc_id", "text").collect()]
    check_packing(rows, op4.query(spark, SF0001).collect(), 4096, 1, 1.02)


def test_packing_in_many_groups(spark, docs_of):
    """Small groups in many rounds need at most 1 per cent more sequences than
    one group that holds everything."""
    rng = np.random.default_rng(11)
    sizes = np.concatenate([rng.integers(1, 2040, 700), rng.integers(900, 1150, 500), rng.integers(1, 60, 300)])
    rows = [(i, "word " * int(n)) for i, n in enumerate(sizes)]
    docs = docs_of(rows).repartition(6)
    few = op4.pack(docs, capacity=2048, nearly=2, group_items=60).collect()
    check_packing(rows, few, 2048, 1, 1.1)
    whole = op4.pack(docs, capacity=2048, nearly=2).collect()
    assert len({r.sequence_id for r in few}) <= 1.01 * len({r.sequence_id for r in whole})


def test_complements_meet_in_one_group(spark):
    bins = [(i, f, bytes(10)) for i, f in enumerate([30] * 50 + [70] * 50 + [49] * 500 + [51] * 3 + [5, 95])]
    dealt, groups = op4._by_fill(spark.createDataFrame(bins, "sequence_id long, fill int, members binary"), 100, 120, 1 << 20)
    got = defaultdict(list)
    for r in dealt.collect():
        got[r.group].append(r.fill)
    assert set(got) == set(range(groups)) and sum(map(len, got.values())) == len(bins)
    assert sorted(next(g for g in got.values() if 30 in g)) == [5] + [30] * 50 + [70] * 50 + [95]
    assert sum(49 in g for g in got.values()) >= 4 and all(len(g) <= 170 for g in got.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit_takes_the_fullest_bin(sizes):
    bins = op4.best_fit(np.array(sizes, np.int64), 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    plain: list[int] = []
    for s in sorted(sizes, reverse=True):
        room = [k for k, fill in enumerate(plain) if fill + s <= 50]
        if room:
            plain[max(room, key=lambda k: plain[k])] += s
        else:
            plain.append(s)
    assert sorted(sum(sizes[i] for i in b) for b in bins) == sorted(plain)


def greedy(word, first, later):
    n, at = 0, 0
    while at < len(word):
        group = first if at == 0 else later
        end = next((e for e in range(len(word), at, -1) if word[at:e] in group), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), max_size=12),
       st.lists(st.text("abcd", max_size=14), max_size=8), st.booleans())
def test_automaton_counts_greedy_pieces(first, later, words, same):
    first, later = ({p.encode() for p in group} for group in (first, later))
    later = first if same else later
    counter = op6.PieceCounter(first, later)
    for w in words:
        w = w.encode()
        assert counter.count(w) == greedy(w, first, later)


def test_token_counts_of_odd_rows(spark, docs_of):
    pieces = set(op6.pieces_of(PATH))

    def expected(text):
        words = (text or "").encode().lower().split()
        return len(words), sum(greedy(w, pieces, pieces) if len(w) < 1000 else -1 for w in words)

    rows = [r for r in ODD_TEXTS if r[0] not in (14, 15)]
    got = Counter((r.doc_id, r.n_words, r.n_tokens) for r in op6.token_counts(docs_of(ODD_TEXTS)).collect() if r.doc_id not in (14, 15))
    assert got == Counter((d, *expected(t)) for d, t in rows)
    long = {r.doc_id: r for r in op6.token_counts(docs_of(ODD_TEXTS)).where("doc_id in (14, 15)").collect()}
    assert long[14].n_words == 60_000 and long[14].n_tokens == 60_000 * greedy(b"word", pieces, pieces)
    assert long[15].n_words == 1 and long[15].n_tokens > 0
    assert op6.token_counts(docs_of([])).collect() == []


@pytest.mark.parametrize("sf", [SF0001])
def test_token_counts_on_the_tables(spark, sf):
    pieces = set(op6.pieces_of(PATH))
    for r in op6.query(spark, sf).join(table(spark, sf, "documents"), "doc_id").collect():
        words = r.text.encode().lower().split()
        assert r.n_tokens == sum(greedy(w, pieces, pieces) for w in words)
