"""Merge replay against the tiktoken library, and the way back."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF0001
from sessionlens.llm import op12_byte_bpe as op12
from sessionlens.llm import pretokens
from sessionlens.llm.common import table

from llm.conftest import ODD_TEXTS

RANKS = op12.ranks(public_tokenizers.path(op12.RANKS))
WHOLE = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS.rank, special_tokens={})
PARTS = ("ab", "a", "b", " ", "  ", "\n", "'s", "'ll", "1", "é", "你", "\U0001f600", "՘", "\U0003fc3b", "\x1c", "\x85", "aaaa", "an", "_", "!!", "<|endoftext|>")


def payload(text):
    return np.array(WHOLE.encode_ordinary(text), "<u4").tobytes()


def replayed(text):
    split = pretokens.words(text)
    assert "".join(split) == text
    return b"".join(op12.encode_words([w.encode() for w in split], RANKS))


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)))
def test_replay_encodes_like_the_library(text):
    assert replayed(text) == payload(text)


@pytest.mark.parametrize("many", [1, 4, 1 << 30])
def test_long_words_at_once_and_in_order(monkeypatch, many):
    monkeypatch.setattr(op12, "_MANY", many)
    rng = np.random.default_rng(many % 7)
    words = ["".join(rng.choice(list("abnein"), n)) for n in rng.integers(0, 400, 80)] + ["y" * 70_000, "an" * 5000, ""]
    assert op12.encode_words([w.encode() for w in words], RANKS) == [payload(w) for w in words]


@pytest.mark.parametrize("many", [1, 1 << 30])
def test_lower_rank_made_by_a_merge_goes_first(monkeypatch, many):
    # 'aba' has a lower rank than 'ab': after the first merge of 'abab' it is
    # the lowest, before the second 'ab'.
    monkeypatch.setattr(op12, "_MANY", many)
    own = op12.Ranks(public_tokenizers.path(op12.RANKS))
    own.clear()
    own.rank = {bytes([b]): b for b in range(256)} | {b"aba": 300, b"ab": 301, b"cab": 302, b"abab": 303}
    own.piece = [b""] * 304
    for piece, rank in own.rank.items():
        own.piece[rank] = piece
    own.of_byte = np.arange(256)
    library = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=own.rank, special_tokens={})
    words = ["abab", "ababab", "cababab", "xab", "abcab", "aabab" * 9, "ab" * 40]
    want = [np.array(library.encode_ordinary(w), "<u4").tobytes() for w in words]
    assert op12.encode_words([w.encode() for w in words], own) == want


def test_memory_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(pretokens, "GENERATION_WORDS", 50)
    memory = pretokens.WordMemory(lambda part: [w.encode() for w in part])
    for k in range(0, 400, 20):
        wanted = {str(k + j) for j in range(30)}
        get = memory.know(wanted)
        assert {w: get(w) for w in wanted} == {w: w.encode() for w in wanted}
        assert len(memory.young) + len(memory.old) <= 2 * (50 + 30)


def test_odd_texts_there_and_back(spark, docs_of):
    coded = op12.decode(op12.encode(docs_of(ODD_TEXTS))).collect()
    want = Counter((doc, payload(text or ""), (text or "").encode()) for doc, text in ODD_TEXTS)
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in coded) == want
    assert op12.encode(docs_of([])).count() == 0


def test_whole_table(spark):
    rows = table(spark, SF0001, "documents").select("doc_id", "text").collect()
    want = {
        r.doc_id: (len(payload(r.text or "")) // 4, hashlib.sha256(payload(r.text or "")).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in rows
    }
    got = op12.query(spark, SF0001)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == want
