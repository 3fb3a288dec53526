"""Token alignment against a plain walk over byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF0001
from sessionlens.llm import op11_token_alignment as op11
from sessionlens.llm.common import table

from llm.conftest import ODD_TEXTS

PAIR = op11.Pair(public_tokenizers.path(op11.TOKENIZER_A), public_tokenizers.path(op11.TOKENIZER_B))
WHOLE_A = Tokenizer.from_file(public_tokenizers.path(op11.TOKENIZER_A))
WHOLE_A.encode_special_tokens = True
WHOLE_B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(op11.TOKENIZER_B))
PIECE_A, PIECE_B = PAIR.a.pieces.to_pylist(), PAIR.b.pieces.to_pylist()
PARTS = ("ab", "the", " the", " ", "   ", "\n", "\n\n x", " \n", "\t x", "\t  x", "'s", "1234", "é", "é", "你好", "\U0001f600", "՘", "\U0003fc3b", "\x00", "▁", "ﬁ", "<s>", "<0x41>", "<|endoftext|>", " ", "　")


def plain(text):
    """(a ids, b ids, links as (a place, b place), groups as id lists)."""
    if not text:
        return [], [], [], []
    wanted = (" " + text).encode()
    a = WHOLE_A.encode(" " + text, add_special_tokens=False).ids
    b = WHOLE_B.encode(text)
    if b"".join(PIECE_A[i] for i in a) != wanted or b"".join(PIECE_B[i] for i in b) != wanted:
        return [], [], [], []
    ends_a, ends_b = np.cumsum([len(PIECE_A[i]) for i in a]).tolist(), np.cumsum([len(PIECE_B[i]) for i in b]).tolist()
    links, j = [], 0
    for i, end in enumerate(ends_a):
        while True:
            links.append((i, j))
            if ends_b[j] >= end:
                j += ends_b[j] == end
                break
            j += 1
    both, groups = set(ends_a) & set(ends_b), []
    held = ([], [])
    for end, side, i in sorted([(e, 0, i) for i, e in enumerate(ends_a)] + [(e, 1, j) for j, e in enumerate(ends_b)]):
        held[side].append((a, b)[side][i])
        if end in both and side:
            groups.append(held)
            held = ([], [])
    return a, b, links, groups


def brute(rows):
    done = [(doc, *plain(text)) for doc, text in rows]
    count = Counter((a[i], b[j]) for _, a, b, links, _ in done for i, j in links)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for doc, a, b, links, groups in done:
        held = [(count[a[i], b[j]], b[j]) for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(n == most[y] for n, y in held), sum(n for n, _ in held),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return Counter(out)


def test_plain_walk_finds_overlaps():
    a, b, links, _ = plain("Zwei übereinander liegende 12345 wörter")
    span_a, span_b = (np.cumsum([0] + [len(p[i]) for i in ids]) for p, ids in ((PIECE_A, a), (PIECE_B, b)))
    assert links == [(i, j) for i in range(len(a)) for j in range(len(b)) if max(span_a[i], span_b[j]) < min(span_a[i + 1], span_b[j + 1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=20).map("".join)), min_size=1, max_size=5))
def test_words_encode_like_whole_texts(texts):
    assert PAIR.by_run
    kept = [t for t in texts if t and "▁" not in t]
    got_a, got_b = (ids.to_pylist() for ids in PAIR.encode([t.encode() for t in kept]))
    assert got_a == [WHOLE_A.encode(" " + t, add_special_tokens=False).ids for t in kept]
    assert got_b == [WHOLE_B.encode(t) for t in kept]
    links = op11.links_of([t.encode() for t in texts], PAIR).to_pylist()
    for t, found in zip(texts, links, strict=True):
        a, b, want, _ = plain(t)
        assert [(x >> 32, x >> 2 & (1 << 30) - 1) for x in found] == [(a[i], b[j]) for i, j in want]


@pytest.mark.parametrize("common", [1, 40, op11.COMMON])
def test_figures_of_odd_texts(spark, docs_of, common):
    rows = ODD_TEXTS + [(100 + k, p + " and " + q) for k, (p, q) in enumerate(zip(PARTS, PARTS[3:]))] + [(100, "▁"), (21, "<unk> a▁b")]
    aligned = op11.written(op11.align(docs_of(rows)))
    got = op11.figures(aligned, op11.pair_counts(aligned), common).collect()
    assert Counter(map(tuple, got)) == brute(rows)


def test_links_can_be_read(spark, docs_of):
    rows = [(1, "Ein längeres Beispiel: 1234567"), (2, "")]
    aligned = op11.align(docs_of(rows)).selectExpr("doc_id", "explode(links) as link")
    link = aligned["link"]
    got = aligned.select("doc_id", op11.a_id(link).alias("a"), op11.b_id(link).alias("b"), op11.ends_with(link).alias("e")).collect()
    a, b, links, groups = plain(rows[0][1])
    assert [(r.a, r.b) for r in got] == [(a[i], b[j]) for i, j in links]
    assert sum(r.e == 3 for r in got) == len(groups)


def test_no_documents(spark, docs_of):
    aligned = op11.written(op11.align(docs_of([])))
    assert op11.figures(aligned, op11.pair_counts(aligned)).count() == 0


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").select("doc_id", "text").collect()]
    got = op11.query(spark, SF0001)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    assert Counter(map(tuple, got.collect())) == brute(rows)
