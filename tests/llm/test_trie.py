"""The prefix trie against a plain one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from sessionlens.llm import op13_prefix_trie as op13
from sessionlens.llm.common import table

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes from (conv_id, turn, role, text) rows, by walking every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members, finished = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = (*own.get(c - c % 20, [])[:h], *turns[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        finished[whole].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode().split()) if node else 0
        leaves = 0 if children[node] else 1
        for child in children[node]:
            saved, leaves = saved + below[child][0], leaves + below[child][1]
        below[node] = (saved, leaves)
    return sorted(
        (
            min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), below[node][1], below[node][0],
            hashlib.sha256(",".join(map(str, sorted(finished[node]))).encode()).hexdigest(),
        )
        for node, cs in members.items()
    )


def built(df, **more):
    out = op13.nodes(df, **more)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in out.dtypes[:-1]} == {"bigint"}
    return sorted(map(tuple, out.collect()))


def random_rows(seed, convs=120):
    r = random.Random(seed)
    texts = ["", "a", "a b", " a  b\tc\n", "two\x0bwords", "é ü", None, "x" * 300 + "1", "x" * 300 + "2", "no break"]
    rows = []
    for c in r.sample(range(convs * 2), convs):
        for t in range(r.choice([1, 1, 2, 3, 4, 5, 9])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", "assistant", None]), r.choice(texts[: r.choice([2, 10])])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_plain_walk(spark, seed):
    rows = random_rows(seed)
    rows += rows[:5] + [(None, 1, "user", "no conversation"), (-4, 0, "user", "negative"), (-7, None, None, None), (1 << 62, 3, "user", "far")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(3) for c in ("conv", "place", "own", "words", "ka", "kb", "d", "depth")})
    assert built(df) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    r = random.Random(3)
    rows = [(40, t, "user", r.choice(["a b", "c"])) for t in range(3000)] + [(41, t, "user", "a b") for t in range(2500)]
    rows += [(c, t, "user", "a b") for c in range(42, 60) for t in range(3)] + [(60, 0, "user", "same")] * 900
    df = spark.createDataFrame(rows, TURNS).repartition(12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = op13.numbered_turns(df)
        parts = spark.read.parquet(turns.inputFiles()[0].rsplit("/", 1)[0]).where("conv = 40").select("part").distinct().count()
        assert parts > 1  # the long one was split, and so were the 900 equal rows
        assert {(x.conv, x.place) for x in turns.collect()} == {(c, i) for c in (40, 41, 60, *range(42, 60)) for i in range(sum(1 for q in rows if q[0] == c))}
        assert built(df) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_copies_and_ends_in_pieces(spark):
    rows = [(c, t, "user", "the same") for c in range(0, 3000) for t in range(c % 3 // 2 + 4)]
    assert built(spark.createDataFrame(rows, TURNS), piece_ids=7) == brute(rows)


def test_no_conversations(spark):
    assert built(spark.createDataFrame([], TURNS)) == []
    assert built(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []


def test_whole_table(spark):
    df = table(spark, SF0001, "conversations")
    assert sorted(map(tuple, op13.query(spark, SF0001).collect())) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_large_sides_are_joined_by_shuffle(spark, monkeypatch):
    """Beyond the broadcast limit heavy keys are broadcast and the rest shuffled,
    with the same result."""
    from sessionlens.llm import common
    from sessionlens.llm import components as components_

    for module, name, value in ((common, "BROADCAST_ROWS", 0), (components_, "BROADCAST_ROWS", 0), (op13, "HEAVY", 20), (components_, "HEAVY", 8)):
        monkeypatch.setattr(module, name, value)
    rows = random_rows(5, 40) + [(c, t, "user", "the same") for c in range(200, 240) for t in range(3)]
    assert built(spark.createDataFrame(rows, TURNS)) == brute(rows)
    links = [(i, i + 1) for i in range(100, 130)] + [(5, i) for i in range(10, 60)]
    got = {r.node: r.label for r in components_.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, 5: 5, **{i: 5 for i in range(10, 60)}}
