"""Near duplicates, decontamination, URL rules, line templates, the pipeline."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001, SF0001
from oracle_compare import compare, duck, rows_of
from sessionlens.llm import common
from sessionlens.llm import op3_quality as op3
from sessionlens.llm import op4_packing as op4
from sessionlens.llm import op5_decontamination as op5
from sessionlens.llm import op7_url_rules as op7
from sessionlens.llm import op8_minhash as op8
from sessionlens.llm import op10_line_templates as op10
from sessionlens.llm import registry
from sessionlens.llm.components import components
from sessionlens.llm.common import table

from llm.conftest import DOCS, ODD_TEXTS

# --------------------------------------------------------------- near duplicates


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain_components(rows, size, share):
    """Smallest reachable id of each row, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= share * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return Counter((d, len(s), None if d is None else top(d) if s else d) for (d, _), s in zip(rows, sets, strict=True))


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def near_rows(seed=3):
    """Groups of copies with few and many edits, chains, and short texts."""
    rng, rows = random.Random(seed), []
    for _ in range(12):
        base = [f"v{rng.randrange(400)}" for _ in range(rng.choice((9, 30, 120, 400)))]
        for _ in range(rng.choice((2, 5, 40))):
            rows.append(edited(rng, base, rng.choice((0, 0, 1, 2, 4))))
        for _ in range(8):  # each one an edit of the one before
            base = edited(rng, base, 1)
            rows.append(base)
    rows += [[f"u{i}"] for i in range(5)] + [["same", "words"]] * 3
    rng.shuffle(rows)
    return [(i * 7 % 1009, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("size,share", [(3, 85), (5, 80)])
def test_near_duplicates_like_all_pairs(spark, docs_of, size, share):
    rows = near_rows()
    got = op8.near_duplicates(docs_of(rows).repartition(4), size, share).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, size, share)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(spark, docs_of):
    rows = [r for r in ODD_TEXTS if r[0] not in (14, 15)]
    got = op8.near_duplicates(docs_of(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 3, 85)
    assert all(r.kept for r in got if r.doc_id is None)
    # An id with two different sets joins their groups.
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "k l m n"), (3, "k l m n"), (14, "word " * 60_000), (15, "word " * 50_000)]
    got = {(r.doc_id, r.component_id) for r in op8.near_duplicates(docs_of(rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (14, 14), (15, 14)}
    assert op8.near_duplicates(docs_of([])).collect() == []


def test_near_duplicates_on_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = op8.query(spark, SF001).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, 3, 85)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(10, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(10, 40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_links_are_few_tasks(spark):
    """Tables of few rows are not cut into as many files as a shuffle has
    partitions."""
    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame([(i, i + 1) for i in range(0, 60, 2)] + [(1, 3)], "a long, b long")
        labels = components(links)
        assert labels.rdd.getNumPartitions() <= common.LEAST_PARTS
        got = {r.node: r.label for r in labels.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 if i < 4 else i - i % 2 for i in range(61) if i < 60}


def test_blocks_are_compared_like_single_pairs():
    """Members of a bucket in blocks of any cut: each pair in its first common
    band, in different components, of like sizes and sets."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    rows = []
    for i in range(40):
        s = base[np.sort(rng.choice(len(base), len(base) - int(rng.integers(0, 60)), replace=False))]
        v = op8.signature(s)
        rows.append({
            "key": 0, "rep": i, "component": i % 7, "core": 0, "n": len(s), "bands": op8.band_keys(v).view(np.int64).tolist(),
            "sketch": (v & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16).tolist(), "short": s.astype(np.uint32).view(np.int32).tolist() if i % 5 else None,
        })
    found = 0
    for share in (80, 85):
        for key in {b for r in rows for b in r["bands"]}:
            bucket = [r | {"key": key} for r in rows if key in r["bands"]]
            outside = [r for r in bucket if r["component"]]
            expected = set()
            for o in outside:
                for m in bucket:
                    if o["component"] == m["component"] or (m["component"] and m["rep"] <= o["rep"]):
                        continue
                    few, many = sorted((o["n"], m["n"]))
                    filled = op8.BINS * (1 - math.exp(-few / op8.BINS))
                    bound = share / 100 - 6.5 * math.sqrt(share / 100 * (1 - share / 100) / filled)
                    first = next(x for x, y in zip(o["bands"], m["bands"], strict=True) if x == y)
                    held = None if None in (o["short"], m["short"]) else len(set(o["short"]) & set(m["short"])) + 1
                    if 100 * few >= share * many and first == key and sum(x == y for x, y in zip(o["sketch"], m["sketch"], strict=True)) >= op8.BINS * bound:
                        if held is None or 100 * held >= share * (few + many - held):
                            expected.add((min(o["rep"], m["rep"]), max(o["rep"], m["rep"])))
            got = set()
            for cut in ([outside[::2], outside[1::2]] if len(outside) > 1 else [outside] if outside else []):
                block = op8._Block(cut, share)
                for m in bucket:
                    got |= {(min(x, m["rep"]), max(x, m["rep"])) for x in block.rep[block.near(m)].tolist()}
            assert got == expected
            found += len(got)
    assert found > 20


def test_one_of_each_group_stays(spark, docs_of):
    text = "one two three four five six seven eight"
    rows = [(4, text), (2, text), (2, text), (2, "something else entirely in these five words"), (8, ""), (8, ""), (9, None), (None, text), (1, "")]
    out = op8.one_of_each(docs_of(rows))
    assert out.columns == docs_of([]).columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert got[4, text] == 0 and got[None, text] == 1 and got[9, None] == 1 and got[1, ""] == 1 and got[8, ""] == 1
    assert sum(n for (d, _), n in got.items() if d == 2) == 1


# --------------------------------------------------------------- decontamination


def plain_words(text):
    """The canonical words, by a scanner instead of replacements."""
    text = text or ""
    out, i = [], 0
    while i < len(text):
        c = text[i]
        if c.isascii() and c.isdigit():
            j = i
            while j < len(text) and text[j].isascii() and text[j].isdigit():
                j += 1
            out.append(("d", text[i:j]))
            k = j + 1 if text[j : j + 1] == " " else j
            unit = next((u for u in sorted(op5.UNITS, key=len, reverse=True)
                         if text[k : k + len(u)].lower() == u and not text[k + len(u) : k + len(u) + 1].isalnum()), None)
            if unit:
                out.append(("u", unit))
                j = k + len(unit)
            i = j
        elif c.isalnum():
            j = i
            while j < len(text) and text[j].isalpha():
                j += 1
            word = text[i:j]
            named = i >= 2 and text[i - 1] == " " and (text[i - 2].isalnum() or text[i - 2] in ",;:") and re.match(r"[A-Z][a-z]+$", word)
            out.append(("n", word.lower()) if named else word.lower())
            i = max(j, i + 1)
        else:
            i += 1
    return out


def test_canonical_words(spark):
    texts = ["Then Tom walked 12 km to Paris, and Ann paid 3,50 dollars. The end.", "7kg of 100 apples", "", "no slots at all", "5 Miles; and Rome"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", op5.canonical_words(F.col("text")).alias("w")).collect()
    for r in rows:
        assert [w if isinstance(w, str) else op5.MARK + w[0] + w[1] for w in plain_words(texts[r.i])] == r.w


def test_window_hashes_of_places(spark):
    """Hashes made place by place are those of the windows as arrays."""
    rows = spark.createDataFrame([(1, 0, [5, 6, 7, 8], [1, 2, 3]), (2, 0, [], [9]), (3, 0, [4], []), (4, 0, [3, 3, 3], [3, 3, 3])], "kid long, print long, hashes_0 array<long>, hashes_2 array<long>")
    kinds = [(3, 0), (2, 2), (1, 0)]
    got = sorted(tuple(r) for r in op5.window_hashes(rows, kinds).select("kid", "hash").collect())

    def whole(width, kind):
        return F.transform(op5._starts(f"hashes_{kind}", width), lambda i: op5._salted(F.slice(f"hashes_{kind}", i, width), kind))

    cut = [whole(w, k) for w, k in kinds]
    assert got == sorted(tuple(r) for r in rows.select("kid", F.explode(F.concat(*cut)).alias("hash")).collect()) and len(got) == 15


def test_capitals_inside_and_at_the_start(spark):
    """Capitalised words in the second reading, beside letters and other signs."""
    texts = {
        "Then Ann, Bob: Éva met 5 Km off. New York City-Hall McDonald (Tom) x\nAda": "sthen nann nbob néva met d5 ukm off snew nyork ncity shall nmcdonald stom x sada",
        "A Bc 3Dx 1.5 kg 2 İx": "a nbc d3dx d1\u00025 ukg d2 ni x",
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", op5.marked_words(F.col("t")).alias("w")).collect()
    for r in rows:
        assert " ".join(w.replace(op5.MARK, "") for w in r.w) == " ".join(texts[r.t].split()), r.w


ITEM = "If Tom buys 5 apples and 12 pears for 30 dollars at the market how many pieces of fruit does Tom have in his basket"


def flagged(spark, docs_of, texts, items=(ITEM,)):
    items = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, kid long")
    rows = op5.contaminated(docs_of(list(texts)), items).collect()
    return {(r.doc_id, r.item_id): (r.covered, r.windows, r.altered) for r in rows}


def test_asked_again_with_other_values(spark, docs_of):
    again = ITEM.replace("Tom", "Rosa").replace("12", "90").replace("30 dollars", "11 euros")
    mixed = ITEM.replace("Tom", "Rosa", 1)  # one name becomes two
    half = " ".join(ITEM.split()[:9]) + " and then something quite different happens in the rest of this story"
    texts = [
        (1, f"some words before. {ITEM} and after"), (2, f"we ask: {again}?"), (3, mixed), (4, half), (5, None), (6, ""), (6, ""),
        (7, "clean words only " * 50), (None, ITEM), (8, ITEM.upper()), (9, ITEM), (9, ITEM),
    ]
    got = flagged(spark, docs_of, texts)
    assert set(got) == {(1, 0), (2, 0), (None, 0), (9, 0)} | ({(8, 0)} & set(got))
    assert not got[1, 0][2] and got[2, 0][2]


def test_short_null_and_equal_items(spark, docs_of):
    items = ("five words make an item", "too short", None, "", "five words make an item", "1 2 3 4 5 6 7 8 9 10 11 12")
    texts = [(1, "here are five words make an item indeed"), (2, "too short"), (3, "9 9 9 9 9 9 9 9 9 9 9 9 9 9")]
    # A short item is held by a text in which it is a whole line.
    assert set(flagged(spark, docs_of, texts, items)) == {(1, 0), (1, 4), (2, 1)}
    assert flagged(spark, docs_of, [], items) == {} and flagged(spark, docs_of, texts, ()) == {}


def test_items_of_numbers_names_or_few_words(spark, docs_of):
    items = ("What is 37 * 48 + 12?", "Oslo, Rome, Paris, Bern, Vienna, Prague, Lisbon, Madrid, Dublin and Athens", "Name three primes")
    texts = [
        (1, f"a quiz: {items[0]} Think."), (2, "What is 38 * 48 + 12?"), (3, f"cities such as {items[1]} are capitals"),
        (4, "Lima, Quito, Cairo, Tunis, Rabat, Accra, Lagos, Dakar, Nairobi and Harare"), (5, "Please name three primes now"), (6, "name three other primes"),
        (7, "A quiz\n  name three primes\nand more"), (8, "It begins. Name three primes! It ends."), (9, "Name three. Primes"), (None, "Name three primes"),
    ]
    # The short item counts as a whole line or sentence only.
    assert set(flagged(spark, docs_of, texts, items)) == {(1, 0), (3, 1), (7, 2), (8, 2), (None, 2)}
    assert flagged(spark, docs_of, [(1, "well yes that is so"), (2, "Yes.")], ("Yes",)).keys() == {(2, 0)}


def test_one_map_of_values_over_the_whole_item(spark, docs_of):
    item = "If Tom has 5 apples and 12 pears so how many pieces of fruit does Tom have in all when Tom gives 3 of them to his friend Ben"
    asked = item.replace("Tom", "Rosa").replace("Ben", "Karl")
    texts = [
        (1, asked.replace("5", "9").replace("12", "9")),  # two numbers fall together
        (2, f"so {asked}".replace("Rosa", "Anna", 1).replace("does", "ever does")),  # Anna first, Rosa after an inserted word
        (3, asked.replace("does", "ever does")), (4, asked.replace("Karl", "Rosa")),  # one name for two
        (5, f"{asked} and again {item.replace('Tom', 'Anna')}"),
    ]
    got = flagged(spark, docs_of, texts, (item,))
    assert {1, 3, 5} <= {d for d, _ in got} and (2, 0) not in got
    assert got[1, 0][0] == got[1, 0][1]
    if (4, 0) in got:  # only the part without the second name
        assert got[4, 0][0] < got[4, 0][1]


def test_recall_of_questions_asked_again(spark, docs_of):
    """Generated questions, each asked again with other names, numbers and units
    inside other text: at least nine of ten are found, other texts are not."""
    rng = random.Random(8)
    names, things, verbs, places = "Tom Anna Rosa Karl Ben Ida Max Eva".split(), "apples pears books coins stamps shells".split(), "buys sells finds loses".split(), "market station harbour school".split()
    frame = "In the morning {a} {v} {x} {t} at the {p} and later {b} carries {y} {t} over {z} {u} to the old house. How many {t} do {a} and {b} have together when {a} gives {w} of them away?"

    def filled(k, seed):
        r, q = random.Random(k), random.Random(seed)
        words = {"v": r.choice(verbs), "t": r.choice(things), "p": r.choice(places)}
        a, b = q.sample(names, 2)
        values = {"a": a, "b": b, "x": q.randrange(2, 90), "y": q.randrange(2, 90), "z": q.choice(["3", "4.5", "1,200", "17"]), "u": q.choice(["km", "miles", "feet"]), "w": q.randrange(2, 9)}
        return frame.format(**words, **values)

    items = [filled(k, f"item {k}") + f" {' '.join(rng.sample(things, 3))} number question {chr(97 + k)}" for k in range(20)]
    texts = [(k, f"Some text before it. {filled(k, f'text {k}')} {items[k].split('?')[1].strip()} and after it.") for k in range(20)]
    texts += [(100 + k, "words of another kind that ask for nothing " * 5) for k in range(5)]
    got = flagged(spark, docs_of, texts, items)
    assert sum((k, k) in got for k in range(20)) >= 18
    assert not {d for d, _ in got if d >= 100} and all(got[k, k][2] for k in range(20) if (k, k) in got)


def test_names_that_start_sentences_and_numbers_with_separators(spark, docs_of):
    items = (
        "Tom has 5 apples. Tom buys 12 pears. Tom eats 3 plums. How many fruits does Tom have?",
        "the shop sells every box for 4 dollars and the buyer pays with 1000 coins so what is the change",
    )
    texts = [
        (1, items[0].replace("Tom", "Anna")), (2, f"Question:\n{items[0].replace('Tom', 'Anna').replace('12', '1,250')}"),
        (3, items[1].replace("4", "3.5").replace("1000", "1,250")), (4, "Tom has a dog. Tom buys bread. How many dogs does Tom have?"),
    ]
    got = flagged(spark, docs_of, texts, items)
    assert set(got) == {(1, 0), (2, 0), (3, 1)} and all(v[2] for v in got.values())


def test_clean_keeps_rows_and_columns(spark, docs_of):
    docs = docs_of([(1, ITEM), (None, ITEM), (2, "fine"), (3, None), (2, "fine")])
    items = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    out = op5.clean(docs, items)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(2, "fine"), (2, "fine"), (3, "")]


def test_decontamination_on_the_tables(spark):
    """Documents that hold a whole item word for word are exactly those found."""
    docs = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, SF001, "benchmark").collect()}
    expected = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = op5.query(spark, SF001).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)


# --------------------------------------------------------------- URL rules


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], re.split("[?#]", rest[cut:])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h) + len(p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, default, None))
    return host, path, best[2], best[1]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_url_rules_like_plain_matching(spark, data):
    label = st.sampled_from(["a", "b", "com", "x-y", "a1"])
    host = st.lists(label, min_size=1, max_size=4).map(".".join)
    path = st.sampled_from(["", "/", "/a", "/a/", "/a/b", "/ab"])
    rules = data.draw(st.dictionaries(st.tuples(host, path), st.sampled_from(["allow", "block"]), max_size=8))
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = data.draw(st.lists(st.builds(lambda h, p, q: f"http://{h.upper() if q == '#' else h}{p}{q}", host, path, st.sampled_from(["", "?x=/a", "#"])), max_size=15))
    urls += [None, "", "no scheme", "://", "http://", "http://a?b", "x://a.b/c://d", "http://a..com/a"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
    got = op7.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id], rules), urls[r.page_id]


def test_url_rules_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "allow"), ("com", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    got = op7.judge(pages, rules).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in got if r.page_id) == [(1, "com/", "block")] * 2 and len(got) == 3
    assert op7.judge(pages.limit(0), rules).count() == 0


# --------------------------------------------------------------- line templates


def template_oracle(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    res = con.execute(op10.ORACLE_SQL)
    return rows_of([c[0] for c in res.description], res.fetchall())


def test_templates_with_variable_fields(spark, docs_of):
    rng = random.Random(5)
    rows = [
        (i, f"unique start {rng.random()} of text number {i}\nPosted by user{rng.randrange(10**6)} on 2024-01-{i % 28 + 1:02d} at 10:{i:02d}\n"
            f"Share this page with friend {rng.choice(['anna', 'bob', 'eve'])}{'' if i % 2 else i}\nok")
        for i in range(20)
    ]
    rows += [(100, rows[3][1]), (101, None), (102, ""), (None, rows[4][1]), (103, "\n\n"), (103, "\n\n"), (104, "a b c d e\t" + "word " * 30_000)]
    got = op10.drop_lines(docs_of(rows))
    assert got.columns == [*docs_of([]).columns, "lines_dropped_"]
    found = got.collect()
    assert rows_of(["doc_id", "text", "lines_dropped"], [(r.doc_id, r.text, r.lines_dropped_) for r in found]) == template_oracle(rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[7].lines_dropped_ >= 1 and "Posted by" not in by_id[7].text and by_id[7].n_chars == len(by_id[7].text)
    assert sum("Posted by" in (r.text or "") for r in found) == 1  # the first stays
    assert by_id[101].text is None and by_id[102].text == "" and by_id[104].lines_dropped_ == 0
    assert op10.drop_lines(docs_of([])).count() == 0


def test_copies_alone_make_nothing_recur(spark, docs_of):
    rows = [(i, "a whole line of seven plain words\nand another line that is its own") for i in range(50)]
    assert {r.lines_dropped_ for r in op10.drop_lines(docs_of(rows)).collect()} == {0}


def test_lines_of_one_frame_in_one_text_do_not_recur(spark, docs_of):
    frame = "\n".join(f"Add two cups of {w}" for w in "flour sugar milk water rice oats corn beans salt honey nuts rye".split())
    rows = [(1, frame), (2, f"{frame}\nwith one more line"), *[(10 + i, f"text {i}\nMix three spoons of {w}") for i, w in enumerate("abcdefghijkl")]]
    got = {r.doc_id: r.lines_dropped_ for r in op10.drop_lines(docs_of(rows)).collect()}
    assert got == {1: 0, 2: 0, 10: 0, **{11 + i: 1 for i in range(11)}}


def test_equal_lines_recur_in_few_texts_if_long(spark, docs_of):
    passage, other = (" ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) for w in ("long", "lone"))
    rows = [(1, f"one start\n{passage}"), (2, f"{passage}\ntwo"), (2, f"{passage}\ntwo"), (3, f"{other}\nthree"), (3, f"{other}\nthree")]
    rows += [(100 + i, f"its own text {i}\n\nAll rights reserved.{chr(10) + 'rare words' if i < 29 else ''}") for i in range(30)]
    rows += [(200, f"{'a' + ' ' * 60}b\nx"), (201, f"{'a' + ' ' * 60}b\ny")]
    got = sorted((r.doc_id, r.text, r.lines_dropped_) for r in op10.drop_lines(docs_of(rows)).collect())
    assert got[:5] == [(1, rows[0][1], 0), (2, "two", 1), (2, "two", 1), (3, rows[3][1], 0), (3, rows[3][1], 0)]
    assert [n for d, _, n in got if 100 <= d < 200] == [0] + [1] * 29
    assert all("rare words" in x and "\n\n" in x for d, x, _ in got if 100 < d < 129)
    assert [n for d, _, n in got if d >= 200] == [0, 0]
    assert rows_of(["doc_id", "text", "lines_dropped"], got) == template_oracle(rows)


def test_lines_are_cut_from_their_texts_once(docs_of, monkeypatch):
    plans = []

    def stored(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return kept_stored(df, name)

    kept_stored = op10.stored
    monkeypatch.setattr(op10, "stored", stored)
    op10.drop_lines(docs_of([(i, f"text {i}\nMix three spoons of {w}\nok") for i, w in enumerate("abcdefghijkl")], extra=False)).count()
    assert len(plans) > 5 and sum("text#" in p for p in plans) == 1


def test_variable_fields_are_whole_tokens_with_a_digit(spark):
    rng = random.Random(11)
    lines = ["", "7", " 7", "7 ", "a7", "a 7b c", "a  1 ", "\u0663 x", "\U0001f6005 y", "no field", "1 2 3", "x" * 50_000 + " 1", "w " * 50_000 + "w1 w"]
    lines += ["".join(rng.choice("ab 19é") for _ in range(rng.randrange(30))) for _ in range(500)]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", op10.masked(F.col("line")).alias("mask")).collect()
    assert len(got) == len(lines)
    for r in got:
        assert r.mask == " ".join(op10.ANY if any(c in "0123456789" for c in t) else t for t in r.line.split(" "))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_match_duckdb(spark, name):
    r = compare(spark, name, SF001, duck(SF001))
    assert r.get("ok"), r


# --------------------------------------------------------------- the pipeline


def test_pipeline_stages(spark):
    docs, seen = table(spark, SF001, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (docs, out := corpus_pipeline.stored(stage(spark, docs, SF001), "test-stage"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    quality = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    before, after = ({r.doc_id for r in d.collect()} for d in seen["quality_classifier"])
    labelled = [d for d in before if d in quality]
    assert sum((d in after) == quality[d] for d in labelled) / len(labelled) > 0.97
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in seen["line_dedup"])
    assert before.keys() == after.keys() and any(before[d] != after[d] for d in before)
    before, after = ([(r.doc_id, r.text) for r in d.collect()] for d in seen["minhash_near_dedup"])
    label = {d: c for d, _, c in plain_components(before, 5, 80)}
    assert Counter(d for d, _ in after) == Counter(d for d, _ in before if label[d] == d)
    items = [r.text for r in table(spark, SF001, "benchmark").collect()]
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in seen["benchmark_decontamination"])
    assert after == {d: t for d, t in before.items() if not any(x in t for x in items)}
    before, after = seen["best_fit_packing"]
    total = after.agg(F.sum("length"), F.count_distinct("sequence_id"), F.count_distinct("doc_id")).first()
    assert total[2] == before.count() and total[1] <= total[0] / op4.CAPACITY * 1.02 + 1


def test_pipeline_runs_on_odd_and_empty_tables(spark, docs_of, tmp_path):
    for name, rows in (("odd", ODD_TEXTS), ("empty", [])):
        folder = os.path.join(str(tmp_path), name)
        docs_of(rows).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(5, None), (None, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder)
        got = out.agg(F.sum("length")).first()[0]
        assert (got is None) == (not rows)
        if rows:
            # Row 7 twice is one document; all others stay.
            assert Counter(r.doc_id for r in out.where("piece = 0").collect())[7] == 1


def test_registry_names_and_order():
    names = list(registry.queries())
    assert [n for n in names if n.startswith("op")] and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None and set(registry.oracle_sql()) <= set(names)
