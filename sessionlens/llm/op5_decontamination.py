"""Benchmark decontamination by templates.

Texts and benchmark items are made canonical: names (capitalised words inside
a sentence), numbers and units after a number become typed placeholders that
remember their value, all else is lower-cased and cut at anything that is
neither letter nor digit. At the start of a sentence a capital says little, and
a separator may be part of a number, so template windows are also taken of a
second reading: there every capitalised word is a name, and a number with
separators is one. An item is found if either reading finds it. Both readings
come from one cut into words, but for texts with separated numbers. Each word is
hashed once and windows are hashed over word hashes. Windows of ``WINDOW``
template words of the items are hash-joined with those of the texts. A window in
which fewer than ``LITERALS`` words are literal says too little as a template: it
is joined with its values, so that it finds word-for-word copies only.

Documents that hold enough of an item's windows are read again, with the
values. An alignment is a place in the text minus a place in the item; its item
values must map onto one text value each, and different names onto different
names (numbers may fall together: 9 apples and 9 pears). Over the whole item,
alignments are put together from the largest on as long as they agree on one
such map, so an inserted word splits nothing and a text that says Rosa here and
Anna there for the item's Tom does not pass. A document is contaminated by an
item if the windows of the alignments that agree cover at least ``SHARE`` of the
item's template windows, or of all its windows. ``windows`` and ``covered`` of a
result count all.

An item of fewer than ``SHORT`` words is held only by a text in which it fills a
whole line or sentence: as a part of one, words so few say nothing.

Only DataFrame functions. The windows of all texts are exploded and joined;
the item side is broadcast if it is counted to be small, else both sides are
shuffled by window hash. No key of the text side is grouped before windows
have been reduced to hits.

Defined results: null and empty texts and items have no windows; an item of
``SHORT`` to ``WINDOW`` - 1 words is one window of its own length; an item
without a word is never found; equal items are reported each; rows that agree
in doc_id and text are one document; a null doc_id is reported as null, one
row for each text; empty tables give no rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import NO_ID, counted, keyed, stored, table, whole_rows

WINDOW = 8
LITERALS = 5
SHORT = 5
SHARE = 0.5
MARK = "\u0001"
INNER = "\u0002"  # a separator inside a number
SHORT_BYTES = 2000  # a line of four words of 500 bytes is no question
TEMPLATE, EXACT, SECOND = 0, 1, 2  # kinds of windows; the third is a template of the second reading
# Units that become a placeholder after a number.
UNITS = (
    "km", "m", "cm", "mm", "kg", "g", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "hour", "minutes", "minute",
    "seconds", "days", "day", "weeks", "years", "miles", "mile", "meters", "metres", "feet", "inches", "dollars", "cents", "euros",
    "percent", "degrees", "litres", "liters", "grams", "pounds", "kmh", "mph",
)


def canonical_words(text: Column) -> Column:
    """Words in order; a placeholder is ``MARK``, its type letter and its value."""
    numbered = F.regexp_replace(text, "[0-9]+", f"{MARK}d$0")
    units = F.regexp_replace(numbered, f"(?i)({MARK}d[0-9]+) ?({'|'.join(UNITS)})(?![\\p{{L}}\\p{{N}}])", f"$1 {MARK}u$2")
    named = F.regexp_replace(units, r"\p{Lu}(?<=[\p{L}\p{N},;:] \p{Lu})\p{Ll}+", f"{MARK}n$0")
    return F.array_remove(F.split(F.lower(named), f"[^\\p{{L}}\\p{{N}}{MARK}]+"), "")


def separated(text: Column) -> Column:
    """Whether a number of the text may have a separator."""
    return text.rlike("[0-9][.,][0-9]")


def marked_words(text: Column) -> Column:
    """Words of the second reading, in which a capitalised word that the first
    reading takes literally has the type letter s. Digits with single dots or
    commas between them are one number."""
    # Replacements that a text has no use for are not tried on it.
    plain = F.replace(F.replace(text, F.lit(MARK), F.lit(" ")), F.lit(INNER), F.lit(" "))
    plain = F.when(separated(text), F.regexp_replace(plain, "(?<=[0-9])[.,](?=[0-9])", INNER)).otherwise(plain)
    numbered = F.regexp_replace(plain, f"[0-9]+(?:{INNER}[0-9]+)*", f"{MARK}d$0")
    units = F.regexp_replace(numbered, f"(?i)({MARK}d[0-9{INNER}]+) ?({'|'.join(UNITS)})(?![\\p{{L}}\\p{{N}}])", f"$1 {MARK}u$2")
    # The rarer sign comes first and is looked back from: a look back at every
    # place of the text costs most of the reading.
    capitals = F.regexp_replace(units, rf"\p{{Lu}}(?<![\p{{L}}\p{{N}}{MARK}]\p{{Lu}})\p{{Ll}}+", f"{MARK}s$0")
    named = F.regexp_replace(capitals, rf"{MARK}s(?<=[\p{{L}}\p{{N}},;:] {MARK}s)", f"{MARK}n")
    return F.array_remove(F.split(F.lower(named), f"[^\\p{{L}}\\p{{N}}{MARK}{INNER}]+"), "")


def whole_words(text: Column) -> Column:
    """``canonical_words`` in the second reading: every capitalised word is a
    name, and digits with single dots or commas between them are one number."""
    return F.transform(marked_words(text), lambda w: F.when(w.startswith(f"{MARK}s"), F.concat(F.lit(f"{MARK}n"), F.substring(w, 3, 1 << 30))).otherwise(w))


def _value(word: Column) -> Column:
    return F.when(word.startswith(MARK), F.substring(word, 3, 1 << 30)).otherwise(word)


def word_hashes(words: Column, kind: int) -> Column:
    """A hash of each word as a window of this kind sees it. Words may be marked
    by either function above."""

    def term(w: Column) -> Column:
        if kind == EXACT:
            return _value(w)
        start = F.lit(f"{MARK}n") if kind == SECOND else F.substring(w, 3, 1 << 30)
        return F.when(w.startswith(f"{MARK}s"), start).when(w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w)

    return F.transform(words, lambda w: F.xxhash64(term(w)))


def _starts(words: str, width: int) -> Column:
    n = F.size(words)
    return F.when(n >= width, F.sequence(F.lit(1), n - (width - 1))).otherwise(F.array().cast("array<int>"))


def _salted(hashes: Column, kind: int) -> Column:
    return F.xxhash64(hashes) if kind == TEMPLATE else F.xxhash64(hashes, F.lit(kind))


def window_hashes(hashed: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
    """(kid, print, hash): the hash of each window of each (width, kind), from
    the hashes of a text's words in ``hashes_<kind>``. A row for each place is
    made first: the hash of a window is then generated code over a few longs,
    the same value as that of the slice, which would be interpreted."""
    sizes = [F.size(f"hashes_{k}") - (w - 1) for w, k in kinds]
    places = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    placed = hashed.select("*", F.explode(F.when(places > 0, F.sequence(F.lit(0), places - 1))).alias("place"))

    def window(width: int, kind: int) -> Column:
        held = [F.get(f"hashes_{kind}", F.col("place") + i) for i in range(width)]
        salt = [] if kind == TEMPLATE else [F.lit(kind)]
        return F.when(F.col("place") + width <= F.size(f"hashes_{kind}"), F.xxhash64(*held, *salt))

    return placed.select("kid", "print", F.explode(F.array(*[window(w, k) for w, k in kinds])).alias("hash")).where(F.col("hash").isNotNull())


def _slots(window: Column) -> Column:
    return F.filter(window, lambda w: w.startswith(MARK))


def _windows(words: str, hashes: str, width: int, kind: int) -> Column:
    """(place, hash, slots) of each window of a column of words. An exact one
    has no slots: its hash has the values."""
    return F.transform(_starts(words, width), lambda i: F.struct(
        i.alias("place"), _salted(F.slice(hashes, i, width), kind).alias("hash"),
        (F.array().cast("array<string>") if kind == EXACT else _slots(F.slice(words, i, width))).alias("slots"),
    ))


def whole_parts(text: Column) -> Column:
    """Hashes of the values of each line and sentence of fewer than ``SHORT``
    words, distinct."""
    parts = F.filter(F.split(text, r"\n|[.!?]+(?=\s|$)"), lambda p: (p != "") & (F.octet_length(p) < SHORT_BYTES))
    hashes = F.transform(parts, lambda p: word_hashes(canonical_words(p), EXACT))
    return F.array_distinct(F.transform(F.filter(hashes, lambda h: (F.size(h) > 0) & (F.size(h) < SHORT)), lambda h: F.xxhash64(h)))


def item_windows(items: DataFrame) -> DataFrame:
    """(item, item_id, width, kind, second, place, hash, slots, windows,
    templates): the windows of each item, and for each reading (``second`` or
    not) their number and that of the template ones."""
    text = F.coalesce("text", F.lit(""))
    item = items.select(F.col("item"), "item_id", canonical_words(text).alias("first"), whole_words(text).alias("second"))
    hashed = {k: word_hashes(F.col("words"), k).alias("hashes") for k in (TEMPLATE, EXACT, SECOND)}
    parts = [
        item.select("item", "item_id", F.col("second" if kind == SECOND else "first").alias("words"))
        .where(F.size("words") >= WINDOW if width == WINDOW else F.size("words") == width)
        .select("item", "item_id", "words", hashed[kind])
        .select("item", "item_id", F.lit(width).alias("width"), F.lit(kind).alias("kind"), "words", F.inline(_windows("words", "hashes", width, kind)))
        for width in range(SHORT, WINDOW + 1) for kind in (TEMPLATE, EXACT, SECOND)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    few = F.col("width") - F.size(_slots(F.slice("words", F.col("place"), F.col("width")))) < LITERALS
    out = out.where((F.col("kind") == EXACT) == few).withColumn("second", F.col("kind") == SECOND).drop("words")
    out = stored(out, "decontamination-items")
    sizes = out.groupBy("item", "second").agg(F.count("*").alias("windows"), F.count_if(F.col("kind") != EXACT).alias("templates"))
    return out.join(sizes, ["item", "second"])


def _enough(covered: str, covered_templates: str, share: float) -> Column:
    of_templates = (F.col("templates") > 0) & (F.col(covered_templates) >= F.lit(share) * F.col("templates"))
    return of_templates | (F.col(covered) >= F.lit(share) * F.col("windows"))


_PAIRS = "array<struct<of_item: string, of_text: string>>"


def _one_map(pairs: Column) -> Column:
    """Whether the pairs give each item value one text value, and different
    names different ones."""
    names = F.filter(pairs, lambda p: p["of_item"].startswith(f"{MARK}n"))
    function = F.size(F.array_distinct(F.transform(pairs, lambda p: p["of_item"]))) == F.size(pairs)
    return function & (F.size(F.array_distinct(F.transform(names, lambda p: p["of_text"]))) == F.size(names))


def _agreeing(alignments: Column) -> Column:
    """The places of the alignments, taken in order, that agree on one map of
    values with those taken before."""
    start = F.struct(
        F.array().cast("array<int>").alias("places"), F.array().cast("array<int>").alias("template_places"), F.array().cast(_PAIRS).alias("pairs")
    )

    def take(held: Column, new: Column) -> Column:
        pairs = F.array_union(held["pairs"], new["pairs"])
        more = F.struct(
            F.array_union(held["places"], new["places"]).alias("places"),
            F.array_union(held["template_places"], new["template_places"]).alias("template_places"), pairs.alias("pairs"),
        )
        return F.when(_one_map(pairs), more).otherwise(held)

    return F.aggregate(alignments, start, take)


def short_items(items: DataFrame) -> DataFrame:
    """(item, item_id, hash) of items of fewer than ``SHORT`` words."""
    hashes = word_hashes(canonical_words(F.coalesce("text", F.lit(""))), EXACT)
    few = items.select("item", "item_id", hashes.alias("hashes")).where((F.size("hashes") > 0) & (F.size("hashes") < SHORT))
    return few.select("item", "item_id", F.xxhash64("hashes").alias("hash"))


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, windows, covered, altered, kid, print) for each
    document and each item that it holds; ``altered``: some slot value differs."""
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    wanted = stored(item_windows(items), "decontamination-windows")
    kinds = [tuple(r) for r in wanted.select("width", "kind").distinct().collect()]  # 3 * WINDOW at most
    short = stored(short_items(items), "decontamination-short")
    found = _long(docs, wanted, kinds or [(WINDOW, TEMPLATE)], share)
    if not short.isEmpty():
        parts = keyed(docs).select("kid", "print", F.explode(whole_parts(F.col("body"))).alias("hash"))
        few = parts.join(counted(short), "hash").select("kid", "print", "item", "item_id").distinct()
        one = F.lit(1).cast("long")
        found = found.unionByName(few.select(
            F.when(F.col("kid") != NO_ID, F.col("kid")).alias("doc_id"), "item_id", one.alias("windows"), one.alias("covered"),
            F.lit(False).alias("altered"), "kid", "print",
        ))
    return found


def _long(docs: DataFrame, wanted: DataFrame, kinds: list[tuple[int, int]], share: float) -> DataFrame:
    body = F.col("body")
    used = sorted({k for _, k in kinds})
    # One cut into words serves both readings unless a number has separators.
    texts = keyed(docs).select("kid", "print", "body", marked_words(body).alias("marked"))
    first = F.when(separated(body), canonical_words(body)).otherwise(F.col("marked"))
    texts = texts.select("kid", "print", "marked", first.alias("first"))
    hashed = texts.select("kid", "print", *[word_hashes(F.col("marked" if k == SECOND else "first"), k).alias(f"hashes_{k}") for k in used])
    found = window_hashes(hashed, kinds)
    sought = wanted.groupBy("item", "second", "hash", "kind").agg(F.count("*").alias("copies"), F.max("windows").alias("windows"), F.max("templates").alias("templates"))
    hits = found.join(counted(stored(sought, "decontamination-sought")), "hash").groupBy("kid", "print", "item", "second", "hash", "kind").agg(
        F.max("copies").alias("copies"), F.max("windows").alias("windows"), F.max("templates").alias("templates")
    )
    # No alignment can cover more of an item than the windows that were hit.
    likely = hits.groupBy("kid", "print", "item", "second").agg(
        F.sum("copies").alias("most"), F.coalesce(F.sum(F.when(F.col("kind") != EXACT, F.col("copies"))), F.lit(0)).alias("most_templates"),
        F.max("windows").alias("windows"), F.max("templates").alias("templates"),
    )
    likely = stored(likely.where(_enough("most", "most_templates", share)).select("kid", "print", "item", "second"), "decontamination-likely")
    holders = counted(stored(likely.select("kid", "print").distinct(), "decontamination-holders"))
    again = keyed(docs).select("kid", "print", "body").join(holders, ["kid", "print"]).dropDuplicates(["kid", "print"])
    again = again.select("kid", "print", canonical_words(body).alias("first"), whole_words(body).alias("second"))
    again = again.select("*", *[word_hashes(F.col("second" if k == SECOND else "first"), k).alias(f"hashes_{k}") for k in used])
    placed = again.select("kid", "print", F.inline(F.concat(*[_windows("second" if k == SECOND else "first", f"hashes_{k}", w, k) for w, k in kinds])))
    of_item = wanted.select("item", "item_id", "second", "hash", "kind", "windows", "templates", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("of_item"), F.col("slots").alias("of_text"))
    own = ["kid", "print", "item", "second"]
    matched = placed.join(counted(of_item), "hash").join(likely, own).groupBy(*own, (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.first("item_id").alias("item_id"), F.max("windows").alias("windows"), F.max("templates").alias("templates"),
        F.collect_set("item_place").alias("places"), F.collect_set(F.when(F.col("kind") != EXACT, F.col("item_place"))).alias("template_places"),
        F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs"),
    )
    alignment = F.struct((-F.size("places")).alias("size"), "shift", "places", "template_places", "pairs")
    held = matched.where(_one_map(F.col("pairs"))).groupBy(*own).agg(
        F.first("item_id").alias("item_id"), F.max("windows").alias("windows"), F.max("templates").alias("templates"),
        _agreeing(F.sort_array(F.collect_list(alignment))).alias("held"),
    )
    held = held.select(
        *own, "item_id", "windows", "templates", F.size("held.places").cast("long").alias("covered"), F.size("held.template_places").alias("covered_templates"),
        F.exists("held.pairs", lambda p: p["of_item"] != p["of_text"]).alias("altered"),
    ).where(_enough("covered", "covered_templates", share))
    # The first reading is reported if both find the item.
    best = held.groupBy("kid", "print", "item").agg(F.min(F.struct("second", "item_id", "windows", "covered", "altered")).alias("best"))
    return best.select(F.when(F.col("kid") != NO_ID, F.col("kid")).alias("doc_id"), "best.item_id", "best.windows", "best.covered", "best.altered", "kid", "print")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their own columns, that hold no item."""
    bad = stored(contaminated(docs, items).select("kid", "print").distinct(), "decontamination-found")
    return whole_rows(docs).join(counted(bad), ["kid", "print"], "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("kid", "print")
