"""MinHash near-dedup: one-permutation hashing, banded buckets, star edges.

A text's set is its distinct shingles, as 64-bit hashes. One permutation hash
puts each shingle in one of ``BINS`` bins; a bin keeps its smallest value, and
an empty bin takes the value of a bin that a chain of hashes of its own number
finds filled (optimal densification). ``ROWS`` bins make a band; texts that
agree in a whole band share a bucket.

1. Texts with equal sets are one class; its representative is the smallest
   doc_id. All later steps see one row for each class.
2. Stars: in each bucket every member is paired with the smallest one; pairs
   are confirmed on the full sets, and links make components. Then every
   member is paired with a centre that a hash of member and bucket picks, if
   the two are still in different components. A member meets two centres a
   band at most: pairs grow with members, not with their square.
3. The rest: in a bucket whose members are still in several components, those
   outside its largest component are compared with all members of other
   components, each pair in its first common band alone; a pair is made only where sizes, sketches and, for small sets,
   the sets' 32-bit hashes allow the threshold. Together with the stars this
   leaves no pair of a bucket undecided that could join two components.

Texts are read twice, once for signatures and once, for members of a bucket of
two or more, for their full sets; the sets are kept for all steps. Ids that say
which rows to read are broadcast if they are counted to be few; beyond that the
join shuffles.

The chance that a pair at the threshold shares no bucket is
(1 - 0.85^5)^32 = 7e-9 (at 0.8: 3e-6); a pair below a sketch's bound is at the threshold with
a chance under 1e-9.

Defined results: null and empty texts have the empty set, are linked with
nothing and are their own component; a text of one or two words has its whole
sequence as its one shingle; rows with equal doc_id are one node and share its
links; a row with null doc_id is linked with nothing, has a null component and
is kept; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import ascii_words, counted, keyed, mix64, parts_of, prepare, record_batch, stored, table, whole_rows
from sessionlens.llm.components import components

SHINGLE = 3
SHARE = 85  # per cent
STAGE_SHINGLE, STAGE_SHARE = 5, 80  # of the pipeline's stage
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
SHORT_SET = 512  # shingles of a set that the last step compares as a whole
CENTRE_MEMBERS = 512  # members that one task compares with a centre, and of a block
_TRIES = 2048

_rng = np.random.Generator(np.random.PCG64(20240501))
_EDGES = np.array([(i << 64) // BINS + (i > 0) for i in range(BINS)], np.uint64)
_CHAIN = _rng.integers(0, BINS, (BINS, _TRIES), dtype=np.int64)
_FACTORS = _rng.integers(1, 1 << 63, (8, ROWS), dtype=np.uint64)[0] | np.uint64(1)
_BAND_SALT = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_WORD_FACTORS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = ascii_words(text)
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += h[k : n - width + 1 + k] * _WORD_FACTORS[k]
    return np.unique(mix64(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The value of each bin; ``shingles`` are sorted, so bins are intervals."""
    at = np.searchsorted(shingles, _EDGES)
    after = np.append(at[1:], len(shingles))
    filled = at < after
    values = shingles[np.minimum(at, len(shingles) - 1)]
    empty = np.flatnonzero(~filled)
    source = np.full(len(empty), np.flatnonzero(filled)[0])
    left = np.arange(len(empty))
    for t in range(0, _TRIES, 16):
        if not len(left):
            break
        tried = _CHAIN[empty[left], t : t + 16]
        hits = filled[tried]
        found = hits.any(axis=1)
        source[left[found]] = tried[found, hits[found].argmax(axis=1)]
        left = left[~found]
    values[empty] = values[source]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    return mix64((mix64(values).reshape(BANDS, ROWS) * _FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SALT)


_SIG = pa.schema([
    ("doc_id", pa.int64()), ("print", pa.int64()), ("n_shingles", pa.int64()), ("print_a", pa.int64()), ("print_b", pa.int64()),
    ("bands", pa.list_(pa.int64())),
])
_SIG_DDL = "doc_id long, print long, n_shingles long, print_a long, print_b long, bands array<long>"


def _signatures(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, prints_a, prints_b, bands = [], [], [], []
        for text in b.column("raw").to_pylist():
            s = shingle_set(text, size)
            n.append(len(s))
            prints_a.append(int(mix64(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
            prints_b.append(int(mix64(s ^ _WORD_FACTORS[63]).sum(dtype=np.uint64).view(np.int64)))
            bands.append(band_keys(signature(s)).view(np.int64) if len(s) else None)
        yield record_batch({
            "doc_id": b.column("doc_id"), "print": b.column("print"), "n_shingles": n, "print_a": prints_a, "print_b": prints_b, "bands": bands,
        }, _SIG)


_SET = pa.schema([
    ("doc_id", pa.int64()), ("print", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int16())),
    ("short", pa.list_(pa.int32())), ("shingles", pa.binary()),
])
_SET_DDL = "doc_id long, print long, n long, bands array<long>, sketch array<short>, short array<int>, shingles binary"


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The whole set of each text, its band keys, 16 bits of each bin's value,
    and sets of ``SHORT_SET`` shingles at most as 32-bit hashes (null above)."""
    for b in batches:
        sets = [shingle_set(text, size) for text in b.column("raw").to_pylist()]
        bins = [signature(s) if len(s) else None for s in sets]
        yield record_batch({
            "doc_id": b.column("doc_id"), "print": b.column("print"), "n": [len(s) for s in sets],
            "bands": [None if v is None else band_keys(v).view(np.int64) for v in bins],
            "sketch": [None if v is None else (v & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16) for v in bins],
            "short": [s.astype(np.uint32).view(np.int32) if len(s) <= SHORT_SET else None for s in sets],
            "shingles": [s.astype("<u8").tobytes() for s in sets],
        }, _SET)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _alike(x: np.ndarray, y: np.ndarray, share: int) -> bool:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if not len(small):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= share * (len(small) + len(large) - common)


def _confirm(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, part, member): a centre's sets, then its members'."""
    centre, sets = None, []
    for batch in batches:
        a, b = [], []
        for c, part, member, doc, raw in zip(*(batch.column(n).to_pylist() for n in ("a", "part", "member", "doc_id", "shingles")), strict=True):
            own = np.frombuffer(raw, "<u8")
            if (c, part) != centre:
                centre, sets = (c, part), []
            if not member:
                sets.append(own)
            elif any(_alike(own, s, share) for s in sets):
                a.append(c)
                b.append(doc)
        if a:
            yield record_batch({"a": a, "b": b}, _PAIR)


def _close_sizes(x, y, share: int):
    return 100 * F.least(x, y) >= share * F.greatest(x, y)


def confirm(sets: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """The distinct pairs (a, b) whose full sets reach the threshold; ``pairs``
    are stored. A member's set travels to its centre ``a`` once for each pair,
    a centre's own set once for ``CENTRE_MEMBERS`` members, so that no centre is
    one task."""
    few = parts_of(2 * pairs.count())
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CENTRE_MEMBERS).cast("int").alias("parts"))
    parts = counted(stored(parts.coalesce(few), "minhash-parts"))
    routed = counted(stored(pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"), "b").coalesce(few), "minhash-routed"))
    of = sets.select("doc_id", "shingles")
    centres = of.join(parts.withColumnRenamed("a", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), "doc_id", "shingles"
    )
    members = of.join(routed.withColumnRenamed("b", "doc_id"), "doc_id").select("a", "part", F.lit(True).alias("member"), "doc_id", "shingles")
    dealt = centres.unionByName(members).repartition("a", "part").coalesce(few).sortWithinPartitions("a", "part", "member")
    return dealt.mapInArrow(lambda it: _confirm(it, share), "a long, b long").distinct()


def _sketch_bound(n: np.ndarray, share: int) -> np.ndarray:
    """The smallest share of equal bins that a set of ``n`` shingles at the
    threshold can be expected to show: 6.5 standard deviations under it, on as
    many independent bins as such a set fills."""
    filled = BINS * (1 - np.exp(-n / BINS))
    p = share / 100
    return p - 6.5 * np.sqrt(p * (1 - p) / filled)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``; two
    documents are linked if their sets of ``size``-word shingles share at
    least ``share`` per cent of their union."""
    prepare(docs.sparkSession)
    rows = keyed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "print", F.col("body").cast("binary").alias("raw"))
    signed = stored(rows.mapInArrow(lambda it: _signatures(it, size), _SIG_DDL), "minhash-signatures")
    few = parts_of(signed.count())

    def written(df: DataFrame, name: str) -> DataFrame:
        return stored(df.coalesce(few), name)

    same = ["print_a", "print_b", "n_shingles"]
    usable = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Map-side aggregation makes a class of any size one row for each task.
    classes = written(usable.groupBy(*same).agg(F.min("doc_id").alias("rep")), "minhash-classes")
    # Copies are told apart by ids; the representatives' bands stay where they
    # are. (Several rows of a representative share its buckets as one member.)
    ids = usable.select(*same, "doc_id", "print").distinct()
    copies = counted(written(ids.join(classes, same).where("doc_id != rep").select("doc_id", "print"), "minhash-copies"))
    banded = usable.join(copies, ["doc_id", "print"], "left_anti").select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))
    # A bucket is of use if it has two members: its smallest one is not its largest.
    met = banded.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("key", "low")
    members = written(banded.join(met, "key").distinct(), "minhash-members")
    centres = members.groupBy("key").agg(F.min_by("rep", F.xxhash64("rep", "key")).alias("centre"))
    buckets = written(members.join(centres, "key"), "minhash-buckets")
    # The full sets of the members, from their texts; both are read once.
    wanted = counted(written(members.select(F.col("rep").alias("doc_id")).distinct(), "minhash-wanted"))
    texts = rows.join(wanted, "doc_id", "left_semi")
    sets = texts.mapInArrow(lambda it: _sets(it, size), _SET_DDL)
    if not usable.groupBy("doc_id", "print").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        sets = sets.groupBy("doc_id", "print").agg(*[F.first(c).alias(c) for c in ("n", "bands", "sketch", "short", "shingles")])  # equal rows
    sets = written(sets, "minhash-sets")
    size_of = written(sets.groupBy(F.col("doc_id").alias("rep")).agg(F.min("n").alias("least_n"), F.max("n").alias("most_n")), "minhash-sizes")

    def confirmed(edges: DataFrame, name: str) -> DataFrame:
        a, b = (size_of.select(F.col("rep").alias(x), F.struct("least_n", "most_n").alias(f"n_{x}")) for x in "ab")
        near = edges.distinct().join(a, "a").join(b, "b").where(
            (100 * F.col("n_a.most_n") >= share * F.col("n_b.least_n")) & (100 * F.col("n_b.most_n") >= share * F.col("n_a.least_n"))
        )
        return written(confirm(sets, written(near.select("a", "b"), name), share), f"{name}-links")

    # First with each bucket's smallest member: a large group mostly shares it
    # over all bands, so a member is compared a few times.
    star = confirmed(buckets.where("rep != low").select(F.col("low").alias("a"), F.col("rep").alias("b")), "minhash-first")
    links = written(star.unionByName(_same_id(usable, classes, same)), "minhash-links")
    found = written(components(links), "minhash-components")
    # Then with a member that a hash picks in each bucket, where the two are
    # not in one component yet.
    of_rep, of_centre = (found.select(F.col("node").alias(n), F.col("label").alias(f"of_{n}")) for n in ("rep", "centre"))
    apart = buckets.where("rep != centre").join(of_rep, "rep", "left").join(of_centre, "centre", "left").where(
        F.coalesce("of_rep", "rep") != F.coalesce("of_centre", "centre")
    )
    more = confirmed(apart.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")), "minhash-second")
    if not more.isEmpty():
        links = links.unionByName(more)
        found = written(components(links), "minhash-components")
    rest = written(_undecided(sets, buckets, found, share, few), "minhash-rest")
    if not rest.isEmpty():
        more = written(confirm(sets, rest, share), "minhash-more")
        if not more.isEmpty():
            found = written(components(links.unionByName(more)), "minhash-components")
    component = classes.join(found, classes["rep"] == found["node"], "left").select(*same, F.coalesce("label", "rep").alias("component"))
    out = signed.join(component, same, "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "print")


def one_of_each(docs: DataFrame, size: int = STAGE_SHINGLE, share: int = STAGE_SHARE) -> DataFrame:
    """The rows of ``docs``, with their own columns, that stay: of each group
    of near copies the row of its smallest doc_id. Rows of that id are one
    document: of those with words the one of the smallest text hash stays, and
    of equal rows one. Rows without words and rows with null id stay."""
    judged = stored(near_duplicates(docs, size, share).withColumn("kid", F.col("doc_id")), "minhash-judged")
    gone = judged.where(~F.col("kept")).select("kid", "print").distinct()
    ids = judged.where("kept and kid is not null")
    repeated = ids.groupBy("kid").agg(F.count("*").alias("n"), F.min(F.when(F.col("n_shingles") > 0, F.col("print"))).alias("first")).where("n > 1")
    repeated = stored(repeated.select("kid", "first"), "minhash-repeated")
    allowed = ids.join(repeated, "kid").where("n_shingles = 0 or print = first").select("kid", "print").distinct()
    rows = whole_rows(docs).join(counted(stored(gone, "minhash-gone")), ["kid", "print"], "left_anti")
    single = rows.join(counted(repeated.select("kid")), "kid", "left_anti")
    several = rows.join(counted(stored(allowed, "minhash-allowed")), ["kid", "print"]).dropDuplicates(["kid", "print"])
    return single.unionByName(several).select("row.*")


def _same_id(usable: DataFrame, classes: DataFrame, same: list[str]) -> DataFrame:
    """Links between the classes of an id that has rows with different sets."""
    several = usable.groupBy("doc_id").agg(F.min("print_a").alias("lo"), F.max("print_a").alias("hi")).where("lo != hi")
    reps = usable.join(several, "doc_id").join(classes, same).select("doc_id", "rep").distinct()
    return reps.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b")


class _Block:
    """Members of a bucket outside its largest component, that others of the
    bucket are compared with."""

    def __init__(self, rows: list[dict], share: int):
        self.share, self.key, self.core = share, rows[0]["key"], rows[0]["core"]
        self.rep, self.component, self.n = (np.array([r[c] for r in rows], np.int64) for c in ("rep", "component", "n"))
        self.bands = np.array([r["bands"] for r in rows], np.int64)
        self.sketch = np.array([r["sketch"] for r in rows], np.int16)
        self.long = np.array([r["short"] is None for r in rows])
        short = [np.unique(np.array(r["short"] or [], np.int32)) for r in rows]
        values, owner = np.concatenate(short), np.repeat(np.arange(len(rows)), [len(x) for x in short])
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def common(self, short: list[int]) -> np.ndarray:
        """How many of these hashes each small set of the block holds."""
        own = np.unique(np.array(short, np.int32))
        low, high = np.searchsorted(self.values, own, "left"), np.searchsorted(self.values, own, "right")
        held = high - low
        at = np.repeat(low - (np.cumsum(held) - held), held) + np.arange(held.sum())
        return np.bincount(self.owner[at], minlength=len(self.rep))

    def near(self, m: dict) -> np.ndarray:
        """The members of the block that may be linked with ``m``; a pair that
        shares several bands is made in the first alone."""
        n, share = m["n"], self.share
        able = (self.component != m["component"]) & ((m["component"] == self.core) | (self.rep < m["rep"]))
        able &= 100 * np.minimum(self.n, n) >= share * np.maximum(self.n, n)
        at = np.flatnonzero(able)
        bands = np.array(m["bands"], np.int64)
        same = self.bands[at] == bands
        at = at[same.any(axis=1) & (bands[same.argmax(axis=1)] == self.key)]
        equal = (self.sketch[at] == np.array(m["sketch"], np.int16)).sum(axis=1)
        at = at[equal >= BINS * _sketch_bound(np.minimum(self.n[at], n), share)]
        if len(at) and m["short"] is not None:
            # Of small sets the whole set is at hand (32-bit hashes, which can
            # only make the common part look larger but for a collision inside
            # a set: one spare).
            common = self.common(m["short"])[at] + 1
            at = at[self.long[at] | (100 * common >= share * (self.n[at] + n - common))]
        return at


def _compare(batches: Iterator[pa.RecordBatch], share: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block, member): a block, then all of its bucket."""
    at, rows, block = None, [], None
    for batch in batches:
        a, b = [], []
        for r in batch.to_pylist():
            if (r["key"], r["block"]) != at:
                at, rows, block = (r["key"], r["block"]), [], None
            if not r["member"]:
                rows.append(r)
                continue
            if not rows:
                continue
            block = block or _Block(rows, share)
            other = block.rep[block.near(r)]
            a.append(np.minimum(other, r["rep"]))
            b.append(np.maximum(other, r["rep"]))
        if a:
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
            yield record_batch({"a": pairs[:, 0], "b": pairs[:, 1]}, _PAIR)


def _undecided(sets: DataFrame, buckets: DataFrame, found: DataFrame, share: int, few: int) -> DataFrame:
    """Pairs of a bucket in different components, neither its centre, at least
    one outside the bucket's largest component; each pair in its first common
    band alone. The members outside are dealt into blocks of about
    ``CENTRE_MEMBERS``, and each block meets the whole bucket in one task."""
    member = buckets.drop("low").join(found, buckets["rep"] == found["node"], "left").select(
        "key", "rep", "centre", F.coalesce("label", "rep").alias("component")
    )
    groups = member.groupBy("key", "component").agg(F.count("*").alias("members"))
    core = groups.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("members", "component")).alias("top")).where("parts > 1")
    mixed = member.join(core.select("key", F.col("top.component").alias("core")), "key").where("rep != centre").drop("centre")
    mixed = stored(mixed.coalesce(few), "minhash-mixed")
    blocks = mixed.where("component != core").groupBy("key").agg(F.ceil(F.count("*") / CENTRE_MEMBERS).cast("int").alias("blocks"))
    placed = mixed.join(counted(stored(blocks.coalesce(few), "minhash-blocks")), "key")
    outside = placed.where("component != core").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn("member", F.lit(False))
    every = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("member", F.lit(True))
    # The payload is attached once: an id's size, bands, sketch and small set.
    both = outside.unionByName(every).drop("blocks").join(sets.select(F.col("doc_id").alias("rep"), "n", "bands", "sketch", "short"), "rep")
    dealt = both.repartition("key", "block").coalesce(few).sortWithinPartitions("key", "block", "member")
    return dealt.mapInArrow(lambda it: _compare(it, share), "a long, b long").distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
