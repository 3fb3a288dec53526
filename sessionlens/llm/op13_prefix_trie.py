"""The trie of conversation prefixes, by collapsing whole sequences.

Conversations are rebuilt, identical ones are collapsed into one weighted
sequence with the list of conversations that end there, sequences that are
proper prefixes of others are dropped by an anti-join (what stays are the
leaves), and each distinct sequence's prefixes are aggregated with its weight.

A prefix is known by its depth and a hash that can be summed: turn i adds its
value times BASE to the power i, modulo four primes. Turns are range-sorted by
conversation and turn and numbered with running sums inside each task; what a
conversation has in earlier tasks (one line for each task) is added to the
rest, so a conversation may be spread over any number of tasks. A rebuilt
prefix's hash follows from the sums of the two conversations it is made of;
texts themselves are read once and never shuffled.

Each node is owned by its smallest member, and a sequence owns the end of its
own path from some depth on (``from_depth``). With that depth each figure of a
node is one sum over the sequences through it: distinct children are the next
nodes that their owners bring along, the words of all distinct nodes below are
the owned ends of the paths. So no level-by-level iteration is needed, however
deep the trie is.

Keys that hold over 1/``common.HEAVY`` of the rows of a join (at most ``HEAVY`` of
them, by count) are joined by broadcast, the rest by shuffle; all groupings
combine before the shuffle. The list of a node's ends is digested from written
pieces of ``END_IDS`` ids: SHA-256 runs from left to right, so one task reads a
node's pieces in order, but never more than one at a time.

Defined results: turns of one number are ordered by role, then by the text's
first 256 characters, then by a digest; null role and text are empty; repeated
rows are repeated turns; rows with a null conv_id belong to no conversation and
are left out; ``c % 20`` is never negative; an empty table gives no rows; other
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens.llm.common import HEAVY, joined, prepare, record_batch, stored, table

GROUP = 20  # conversations that share the first turns of the first of them
MOST_SHARED = 3  # first turns that can be shared
END_IDS = 4096
# Primes below 2^31 and a base for each of them.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1220703125, 1284865837, 1664525013)
_SUMS = [f"sum{k}" for k in range(4)]


def _power(k: int, exponents: np.ndarray) -> np.ndarray:
    """BASES[k] to the power of each exponent, modulo PRIMES[k]."""
    out, square, left = np.ones(len(exponents), np.int64), BASES[k], exponents.copy()
    while left.any():
        odd = (left & 1) == 1
        out[odd] = out[odd] * square % PRIMES[k]
        square, left = square * square % PRIMES[k], left >> 1
    return out


# Numbering -----------------------------------------------------------------

_NUMBERED = pa.schema(
    [("part", pa.int32()), ("edge", pa.int8()), ("conv", pa.int64()), ("place", pa.int64()), ("own", pa.int64()), ("words", pa.int64())]
    + [(s, pa.int64()) for s in _SUMS]
)
_NUMBERED_DDL = "part int, edge byte, conv long, place long, own long, words long, " + ", ".join(f"{s} long" for s in _SUMS)
_FIRST, _LAST = 1, 2


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and running sums of each turn inside its conversation, as far as
    this task's rows go; the task's first and last row are marked."""
    part = TaskContext.get().partitionId()
    conv, place, words, sums = None, 0, 0, [0] * 4  # of the last row seen
    held = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        ids, own = np.array(b.column("conv")), np.array(b.column("own"))
        values = np.frombuffer(b"".join(b.column("digest").to_pylist()), ">u8").reshape(n, 4)
        begins = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
        goes_on = conv is not None and ids[0] == conv
        lead = np.where(which == 0, place + 1 if goes_on else 0, 0)
        places = np.arange(n) - begins[which] + lead
        total = np.cumsum(own)
        running = {"words": total - (total - own)[begins][which] + np.where(which == 0, words if goes_on else 0, 0)}
        for k, name in enumerate(_SUMS):
            term = (values[:, k] % np.uint64(PRIMES[k])).astype(np.int64) * _power(k, places) % PRIMES[k]
            total = np.cumsum(term)
            running[name] = (total - (total - term)[begins][which] + np.where(which == 0, sums[k] if goes_on else 0, 0)) % PRIMES[k]
        edge = np.zeros(n, np.int8)
        if held is None:
            edge[0] = _FIRST
        else:
            yield record_batch(held, _NUMBERED)
        held = {"part": np.full(n, part, np.int32), "edge": edge, "conv": ids, "place": places, "own": own, **running}
        conv, place, words, sums = ids[-1], places[-1], running["words"][-1], [running[s][-1] for s in _SUMS]
    if held is not None:
        held["edge"][-1] |= _LAST
        yield record_batch(held, _NUMBERED)


def _carried(edges: list) -> list[tuple]:
    """What the first conversation of each task has in earlier tasks, from the
    tasks' first and last rows: (part, conv, places, words, sums, powers)."""
    out, carry = [], None  # carry: the last conversation so far and its totals
    first = {r.part: r for r in edges if r.edge & _FIRST}
    for last in sorted((r for r in edges if r.edge & _LAST), key=lambda r: r.part):
        count, words, sums = last.place + 1, last.words, [last[s] for s in _SUMS]
        if carry and carry[0] == first[last.part].conv:
            conv, before, words_before, sums_before = carry
            powers = [pow(BASES[k], before, PRIMES[k]) for k in range(4)]
            out.append((last.part, conv, before, words_before, *sums_before, *powers))
            if last.conv == conv:
                count, words = count + before, words + words_before
                sums = [(sums_before[k] + powers[k] * sums[k]) % PRIMES[k] for k in range(4)]
        carry = (last.conv, count, words, sums)
    return out


def _word_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.size(F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")).cast("long")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, own, words, sum0..sum3) of each turn: its place from 0 in
    its conversation, its words, and the running totals up to it."""
    spark = prepare(conversations.sparkSession)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    turns = turns.select(
        "conv", "turn", "role", F.substring("text", 1, 256).alias("head"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("row"), _word_count(F.col("text")).alias("own"),
    )
    ordered = turns.orderBy("conv", "turn", "role", "head", "digest", "row").select("conv", "digest", "own")
    rows = stored(ordered.mapInArrow(_number, _NUMBERED_DDL), "trie-turns")
    carried = _carried(rows.where("edge > 0").collect())  # two rows for a task
    out = rows.drop("edge")
    if carried:
        names = ["part", "conv", "more", "more_words", *(f"more_{s}" for s in _SUMS), *(f"times_{s}" for s in _SUMS)]
        ddl = ", ".join(f"{n} {'int' if n == 'part' else 'long'}" for n in names)
        out = out.join(F.broadcast(spark.createDataFrame(carried, ddl)), ["part", "conv"], "left")
        here = F.col("more").isNotNull()
        out = out.withColumns({
            "place": F.when(here, F.col("place") + F.col("more")).otherwise(F.col("place")),
            "words": F.when(here, F.col("words") + F.col("more_words")).otherwise(F.col("words")),
            **{s: F.when(here, (F.col(f"more_{s}") + F.col(f"times_{s}") * F.col(s)) % PRIMES[k]).otherwise(F.col(s)) for k, s in enumerate(_SUMS)},
        })
    return out.select("conv", "place", "own", "words", *_SUMS)


# Rebuilding ----------------------------------------------------------------


def _shifted(k: int, shift: Column) -> Column:
    """BASES[k] to the power of ``shift``, which is 0 to -MOST_SHARED."""
    inverse = pow(BASES[k], -1, PRIMES[k])
    return F.get(F.array(*[F.lit(pow(inverse, e, PRIMES[k])) for e in range(MOST_SHARED + 1)]), -shift)


def _key(sums: list[Column]) -> dict[str, Column]:
    return {"ka": F.shiftleft(sums[0], 31) + sums[1], "kb": F.shiftleft(sums[2], 31) + sums[3]}


def _at(name: str, place: Column) -> Column:
    """A conversation's running total after ``place`` turns (at most MOST_SHARED)."""
    return F.get(F.array(F.lit(0).cast("long"), *[F.col(f"{name}_{j}") for j in range(1, MOST_SHARED + 1)]), place)


def _rebuilt_sums(total: dict[str, Column]) -> tuple[list[Column], Column]:
    """Hash sums and words of a rebuilt prefix that ends in the conversation's
    own turns, from its own totals there."""
    sums = []
    for k, s in enumerate(_SUMS):
        own = F.pmod(total[s] - F.col(f"skip_{s}"), F.lit(PRIMES[k]))
        sums.append((F.col(f"lead_{s}") + _shifted(k, F.col("shared") - F.col("most")) * own) % PRIMES[k])
    return sums, F.col("lead_words") + total["words"] - F.col("skip_words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """One row for each conversation: how many turns it takes from the first of
    its group (``shared``) in place of its first ``most``, its depth and words,
    and the key of the whole rebuilt sequence."""
    totals = ["words", *_SUMS]
    early = {f"{t}_{j}": F.max(F.when(F.col("place") == j - 1, F.col(t))) for t in totals for j in range(1, MOST_SHARED + 1)}
    last = {f"last_{s}": F.max_by(s, "place") for s in _SUMS} | {"last_words": F.max("words")}
    own = turns.groupBy("conv").agg((F.max("place") + 1).alias("turns"), *[c.alias(n) for n, c in {**early, **last}.items()])
    own = stored(own, "trie-own")
    first = own.where(F.pmod("conv", F.lit(GROUP)) == 0).select(
        F.col("conv").alias("first"), F.col("turns").alias("first_turns"), *[F.col(n).alias(f"first_{n}") for n in early]
    )
    most = (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    convs = own.withColumns({"most": most, "first": F.try_subtract("conv", F.pmod("conv", F.lit(GROUP)))}).join(first, "first", "left")
    convs = convs.withColumn("shared", F.least("most", F.coalesce("first_turns", F.lit(0))).cast("int"))
    lead = {f"lead_{t}": _at(f"first_{t}", F.col("shared")) for t in totals}
    skip = {f"skip_{t}": F.coalesce(_at(t, F.col("most")), F.lit(0)) for t in totals}
    convs = convs.withColumns({**lead, **skip, "depth": F.col("shared") + F.greatest(F.lit(0), F.col("turns") - F.col("most"))})
    sums, words = _rebuilt_sums({t: F.col(f"last_{t}") for t in totals})
    more = F.col("turns") > F.col("most")
    whole = {"total": F.when(more, words).otherwise(F.col("lead_words"))}
    whole |= _key([F.when(more, sums[k]).otherwise(F.col(f"lead_{s}")) for k, s in enumerate(_SUMS)])
    kept = ["conv", "turns", "most", "shared", "depth", "total", "ka", "kb", *lead, *skip, *(f"first_{n}" for n in early)]
    return convs.withColumns(whole).select(*kept)


def _prefixes(turns: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """Every prefix of the chosen conversations, the empty one included: (rep,
    weight, depth, total, d, ka, kb, words up to it, words of its last turn)."""
    same = ["rep", "weight", "depth", "total"]
    own = joined(turns.withColumnRenamed("conv", "rep"), chosen, ["rep"], F.col("turns") >= rows / HEAVY).where(F.col("place") >= F.col("most"))
    sums, words = _rebuilt_sums({t: F.col(t) for t in ["words", *_SUMS]})
    d = F.col("shared") + F.col("place") - F.col("most") + 1
    own = own.select(*same, d.cast("long").alias("d"), *[c.alias(n) for n, c in _key(sums).items()], words.alias("words"), "own")
    lead = chosen.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("shared"))))
    here = {t: _at(f"first_{t}", F.col("d")) for t in ["words", *_SUMS]}
    before = F.when(F.col("d") > 0, _at("first_words", F.col("d") - 1)).otherwise(F.lit(0))
    lead = lead.select(
        *same, F.col("d").cast("long").alias("d"), *[c.alias(n) for n, c in _key([here[s] for s in _SUMS]).items()],
        here["words"].alias("words"), (here["words"] - before).alias("own"),
    )
    return own.unionByName(lead)


# Ends ----------------------------------------------------------------------

_PIECE = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])
_PIECE_DDL = "depth long, ka long, kb long, first long, ids binary"
_ENDS = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("ends_sha256", pa.string())])


def _end_pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, ka, kb, conv) rows as comma-joined pieces of one key, of
    at most ``most`` ids."""
    for b in batches:
        keys = [np.array(b.column(c)) for c in ("depth", "ka", "kb")]
        ids = b.column("conv").to_pylist()
        if not ids:
            continue
        change = np.zeros(len(ids), bool)
        change[0] = True
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        begins = np.flatnonzero(change)
        cuts = np.concatenate([np.arange(lo, hi, most) for lo, hi in zip(begins, [*begins[1:], len(ids)], strict=True)])
        stops = np.append(cuts[1:], len(ids))
        yield record_batch({
            "depth": keys[0][cuts], "ka": keys[1][cuts], "kb": keys[2][cuts], "first": [ids[a] for a in cuts],
            "ids": [",".join(map(str, ids[a:z])).encode() for a, z in zip(cuts, stops, strict=True)],
        }, _PIECE)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for b in batches:
        done = []
        for *now, ids in zip(*(b.column(c).to_pylist() for c in ("depth", "ka", "kb", "ids")), strict=True):
            if now != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        if done:
            yield record_batch(dict(zip(_ENDS.names, zip(*done, strict=True), strict=True)), _ENDS)
    if key is not None:
        yield record_batch(dict(zip(_ENDS.names, zip((*key, digest.hexdigest()), strict=True), strict=True)), _ENDS)


def ends(convs: DataFrame, piece_ids: int = END_IDS) -> DataFrame:
    """(depth, ka, kb, ends_sha256) for each distinct whole sequence."""
    key = ["depth", "ka", "kb"]
    pieces = convs.select(*key, "conv").orderBy(*key, "conv").mapInArrow(lambda it: _end_pieces(it, piece_ids), _PIECE_DDL)
    ordered = pieces.repartition(*key).sortWithinPartitions(*key, "first")
    return ordered.select(*key, "ids").mapInArrow(_end_digests, "depth long, ka long, kb long, ends_sha256 string")


# Nodes ---------------------------------------------------------------------


def nodes(conversations: DataFrame, piece_ids: int = END_IDS) -> DataFrame:
    """The trie's nodes, as the module's text states."""
    key = ["d", "ka", "kb"]
    turns = numbered_turns(conversations)
    convs = stored(rebuilt(turns), "trie-conversations")
    # Identical rebuilt conversations collapse into one weighted sequence.
    sequences = stored(convs.groupBy("depth", "ka", "kb", "total").agg(F.min("conv").alias("rep"), F.count("*").alias("weight")), "trie-sequences")
    smallest = sequences.agg(F.min("rep")).first()[0]
    chosen = convs.withColumnRenamed("conv", "rep").drop("ka", "kb", "depth", "total").join(sequences.drop("ka", "kb"), "rep")
    chosen = stored(chosen, "trie-chosen")
    rows = turns.count()
    prefixes = stored(_prefixes(turns, chosen, rows), "trie-prefixes")
    rows = prefixes.count()

    met = stored(prefixes.groupBy(*key).agg(F.min("rep").alias("owner"), F.max("depth").alias("deepest"), F.count("*").alias("met")), "trie-met")
    proper = met.where(F.col("deepest") > F.col("d")).select(F.col("d").alias("depth"), "ka", "kb")
    leaves = sequences.join(proper, ["depth", "ka", "kb"], "left_anti").select("rep", F.lit(1).alias("leaf"))

    # The deepest node of a sequence that another one owns; the root aside.
    shared = met.where((F.col("met") > 1) & (F.col("d") > 0)).select(*key, "owner", "met")
    others = joined(prefixes.select("rep", *key, "words").where(F.col("d") > 0), shared, key, F.col("met") >= rows / HEAVY)
    others = others.where(F.col("owner") != F.col("rep")).groupBy("rep").agg(
        (F.max("d") + 1).alias("from_depth"), F.max_by("owner", "d").alias("above"), F.max_by("words", "d").alias("words_above")
    )
    paths = sequences.select("rep", F.col("depth").alias("length")).join(others, "rep", "left").join(leaves, "rep", "left").select(
        "rep", "length", F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.coalesce("from_depth", F.when(F.col("rep") == F.lit(smallest), 0).otherwise(1)).alias("from_depth"),
        F.coalesce("above", F.lit(smallest)).alias("above"), F.coalesce("words_above", F.lit(0)).alias("words_above"),
    )
    through = joined(prefixes, stored(paths, "trie-paths"), ["rep"], F.col("length") + 1 >= rows / HEAVY)
    c = F.col
    owned, before = c("d") >= c("from_depth"), c("words") - c("own")
    made = through.groupBy(*key).agg(
        F.min("rep").alias("conv_id"),
        F.max(F.when(c("d") > 0, F.when(c("d") > c("from_depth"), c("rep")).when(owned, c("above")))).alias("parent_conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.when((c("d") + 1 >= c("from_depth")) & (c("d") < c("depth")), 1).otherwise(0)).alias("n_children"),
        F.sum("leaf").cast("long").alias("n_leaves"),
        (F.sum(c("weight") * (c("total") - before)) - F.sum(c("total") - F.when(owned, before).otherwise(c("words_above")))).alias("saved_tokens"),
    )
    made = made.join(ends(convs, piece_ids).withColumnRenamed("depth", "d"), key, "left")
    return made.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(table(spark, sf_dir, "conversations"))
