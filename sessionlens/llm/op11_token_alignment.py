"""Alignment of two tokenizers' tokens over each document, in Arrow.

Each text is encoded with a blank in front by a byte-level BPE (A) and a
SentencePiece model (B). Inside a task all documents of a batch are handled
together as Arrow tables: token lists are flattened with their parent indices,
byte ends come from cumulative sums cut at each document, and an Acero full
outer hash join of A and B on the document-end key (document and byte end) gives
every place where a token ends. Filled backwards, each such place is one link:
the only piece of text that its A token and its B token share. Places where both
end cut the groups.

``align`` returns the links of each document. ``pair_counts`` groups them in
each task (``Table.group_by``) and Spark adds the partial counts up. For the
figures of a document each link needs its pair's count over the corpus: pairs
that hold at least 1/``COMMON`` of all links (so at most ``COMMON`` of them) are
sent to every task; the links of all other pairs, few by the same rule, are
joined by shuffle and added.

Runs of blanks and line breaks with the word behind them are encoded once in a
worker (bounded memory); tests hold this against encoding whole texts.

Defined results: texts that are null, empty or not given back by their A or B
tokens (a U+2581 in the text, for one) have no links; repeated rows and null
doc_ids count like any other row; a text has no length limit; an empty table
gives no rows; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens import runtime
from sessionlens.llm.common import chunks, prepare, raw_text, stored, table
from sessionlens.llm.pretokens import WordMemory

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
COMMON = 1 << 20
_CHUNK_BYTES = 1 << 20
_PARTIAL_ROWS = 1 << 19  # pairs a task counts before it sends them on
_BLANK = "▁"

# A link is one long: A id << 32 | B id << 2 | which of the two tokens end with
# it (1: A's, 2: B's, 3: both, so a group).
_A_SHIFT, _B_SHIFT, _BOTH = 32, 2, 3


class ByteLevel:
    """Tokenizer A: ids of runs, bytes of ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        vocabulary = library.get_vocab()
        piece = [b""] * (max(vocabulary.values()) + 1)
        byte_of = _byte_level()
        for entry, i in vocabulary.items():
            piece[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.pieces = pa.array(piece, pa.binary())
        self.runs = lambda runs: [_packed(e.ids) for e in library.encode_batch_fast(runs, add_special_tokens=False)]
        # The pattern of byte-level BPE never joins a word to white space behind it.
        splitter = json.loads(library.to_str())
        self.by_run = splitter["normalizer"] is None and (splitter["pre_tokenizer"] or {}).get("type") == "ByteLevel"


class SentencePieces:
    """Tokenizer B: ids of runs, bytes of ids."""

    _PROBE = "a  b\tc\n\nﬁ é "

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [library.id_to_piece(i) for i in range(library.vocab_size())]
        piece = [bytes([int(n[1:-1], 16)]) if library.is_byte(i) else n.replace(_BLANK, " ").encode() for i, n in enumerate(names)]
        self.pieces = pa.array(piece, pa.binary())
        # No piece has a blank behind another character or holds a line break,
        # and texts are not rewritten.
        kept = b"".join(piece[i] for i in library.encode(self._PROBE)) == b" " + self._PROBE.encode()
        self.by_run = kept and not any(_BLANK in n.lstrip(_BLANK) or "\n" in n for n in names)
        blank = _packed([library.piece_to_id(_BLANK)])

        def runs(part: list[str]) -> list[bytes]:
            # The library puts one blank in front by itself; before a line break
            # that is a token of its own.
            own = [r[0] != " " for r in part]
            ids = library.encode([r if o else r[1:] for r, o in zip(part, own, strict=True)], num_threads=1)
            return [blank if r == " " else _packed(i[o:]) for r, o, i in zip(part, own, ids, strict=True)]

        self.runs = runs


class Pair:
    """Both tokenizers. A text is cut into runs of blanks and line breaks with
    the word behind them, across which neither joins anything; a worker encodes
    each run once. A text with other white space is one run."""

    _RUN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    _ODD_ASCII = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
    _ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), SentencePieces(path_b)
        self.by_run = self.a.by_run and self.b.by_run
        self.memory = [WordMemory(x.runs) for x in (self.a, self.b)]

    def _plain(self, text: bytes) -> bool:
        if not self.by_run or len(text.translate(None, self._ODD_ASCII)) != len(text):
            return False
        return text.isascii() or self._ODD.search(text) is None

    def encode(self, texts: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """The ids of each text with a blank in front, by A and by B; none for
        texts that are empty or hold B's own sign for a blank."""
        runs: list[str] = []
        cuts = [0]
        for text in texts:
            spaced = " " + text.decode("utf-8", "replace")
            if text and _BLANK not in spaced:
                runs += self._RUN.findall(spaced) if self._plain(text) else [spaced]
            cuts.append(len(runs))
        coded = pa.array(runs, pa.string()).dictionary_encode()
        different = coded.dictionary.to_pylist()
        wanted = set(different)
        out = []
        for memory in self.memory:
            ids = _lists(list(map(memory.know(wanted), different))).take(coded.indices)
            ends = np.concatenate([[0], np.cumsum(np.array(pc.list_value_length(ids)))])
            out.append(pa.ListArray.from_arrays(pa.array(ends[cuts].astype(np.int32)), ids.flatten()))
        return out[0], out[1]


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _byte_level() -> dict[str, int]:
    """Character -> byte of byte-level entries: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@cache
def _pair(path_a: str, path_b: str) -> Pair:
    pa.set_cpu_count(1)
    return Pair(path_a, path_b)


# Alignment in Arrow ----------------------------------------------------------


def _lists(ids: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _ends(tokens: pa.ListArray, pieces: pa.BinaryArray, name: str) -> pa.Table:
    """(doc_end, id) of each token: its document and the byte where it ends."""
    ids = tokens.flatten()
    total = pc.cumulative_sum(pc.take(pc.binary_length(pieces).cast(pa.int64()), ids))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), total]), tokens.offsets.slice(0, len(tokens)))
    doc = pc.list_parent_indices(tokens).cast(pa.int64())
    end = pc.subtract(total, pc.take(before, doc))
    return pa.table({"doc_end": pc.bit_wise_or(pc.shift_left(doc, 32), end), name: ids})


def _joined(tokens: pa.ListArray, pieces: pa.BinaryArray) -> pa.BinaryArray:
    return pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, pc.take(pieces, tokens.flatten())), b"")


def links_of(texts: list[bytes], pair: Pair) -> pa.ListArray:
    """The links of each text, in order."""
    left, right = pair.encode(texts)
    wanted = pa.array([b" " + t for t in texts], pa.binary())
    whole = pc.and_(pc.equal(_joined(left, pair.a.pieces), wanted), pc.equal(_joined(right, pair.b.pieces), wanted))
    if not pc.all(whole).as_py():
        none = pa.array([], pa.int32())
        left, right = (pc.if_else(whole, x, pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), none)[0]) for x in (left, right))
    places = _ends(left, pair.a.pieces, "a").join(_ends(right, pair.b.pieces, "b"), keys="doc_end", join_type="full outer", use_threads=False)
    places = places.sort_by("doc_end").combine_chunks()
    a_id, b_id = (places.column(c).combine_chunks() for c in ("a", "b"))
    ends = pc.add(pc.is_valid(a_id).cast(pa.int64()), pc.shift_left(pc.is_valid(b_id).cast(pa.int64()), 1))
    a_id, b_id = (pc.fill_null_backward(x).cast(pa.int64()) for x in (a_id, b_id))
    links = pc.bit_wise_or(pc.bit_wise_or(pc.shift_left(a_id, _A_SHIFT), pc.shift_left(b_id, _B_SHIFT)), ends)
    doc = np.array(places.column("doc_end")) >> 32
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), links)


_ALIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("links", pa.list_(pa.int64()))])


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    pair = _pair(path_a, path_b)
    for batch in batches:
        raw = batch.column("raw").to_pylist()
        for lo, hi in chunks([len(t) for t in raw], _CHUNK_BYTES):
            own = batch.slice(lo, hi - lo)
            links = links_of(raw[lo:hi], pair)
            yield pa.RecordBatch.from_arrays([own.column("row"), own.column("doc_id"), links.cast(_ALIGNED.field("links").type)], schema=_ALIGNED)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(row, doc_id, links) of each row of ``docs``; ``row`` tells rows apart.
    ``a_id``, ``b_id`` and ``ends_with`` read a link."""
    prepare(docs.sparkSession)
    path_a = path_a or public_tokenizers.path(TOKENIZER_A)
    path_b = path_b or public_tokenizers.path(TOKENIZER_B)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
    return rows.mapInArrow(lambda it: _align(it, path_a, path_b), "row long, doc_id long, links array<long>")


def a_id(link):
    return F.shiftright(link, _A_SHIFT).cast("int")


def b_id(link):
    return F.shiftright(link.bitwiseAND(F.lit((1 << _A_SHIFT) - 1)), _B_SHIFT).cast("int")


def ends_with(link):
    return link.bitwiseAND(F.lit(_BOTH)).cast("int")


def written(aligned: DataFrame) -> DataFrame:
    """``aligned`` as a table in the shared folder. Links are small numbers that
    repeat in runs, so they are kept plain and compressed by zstd."""
    spark = aligned.sparkSession
    path = runtime.table_path(spark, "llm-alignment")
    aligned.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(aligned.schema).parquet(path)


# Corpus counts ---------------------------------------------------------------

_COUNT_DDL = "pair long, n long"


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged(parts: list[pa.Table]) -> pa.Table:
        both = pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        return both.select(["pair", "n_sum"]).rename_columns(["pair", "n"])

    held: list[pa.Table] = []
    for b in batches:
        pair = pc.shift_right(b.column("links").flatten(), _B_SHIFT)
        part = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        held = [merged([*held, part.rename_columns(["pair", "n"])])]
        if held[0].num_rows >= _PARTIAL_ROWS:
            yield from held.pop().to_batches()
    if held and held[0].num_rows:
        yield from held[0].to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): how many links of the corpus hold each pair of
    ids, and whether no other A id has more links with this B id."""
    partial = aligned.select("links").mapInArrow(_partial_counts, _COUNT_DDL)
    low = F.lit((1 << (_A_SHIFT - _B_SHIFT)) - 1)
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.withColumns({"a": F.shiftright("pair", _A_SHIFT - _B_SHIFT).cast("int"), "b": F.col("pair").bitwiseAND(low).cast("int")})
    counts = stored(counts, "alignment-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # at most B's vocabulary
    return stored(counts.join(F.broadcast(most), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-pairs")


# Figures of a document -------------------------------------------------------

_FIGURES = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64())] + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string()), ("rest", pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())])))]
)
_FIGURES_DDL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
    "rest array<struct<pair: long, links: long>>"
)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


@cache
def _numerals(most: int) -> pa.StringArray:
    """'i,' for A or B, 'i|' (the last A token of a group), 'i;' (the last B)."""
    ids = [str(i) for i in range(most)]
    return pa.array([i + mark for mark in ",|;" for i in ids])


def groups_text(links: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The groups of each document as ``a1,a2|b1;a3|b2,b3``."""
    ends = links & _BOTH
    a, b = links >> _A_SHIFT, links >> _B_SHIFT & (1 << (_A_SHIFT - _B_SHIFT)) - 1
    closing = ends == _BOTH
    group = np.cumsum(closing) - closing
    n_groups = int(closing.sum())
    most = int(max(a.max(initial=0), b.max(initial=0))) + 1
    numerals = _numerals(1 << (most - 1).bit_length())
    size = len(numerals) // 3
    has_a, has_b = (ends & 1) > 0, (ends & 2) > 0
    # A group's A tokens come first, then its B tokens.
    upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(group[h], minlength=n_groups))]) for h in (has_a, has_b))
    text = np.empty(upto_a[-1] + upto_b[-1], np.int64)
    text[np.arange(upto_a[-1]) + upto_b[group[has_a]]] = a[has_a]
    text[np.arange(upto_b[-1]) + upto_a[group[has_b] + 1]] = b[has_b]
    text[upto_a[1:] + upto_b[:-1] - 1] += size
    text[upto_a[1:] + upto_b[1:] - 1] += 2 * size
    cuts = _sums(has_a.astype(np.int64) + has_b, offsets)
    tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(cuts)]).astype(np.int32)), pc.take(numerals, pa.array(text)))
    return [t[:-1] for t in pc.binary_join(tokens, "").to_pylist()]


def _figures(batches: Iterator[pa.RecordBatch], common: pa.Table) -> Iterator[pa.RecordBatch]:
    pa.set_cpu_count(1)
    for batch in batches:
        n, lists = batch.num_rows, batch.column("links")
        if not n:
            continue
        links = np.array(lists.flatten())
        offsets = np.concatenate([[0], np.cumsum(np.array(pc.list_value_length(lists)))])
        ends = links & _BOTH
        doc = pc.list_parent_indices(lists).cast(pa.int64())
        held = pa.table({"doc": doc, "pair": pa.array(links >> _B_SHIFT)}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        held = held.rename_columns(["doc", "pair", "links"]).join(common, keys="pair", join_type="left outer", use_threads=False)
        known = held.filter(pc.is_valid(held["n"]))
        weighed = known.append_column("sum", pc.multiply(known["links"], known["n"])).append_column("top", pc.multiply(known["links"], known["best"]))
        weighed = weighed.group_by("doc", use_threads=False).aggregate([("sum", "sum"), ("top", "sum")])
        count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        count_sum[weighed["doc"].to_numpy()] = weighed["sum_sum"].to_numpy()
        n_best[weighed["doc"].to_numpy()] = weighed["top_sum"].to_numpy()
        rest = held.filter(pc.is_null(held["n"])).sort_by("doc")
        rest_at = np.concatenate([[0], np.cumsum(np.bincount(rest["doc"].to_numpy(), minlength=n))]).astype(np.int32)
        rest_rows = pa.StructArray.from_arrays([rest[c].combine_chunks() for c in ("pair", "links")], fields=list(_FIGURES.field("rest").type.value_type))
        digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in groups_text(links, offsets)]
        yield pa.RecordBatch.from_arrays([
            batch.column("row"), batch.column("doc_id"),
            *(pa.array(x, pa.int64()) for x in (_sums(ends & 1, offsets), _sums(ends >> 1, offsets), _sums(ends == _BOTH, offsets), np.diff(offsets))),
            pa.array(n_best), pa.array(count_sum), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(rest_at), rest_rows),
        ], schema=_FIGURES)


def figures(aligned: DataFrame, pairs: DataFrame, common: int = COMMON) -> DataFrame:
    """A row of figures for each row of ``aligned`` (a written table)."""
    all_links = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = pairs.where(F.col("n") * common >= F.lit(all_links)).select("pair", "n", F.col("best").cast("long").alias("best"))
    table_ = often.toArrow()  # at most ``common`` rows, by the share each has
    made = aligned.mapInArrow(lambda it: _figures(it, table_), _FIGURES_DDL)
    made = stored(made, "alignment-figures")
    rest = made.select("row", F.inline("rest")).join(pairs, "pair").groupBy("row").agg(
        F.sum(F.col("links") * F.col("n")).alias("rest_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rest_best")
    )
    made = made.drop("rest").join(rest, "row", "left")
    return made.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = written(align(table(spark, sf_dir, "documents")))
    return figures(aligned, pair_counts(aligned))
