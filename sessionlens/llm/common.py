"""Shared helpers: table reading, the shared folder, code shipping, text units."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens import runtime

# Arrow batches to Python workers are cut by bytes, so very long texts do not
# add up to a batch that a worker cannot hold.
ARROW_BATCH_BYTES = 8 << 20

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the Python operators and the package on the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(runtime.__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="sessionlens-code-"), "sessionlens_code.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "sessionlens")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        path = os.path.join(folder, n)
                        z.write(path, os.path.relpath(path, root))
        spark.sparkContext.addPyFile(target)
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    stages restart from these files when an executor is lost."""
    return runtime.materialize(df, f"llm-{name}")


# A shuffle has as many partitions as the session says, whatever it holds; a
# table of few rows is not written by more tasks than its rows need.
PART_ROWS = 2_000
LEAST_PARTS = 12


def parts_of(rows: int) -> int:
    """The number of partitions for ``coalesce``, which only lowers it."""
    return max(LEAST_PARTS, -(-rows // PART_ROWS))


def raw_text(col: str = "text") -> Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def remainder(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as
    empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D) of the text with A-Z
    lower-cased. ``bytes.lower`` and ``bytes.split`` know ASCII only, which is
    exactly this rule on UTF-8."""
    return text.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the splitmix64 finaliser) of a uint64 array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to about ``limit``."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the cluster's file system names it, with its scheme: a path
    without one means the default file system, not a machine's disk."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a qualified path. A scheme that Arrow does not
    know is refused; nothing is ever taken for a local path by default."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        raise ValueError(f"{path!r} names no file system that Arrow knows")
    return pafs.FileSystem.from_uri(path)


# What a Python worker keeps between its tasks (encoders with the words they
# know). Workers serve all operators of a session, one after another.
_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """The worker's object of this name, made once."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def release(*names: str) -> None:
    """Gives back to the system what earlier operators' tasks kept in this
    worker, but the objects of these names; called by tasks that need memory of
    their own."""
    for name in _KEPT.keys() - set(names):
        del _KEPT[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def record_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


# A side is broadcast only when it was counted and has no more rows and, if it
# holds lists, no more bytes than this; beyond, the same join shuffles both sides.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
NO_ID = -(1 << 63)


def counted(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it is small."""
    if df.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return df
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct", "string", "binary")]
    if lists:
        held = df.select(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in lists]))).alias("n"))
        if (held.agg(F.sum("n")).first()[0] or 0) > BROADCAST_BYTES:
            return df
    return F.broadcast(df)


# Keys that hold a larger part of a join's rows than 1 / HEAVY (so at most HEAVY
# of them) are joined by broadcast.
HEAVY = 1024


def joined(big: DataFrame, small: DataFrame, on: list[str], heavy: Column) -> DataFrame:
    """Inner join with ``small``, which has one row for each key and at most
    ``HEAVY`` rows that are ``heavy``. A small side that is counted to be small is
    broadcast; else its heavy rows are, so that a key with a large part of
    ``big`` stays spread over its tasks, and the rest is joined by shuffle."""
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on)
    hot = F.broadcast(small.where(heavy))
    rest = big.join(hot.select(*on), on, "left_anti").join(small.where(~heavy), on)
    return big.join(hot, on).unionByName(rest)


def keyed(docs: DataFrame) -> DataFrame:
    """Adds ``kid`` (the id, ``NO_ID`` for null), ``print`` (a hash of the
    text) and ``body`` (the text, empty for null): rows that agree in kid and
    print are the same document."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({
        "kid": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "print": F.xxhash64(body), "body": body,
    })


def whole_rows(docs: DataFrame) -> DataFrame:
    """(row, kid, print): the rows with all their columns in one struct, so no
    column's name can clash with an operator's own."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    return keyed(docs.select(F.struct(*own).alias("row"), "doc_id", "text")).select("row", "kid", "print")
