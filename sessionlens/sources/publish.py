"""Tables that are replaced without ever being absent.

A load writes a new folder ``v-...`` under the table's root. When the write and
its validation have succeeded, one small file, ``_CURRENT``, is replaced by a
rename; readers follow it. A load that fails before that leaves the version
that was there, and a reader keeps the files it has planned to read: versions
are removed only beyond the newest ``keep``. There is no log and no metadata
besides the pointer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"
KEEP = 2


class _Folder:
    """A folder of the cluster's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.root = self.path(root.rstrip("/"))
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def read(self, name: str) -> str | None:
        at = self.child(name)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write beside, then rename over: readers see the old or the new text."""
        beside = self.child(f"{name}.{uuid.uuid4().hex[:12]}")
        stream = self.fs.create(beside, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        over = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        over[0] = options.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        context.rename(self.fs.makeQualified(beside), self.fs.makeQualified(self.child(name)), over)

    def versions(self) -> list[str]:
        """Oldest first, by the number in the name."""
        found = [s.getPath().getName() for s in self.fs.listStatus(self.root)] if self.fs.exists(self.root) else []
        return sorted((n for n in found if n.startswith("v-")), key=lambda n: (int(n.split("-")[1]), n))


def current_path(spark: SparkSession, root: str) -> str | None:
    """The folder that readers read, None before the first publish."""
    version = _Folder(spark, root).read(POINTER)
    return version and f"{root.rstrip('/')}/{version.strip()}"


def publish(
    spark: SparkSession, root: str, write: Callable[[str], object], validate: Callable[[str], None] | None = None, keep: int = KEEP
) -> str:
    """Call ``write(folder)`` with a new version's folder and ``validate`` on it
    (which raises to refuse it), then make it the current one. Returns its
    folder. A refused or failed version is removed."""
    folder = _Folder(spark, root)
    taken = folder.versions()
    number = int(taken[-1].split("-")[1]) + 1 if taken else 1
    version = f"v-{number:06d}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{version}"
    try:
        write(path)
        if validate:
            validate(path)
    except BaseException:
        folder.fs.delete(folder.child(version), True)
        raise
    before = (folder.read(POINTER) or "").strip()
    folder.replace(POINTER, version)
    kept = {version, before, *taken[-max(keep - 1, 0) :]} if keep > 1 else {version, before}
    for old in taken:
        if old not in kept:
            folder.fs.delete(folder.child(old), True)
    return path


def publish_table(df: DataFrame, root: str, validate: Callable[[DataFrame], None] | None = None, keep: int = KEEP) -> DataFrame:
    """Publish ``df`` as Parquet and read it back; ``validate`` gets the written
    table before it becomes current."""
    spark = df.sparkSession
    check = (lambda p: validate(spark.read.schema(df.schema).parquet(p))) if validate else None
    return spark.read.schema(df.schema).parquet(publish(spark, root, lambda p: df.write.parquet(p), check, keep))
