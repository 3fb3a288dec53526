"""Shared pieces of the operator tests."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use themselves.
CLASHES = ("kid", "print", "body", "raw", "row", "score", "predicted", "label", "key", "hash", "lines_dropped", "n", "part")


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows, extra=True):
        from pyspark.sql import functions as F

        data = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(data, DOCS)
        return df.withColumns({c: F.lit(None if c == "raw" else 7).cast("string") for c in CLASHES}) if extra else df

    return make


ODD_TEXTS = [
    (5, None), (3, ""), (9, "   \t\n "), (None, "a null id"), (None, None), (7, "twice the same row"), (7, "twice the same row"),
    (7, "the same id, another text"), (11, "x"), (12, "two words"), (13, "don't I'LL <|endoftext|> ça é 12345 ### a\u000bb\u000cc d\u001ce f g 你好 \U0001f600"),
    (14, "word " * 60_000), (15, "y" * 70_000), (-4, "negative id"), (16, "İSTANBUL ΣΣ ﬁne"),
]
