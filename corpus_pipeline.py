"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before it kept; all but the last return the columns of ``documents``. ``run``
writes each stage's rows as Parquet into the shared folder and reads them back
for the next, so a lost executor costs at most a stage's own tasks.

Stages: the quality classifier rejects documents; lines of recurring templates
go; of each group of near copies (five-word shingles, similarity 0.8) one
document stays; documents that hold a benchmark item go; what is left is
tokenised and packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sessionlens.llm import op3_quality, op4_packing, op5_decontamination, op8_minhash, op10_line_templates
from sessionlens.llm.common import stored, table

PACKING_WORDS = 100_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_line_templates.drop_lines(docs).select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors that have run all the stages have little room left: fewer words
    # are kept, and more are encoded again.
    return op4_packing.pack(docs, words=PACKING_WORDS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

# Training, hashing and tokenising have no SQL form; tests/llm hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
