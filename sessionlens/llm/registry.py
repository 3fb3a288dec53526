"""The registered queries of this package and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sessionlens.llm import (
    op10_line_templates,
    op11_token_alignment,
    op12_byte_bpe,
    op13_prefix_trie,
    op1_token_index,
    op2_maxent_lm,
    op3_quality,
    op4_packing,
    op5_decontamination,
    op6_token_counts,
    op7_url_rules,
    op8_minhash,
    op9_digest,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_token_index": op1_token_index.query,
        "op2_lm_score": op2_maxent_lm.query,
        "op3_quality": op3_quality.query,
        "op4_best_fit_packing": op4_packing.query,
        "op5_decontaminate": op5_decontamination.query,
        "op6_token_counts": op6_token_counts.query,
        "op7_url_filter": op7_url_rules.query,
        "op8_near_duplicates": op8_minhash.query,
        "op9_fingerprint": op9_digest.query,
        "op10_line_templates": op10_line_templates.query,
        "op11_token_alignment": op11_token_alignment.query,
        "op12_byte_bpe": op12_byte_bpe.query,
        "op13_prefix_trie": op13_prefix_trie.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_url_filter": op7_url_rules.ORACLE_SQL, "op10_line_templates": op10_line_templates.ORACLE_SQL}
