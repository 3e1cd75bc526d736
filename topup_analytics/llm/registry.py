"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from topup_analytics.llm import bpe, chat, extraction, infill, jaccard, language, licenses, lm, mixing, quality, sharding, topk, whitening

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    """One query for each operator."""
    return {
        "op1_maxent_scores": lm.op1_maxent_scores,
        "op2_bit_sliced_top_k": topk.op2_bit_sliced_top_k,
        "op3_byte_bpe": bpe.op3_byte_bpe,
        "op4_stratified_shards": sharding.op4_stratified_shards,
        "op5_chat_format": chat.op5_chat_format,
        "op6_source_mixture": mixing.op6_source_mixture,
        "op7_license_scan": licenses.op7_license_scan,
        "op8_language_mixture": language.op8_language_mixture,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_jaccard_join": jaccard.op10_jaccard_join,
        "op11_html_extraction": extraction.op11_html_extraction,
        "op12_embedding_whitening": whitening.op12_embedding_whitening,
        "op13_fill_in_middle": infill.op13_fill_in_middle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {
        "op2_bit_sliced_top_k": topk.OP2_SQL,
        "op4_stratified_shards": sharding.OP4_SQL,
        "op5_chat_format": chat.OP5_SQL,
        "op6_source_mixture": mixing.OP6_SQL,
        "op7_license_scan": licenses.OP7_SQL,
        "op9_quality_rules": quality.OP9_SQL,
        "op10_jaccard_join": jaccard.OP10_SQL,
        "op13_fill_in_middle": infill.OP13_SQL,
    }
