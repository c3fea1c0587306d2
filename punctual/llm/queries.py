"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctual.llm import embedding_dedup, fill_in_middle, hard_negatives, mixing, piece_codec, quality_classifier, quality_rules, recompression, simhash, suffix_dedup, token_counts, token_files, toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_token_files": token_files.query,
    "op2_quality_classifier": quality_classifier.query,
    "op3_recompression": recompression.query,
    "op4_quality_rules": quality_rules.query,
    "op5_nn_descent": embedding_dedup.query,
    "op6_sentencepiece": piece_codec.query,
    "op7_simhash": simhash.query,
    "op8_token_counts": token_counts.query,
    "op9_suffix_dedup": suffix_dedup.query,
    "op10_mixing": mixing.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_toxicity": toxicity.query,
    "op13_fill_in_middle": fill_in_middle.query,
}
ORACLES: dict[str, str] = {"op3_recompression": recompression.ORACLE, "op9_suffix_dedup": suffix_dedup.ORACLE, "op10_mixing": mixing.oracle(), "op11_hard_negatives": hard_negatives.ORACLE, "op13_fill_in_middle": fill_in_middle.ORACLE}
