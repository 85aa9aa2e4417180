"""Training-data operators: the registered queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallystock.llm import (
    centroids, decontamination, hard_negatives, html_text, jaccard_join, packing, quality_rules, secret_scan,
    sentencepiece_ids, sharding, substring_dedup, token_files, top_k)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secret_scan.op1,
        "op2_best_fit_packing": packing.op2,
        "op3_token_output": token_files.op3,
        "op4_exact_top_k": top_k.op4,
        "op5_sharding": sharding.op5,
        "op6_sentencepiece": sentencepiece_ids.op6,
        "op7_quality_rules": quality_rules.op7,
        "op8_html_extraction": html_text.op8,
        "op9_substring_dedup": substring_dedup.op9,
        "op10_ngram_jaccard_join": jaccard_join.op10,
        "op11_decontamination": decontamination.op11,
        "op12_centroid_clustering": centroids.op12,
        "op13_hard_negatives": hard_negatives.op13,
    }


def oracles() -> dict[str, str]:
    return {
        "op4_exact_top_k": top_k.OP4_SQL,
        "op9_substring_dedup": substring_dedup.OP9_SQL,
        "op10_ngram_jaccard_join": jaccard_join.OP10_SQL,
        "op11_decontamination": decontamination.OP11_SQL,
        "op12_centroid_clustering": centroids.OP12_SQL,
        "op13_hard_negatives": hard_negatives.OP13_SQL,
    }
