"""The queries of this subpackage and their SQL oracles, for the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat_format,
    embedding_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    token_counts,
    token_output,
    url_filters,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts.query,
        "op2_quality_rules": quality_rules.query,
        "op3_chat_format": chat_format.query,
        "op4_url_filters": url_filters.query,
        "op5_embedding_near_dedup": embedding_dedup.query,
        "op6_mixing": mixing.query,
        "op7_token_output": token_output.query,
        "op8_best_fit_packing": packing.query,
        "op9_quality_classifier": quality_classifier.query,
        "op10_simhash_near_dedup": simhash_dedup.query,
    }


def oracle_sql() -> dict[str, str]:
    """Token ids, the trained classifier and 64-bit hashes are beyond SQL; tests hold those to brute force."""
    return {
        "op2_quality_rules": quality_rules.ORACLE,
        "op3_chat_format": chat_format.ORACLE,
        "op4_url_filters": url_filters.ORACLE,
        "op5_embedding_near_dedup": embedding_dedup.ORACLE,
        "op6_mixing": mixing.ORACLE,
    }
