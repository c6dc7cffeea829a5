"""Registered queries of the subpackage and, where SQL can express one, the
DuckDB SQL for it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: query name -> module of the subpackage with ``query(spark, sf_dir)`` and
#: maybe ``ORACLE_SQL``
_QUERIES = {
    "op1_ann_forest": "q_ann_forest",
    "op2_quality_crf": "q_quality_crf",
    "op3_bpe_codec": "q_bpe_codec",
    "op4_langid": "q_langid",
    "op5_ngram_join": "q_ngram_join",
    "op6_sharding": "q_sharding",
    "op7_token_counts": "q_token_counts",
    "op8_mixing": "q_mixing",
    "op9_license_scan": "q_license_scan",
    "op10_vector_dedup": "q_vector_dedup",
    "op11_token_alignment": "q_token_alignment",
    "op12_toxicity": "q_toxicity",
    "op13_mask_ranking": "q_mask_ranking",
}


def _module(name: str):
    return importlib.import_module(f"cabflow.llm.{name}")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _module(name).query for key, name in _QUERIES.items()}


def oracle_queries() -> dict[str, str]:
    found = {key: getattr(_module(name), "ORACLE_SQL", None) for key, name in _QUERIES.items()}
    return {key: sql for key, sql in found.items() if sql}
