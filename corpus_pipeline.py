"""Corpus pipeline: language, quality, near-duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm import bpe_codec, langid, mixing, ngram_join, quality_crf
from cabflow.llm.common import table, written
from cabflow.llm.q_langid import held_out as held_out_language
from cabflow.llm.q_quality_crf import held_out as held_out_quality


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the model learns from the
    labelled documents of the input."""
    return langid.reject(docs, langid.fit(docs.where(~held_out_language())))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not of low quality; the model learns from the
    labelled ones among them."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality_crf.reject(docs, quality_crf.fit(docs.where(~held_out_quality()),
                                                    labels.where(~held_out_quality())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights."""
    return mixing.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_codec.round_trip_digests(docs)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("mixture", mixture),
          ("tokens", tokens)]

#: The stages rest on learned models and reachability, which SQL cannot
#: express; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
