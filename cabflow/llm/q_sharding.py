"""op6_sharding: all documents in random order over 16 shards.

No SQL: the order comes from seeded permutations; ``tests/llm`` holds counts,
slots and the order against a plain-Python version."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table
from cabflow.llm.sharding import to_scratch


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return to_scratch(docs, shards=16, seed=6).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
