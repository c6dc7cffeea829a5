"""op3_bpe_codec: byte-pair encoding and decoding of every document.

No SQL: the merges are a sequential rewriting; ``tests/llm`` compares with the
tokenizers library."""

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.bpe_codec import round_trip_digests
from cabflow.llm.common import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"))
