"""op7_token_counts: tokens of every document.

No SQL: the merges are a sequential rewriting; ``tests/llm`` compares with the
tokenizers library."""

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.common import table
from cabflow.llm.token_counts import token_counts


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), limit=1024)
