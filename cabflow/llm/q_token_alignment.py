"""op11_token_alignment: two tokenizers aligned over every document.

No SQL: the encoders are sequential rewritings; ``tests/llm`` compares with a
brute-force alignment of the libraries' tokens."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table
from cabflow.llm.token_alignment import align


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    return align(table(spark, sf_dir, "documents")).withColumn("groups_sha256", digest).drop("groups")
