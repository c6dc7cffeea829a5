"""op1_ann_forest: the 20 nearest embeddings of each with a vec_id divisible
by 20, by inner product.

No SQL: an approximate search; ``tests/llm`` measures its recall against brute
force."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.ann_forest import search
from cabflow.llm.common import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)
