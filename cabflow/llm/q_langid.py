"""op4_langid: language of every document, learned from those whose
crc32(doc_id) mod 4 is not 2.

No SQL: n-gram backoff over a learned model; ``tests/llm`` holds it against a
plain-Python version and against held-out labels."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table, unsigned_crc32
from cabflow.llm.langid import fit, predict


def held_out():
    return F.coalesce(unsigned_crc32(F.col("doc_id")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
