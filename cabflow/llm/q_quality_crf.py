"""op2_quality_crf: quality of every document, learned from labelled ones
whose crc32(doc_id) mod 5 is not 0.

No SQL: a fitted random field; ``tests/llm`` holds forward-backward against
enumeration and the scores against held-out labels."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table, unsigned_crc32
from cabflow.llm.quality_crf import fit, score


def held_out():
    return F.coalesce(unsigned_crc32(F.col("doc_id")) % 5 == 0, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = fit(docs.where(~held_out()), labels.where(~held_out()))
    return (score(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))
