"""op9_license_scan: license texts and notices in every document.

No SQL: recursive alignment; ``tests/llm`` compares with plain search and with
an alignment by dynamic programming."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table
from cabflow.llm.license_scan import license_spans


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    top = F.array_sort(F.transform("found", lambda f: F.struct((-f["coverage"]).alias("minus"), f["license"].alias("license"),
                                                               f["first_word"].alias("first_word"),
                                                               f["end_word"].alias("end_word"))))[0]
    return (found.withColumn("top", F.when(F.size("found") > 0, top))
            .withColumn("names", F.array_distinct(F.transform("found", lambda f: f["license"])))
            .select("doc_id", F.size("names").alias("n_licenses"), F.concat_ws(",", "names").alias("licenses"),
                    F.col("top.license").alias("best_license"), (-F.col("top.minus")).alias("best_coverage"),
                    F.col("top.first_word").alias("first_word"), F.col("top.end_word").alias("end_word"),
                    F.size("found").alias("n_places")))
