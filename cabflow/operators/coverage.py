"""Row counts per (service, month) slice before and after cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["service_type", "source_month"]


def slice_counts(df: DataFrame, name: str) -> DataFrame:
    """COUNT(*) per slice (partial aggregation; output is one row per slice)."""
    return df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias(name))


def _report(counts: DataFrame) -> DataFrame:
    br, sr = F.col("bronze_rows"), F.col("silver_rows")
    return counts.select(
        *KEYS, br.alias("bronze_rows"), sr.alias("silver_rows"), (br - sr).alias("rejected"),
        F.when(br > 0, (br - sr).cast("double") * 100.0 / br.cast("double")).alias("reject_pct"),
        F.when(br == 0, "missing").otherwise("ok").alias("status"),
    )


def coverage(profile: DataFrame, grid: DataFrame) -> DataFrame:
    """Expected slices (``grid``) with bronze and silver counts, rejected rows,
    reject percentage and a status: ``missing`` when the slice has no bronze
    rows, else ``ok``.  Taken from the slice profile, so bronze is scanned
    once for this and the reject reports; grid and profile rows are stacked
    and summed, without a join."""
    zero = F.lit(0).cast("long")
    stacked = grid.select(*KEYS, zero.alias("_b"), zero.alias("_s")).unionByName(
        profile.select(*KEYS, F.col("trips").alias("_b"), F.col("silver_rows").alias("_s")))
    return _report(stacked.groupBy(*KEYS).agg(F.sum("_b").cast("long").alias("bronze_rows"),
                                              F.sum("_s").cast("long").alias("silver_rows")))


def coverage_of(bronze: DataFrame, silver: DataFrame, grid: DataFrame) -> DataFrame:
    """The same from two tables that exist already."""
    mark = lambda df, b, s: df.select(*KEYS, F.lit(b).alias("_b"), F.lit(s).alias("_s"))
    stacked = mark(grid, 0, 0).unionByName(mark(bronze, 1, 0)).unionByName(mark(silver, 0, 1))
    return _report(stacked.groupBy(*KEYS).agg(F.sum("_b").cast("long").alias("bronze_rows"),
                                              F.sum("_s").cast("long").alias("silver_rows")))
