"""Fill each column's NULLs with its upper median.

The upper median is ``sorted(present)[floor(n / 2)]``, an exact order
statistic.  All columns go through the same few jobs: one GROUPING SETS pass
counts every (column, value); the counts are range-partitioned by column and
value and written in that order; partition totals give each partition's start,
a running count inside the partitions finds the row that holds the middle.
Only the medians, one row per column, reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.session import scratch_path


def _present(df: DataFrame, c: str) -> Column:
    """The column with NaN read as missing, as NULL is."""
    t = df.schema[c].dataType
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(F.col(c)), F.col(c))
    return F.col(c)


def _ordered_counts(df: DataFrame, cols) -> DataFrame:
    """(g, value columns, n, p): rows per column number and value, in order,
    with the number of the partition they lie in.  Only the g-th value column
    of a row is filled, so ordering by all of them orders by value."""
    spark = df.sparkSession
    names = [f"v{i}" for i in range(len(cols))]
    values = df.select(*[_present(df, c).alias(n) for c, n in zip(cols, names)])
    which = F.coalesce(*[F.when(F.grouping(n) == 0, F.lit(i)) for i, n in enumerate(names)])
    counts = values.groupingSets([[n] for n in names], *names).agg(which.alias("g"), F.count(F.lit(1)).alias("n"))
    counts = counts.where(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names]))
    path = scratch_path(spark, "median_counts")
    (counts.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "g", *names)
     .withColumn("p", F.spark_partition_id()).write.parquet(path))
    return spark.read.parquet(path)


def upper_medians(df: DataFrame, cols) -> dict:
    """Exact upper median of every column in ``cols`` (None when no value is
    present).  The number of jobs does not depend on the number of columns."""
    cols = list(cols)
    names = [f"v{i}" for i in range(len(cols))]
    counts = _ordered_counts(df, cols)
    # one row per (column, partition)
    totals = counts.groupBy("g", "p").agg(F.sum("n").alias("m"))
    col_rows = Window.partitionBy("g")
    totals = totals.select(
        "g", "p", (F.sum("m").over(col_rows.orderBy("p")) - F.col("m")).alias("before"),
        F.floor(F.sum("m").over(col_rows) / 2).alias("k"))
    in_order = Window.partitionBy("g", "p").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("n").over(in_order)
    hit = (counts.join(totals, ["g", "p"]).withColumn("upto", upto)
           .where((F.col("upto") > F.col("k")) & (F.col("upto") - F.col("n") <= F.col("k"))))
    out = dict.fromkeys(cols)
    for r in hit.select("g", *names).collect():  # at most one row per column
        out[cols[r["g"]]] = r[names[r["g"]]]
    return out


def select_numeric(df: DataFrame, cols) -> DataFrame:
    """The explicit numeric column list."""
    return df.select(*cols)


def impute_upper_median(df: DataFrame, cols) -> DataFrame:
    """M1: each column's missing values <- its upper median (columns
    independent; NaN counts as missing)."""
    med = upper_medians(df, cols)
    return df.select(*[
        (F.coalesce(_present(df, c), F.lit(med[c]).cast(df.schema[c].dataType)) if med[c] is not None
         else F.col(c)).alias(c)
        for c in cols])
