"""Inline dimensions, the slice grid and month partition bounds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.calendar import month_of_text
from cabflow.schemas import STATIC_DIMS


def static_dim(spark: SparkSession, name: str) -> DataFrame:
    """One of dim_payment_type / dim_vendor / dim_ratecode."""
    rows, schema = STATIC_DIMS[name]
    return spark.createDataFrame(rows, schema)


def _grid(months_df: DataFrame, services) -> DataFrame:
    svc = F.array(*[F.lit(s) for s in services])
    return (months_df
            .select(F.explode("m").alias("m"))
            .select(F.explode(svc).alias("service_type"), "m")
            .select("service_type",
                    F.year("m").alias("year"),
                    F.lpad(F.month("m").cast("string"), 2, "0").alias("month"),
                    F.date_format("m", "yyyy-MM").alias("source_month")))


def slice_grid(spark: SparkSession, start: date, end: date, services) -> DataFrame:
    """Every (service, month) slice from ``start`` to ``end`` inclusive."""
    months = spark.range(1).select(
        F.sequence(F.lit(start.replace(day=1)), F.lit(end.replace(day=1)),
                   F.expr("INTERVAL 1 MONTH")).alias("m"))
    return _grid(months, services)


def slice_grid_from(df: DataFrame, services, month_col: str = "source_month") -> DataFrame:
    """S6 with bounds taken from the data: every month between the first and
    last ``source_month`` present, for every service.  One aggregate, no
    collect."""
    m = month_of_text(month_col)
    bounds = df.agg(F.min(m).alias("lo"), F.max(m).alias("hi"))
    months = bounds.select(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH")).alias("m"))
    return _grid(months, services)


def _partitions(months_df: DataFrame, prefix: str) -> DataFrame:
    return (months_df.select(F.explode("m").alias("range_start"))
            .select(F.concat(F.lit(prefix), F.date_format("range_start", "yyyy_MM")).alias("partition_name"),
                    "range_start",
                    F.add_months("range_start", 1).alias("range_end")))


def month_partitions(spark: SparkSession, start: date, end: date,
                     prefix: str = "fct_trips_") -> DataFrame:
    """[month, month + 1) bounds and names for start <= month < end."""
    months = spark.range(1).select(
        F.sequence(F.lit(start.replace(day=1)),
                   F.add_months(F.lit(end.replace(day=1)), -1),
                   F.expr("INTERVAL 1 MONTH")).alias("m"))
    return _partitions(months, prefix)


def month_partitions_from(df: DataFrame, date_col: str = "pickup_date",
                          prefix: str = "fct_trips_") -> DataFrame:
    """S7 with bounds from the data: one row per month from the first to the
    last value of ``date_col``."""
    bounds = df.agg(F.trunc(F.min(date_col), "month").alias("lo"),
                    F.trunc(F.max(date_col), "month").alias("hi"))
    months = bounds.select(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH")).alias("m"))
    return _partitions(months, prefix)
