"""Broadcast only behind a size that is known without running a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows in memory may be so many times larger than the bytes of their files.
FILE_EXPANSION = 8
_FIXED = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8, "date": 4,
          "timestamp": 8, "timestamp_ntz": 8}


def row_width(schema: T.StructType) -> int:
    """Bytes of a row in a hash table, at the least: 8 of its own, fixed widths,
    8 for a decimal and 20 for anything else."""
    return 8 + sum(_FIXED.get(f.dataType.typeName(), 8 if isinstance(f.dataType, T.DecimalType) else 20) for f in schema.fields)


def planned_bytes(df: DataFrame) -> int:
    """Upper estimate of the frame's bytes from its plan alone: file sizes
    scaled by the widths of the columns read, exact sizes of local rows, the
    product of both sides of a join.  Unknown sources count as boundless.
    No job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows by its planned bytes, files
    taken as ``FILE_EXPANSION`` times their size."""
    return planned_bytes(df) * FILE_EXPANSION <= max_rows * row_width(df.schema)


def bounded_broadcast(df: DataFrame, max_rows: int, *, bound: int | None = None) -> DataFrame:
    """``broadcast(df)`` when it is known to have at most ``max_rows`` rows:
    by ``bound``, a structural upper bound the caller has (for example 24 * 60
    rows for a minute-of-day dimension), or else by its planned bytes.

    Beyond that ``df`` is returned as is, and Spark plans a shuffle join; AQE
    still turns it into a broadcast join where the measured size of a side
    turns out small at run time."""
    if bound is not None and bound <= max_rows:
        return F.broadcast(df)
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def written_small(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` as a written table, whose size its files then tell."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
