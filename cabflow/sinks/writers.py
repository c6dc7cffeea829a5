"""Idempotent slice replace, table/view/incremental materialization,
partitioned fact, LIST and HASH layouts, partition-domain checks."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.sinks.versioned import VersionedTable

SLICE_KEYS = ("service_type", "source_month")


class PartitionDomainError(ValueError):
    """Rows that no partition can hold (the reference has no DEFAULT partition)."""


def replace_slice(df: DataFrame, path: str, keys=SLICE_KEYS, *, skip_empty: bool = True) -> None:
    """K1 + K4: replace exactly the (service, month) slices present in ``df``.

    Dynamic partition overwrite rewrites only the partition folders the batch
    touches, each atomically, so a rerun leaves the table unchanged instead
    of appending duplicates (D7, D10).  An empty batch is skipped.
    """
    if skip_empty and df.isEmpty():
        return
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*keys).parquet(path))


def replace_table(df: DataFrame, path: str) -> None:
    """K2/K5: full replace."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K3: CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def materialize(df: DataFrame, name: str, kind: str, *, base: str | None = None,
                keys=None) -> DataFrame:
    """K5-K7: 'table' (overwrite), 'view' (temp view), 'incremental'
    (dynamic overwrite of the partitions in ``df``; never a blind append).
    Returns a frame reading the result."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if base is None:
        raise ValueError("table and incremental materializations need a base path")
    path = f"{base.rstrip('/')}/{name}"
    if kind == "table":
        replace_table(df, path)
    elif kind == "incremental":
        if not keys:
            raise ValueError("incremental needs partition keys")
        replace_slice(df, path, keys, skip_empty=True)
    else:
        raise ValueError(f"unknown materialization {kind!r}")
    return spark.read.parquet(path)


def check_partition_domain(df: DataFrame, col: str, lo=None, hi=None, allowed=None) -> DataFrame:
    """One aggregate counting rows no partition can hold: NULL, below
    ``lo``, at or above ``hi`` (RANGE), or not in ``allowed`` (LIST)."""
    c = F.col(col)
    aggs = [F.count_if(c.isNull()).alias("null_rows")]
    if lo is not None:
        aggs.append(F.count_if(c < F.lit(lo)).alias("below_range"))
    if hi is not None:
        aggs.append(F.count_if(c >= F.lit(hi)).alias("above_range"))
    if allowed is not None:
        aggs.append(F.count_if(c.isNotNull() & ~c.isin(list(allowed))).alias("not_listed"))
    return df.agg(*aggs)


def _raise_on_violations(report: DataFrame, what: str) -> None:
    row = report.first().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise PartitionDomainError(f"{what}: rows outside the partition domain {bad}")


def write_fact(fact: DataFrame, path: str, *, lo: date | None = None, hi: date | None = None,
               cluster: bool = False, months=None, meta: dict | None = None) -> DataFrame:
    """K8: the fact partitioned by ``pickup_month`` (RANGE by month), published
    as a new version of the table at ``path`` (see ``VersionedTable``): the
    whole fact or, with ``months`` (first days), these months alone, the files
    of the others untouched.  A write that dies leaves the fact as it was.

    With ``lo``/``hi`` the month domain is checked first (K11).  Input read
    from slice-partitioned silver is already clustered by month (a silver row's
    pickup month equals its source month), so by default there is no shuffle;
    ``cluster=True`` deals unclustered input by month first, in one pass over
    it: unlike a range exchange, whose bounds come from a sample, it does not
    compute the fact a second time.  Rows are sorted by pickup_date inside each
    file so row-group and page statistics prune.
    """
    if lo is not None or hi is not None:
        _raise_on_violations(check_partition_domain(fact, "pickup_date", lo, hi), "fct_trips")
    # A rebalance is split by measured bytes: a hot month goes to several tasks
    # instead of one, small months share one.
    out = fact.hint("rebalance", "pickup_month") if cluster else fact
    table = VersionedTable(fact.sparkSession, path, "pickup_month")
    return table.replace(out.sortWithinPartitions("pickup_month", "pickup_date"), months, meta)


def write_list_partitioned(df: DataFrame, path: str, col: str, allowed) -> DataFrame:
    """K9: LIST partitioning on ``col``; values outside ``allowed`` are an error."""
    _raise_on_violations(check_partition_domain(df, col, allowed=allowed), path)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(col).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def hash_bucket(df: DataFrame, key: str, n: int) -> DataFrame:
    """Bucket number ``pmod(hash(key), n)``, the partition Spark's hash
    partitioner gives the row in ``repartition(n, key)``."""
    return df.withColumn("bucket", F.pmod(F.hash(F.col(key)), F.lit(n)))


def _bucket_table(path: str) -> str:
    return "cabflow_bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def write_hash_bucketed(df: DataFrame, path: str, key: str, n: int) -> DataFrame:
    """A table bucketed by HASH of ``key`` into ``n`` files, sorted within
    each.  The returned frame reads it with its buckets, so a join or an
    aggregate on ``key`` needs no exchange on this side."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_bucket_table(path)}")
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key).format("parquet")
       .option("path", path).saveAsTable(_bucket_table(path)))
    return spark.table(_bucket_table(path))


def read_hash_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, n: int) -> DataFrame:
    """A table written by ``write_hash_bucketed``, also by another session
    whose catalog does not know it: its files are declared over again."""
    name = _bucket_table(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)
