"""Global shuffle into shards: the two-pass external shuffle.

Pass 1 scatters the records uniformly over memory-sized buckets by a seeded
hash; a row that is repeated so often that its copies would swell a bucket is
counted instead, and its copies scattered one by one.  Pass 2 shuffles each
bucket in memory (Fisher-Yates, seeded by the bucket) and writes it.  The buckets on end are one random order of all
records; record r of it goes to shard r mod n at slot r div n, so shard sizes
differ by one row at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.common import ship, unsigned_crc32, written
from cabflow.session import scratch_path

#: Expected bytes of text in one bucket, and the least number of buckets.
BUCKET_BYTES, MIN_BUCKETS = 64 << 20, 64
#: A row whose copies fill more than 1 / HOT_PART of a bucket is scattered by
#: copy; a table has at most HOT_PART times as many such rows as buckets.
HOT_PART = 8
#: Copies of such a row made at a time.
COPY_RUN = 1024


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform permutation of n that depends on seed and bucket alone."""
    return np.random.default_rng([seed, bucket]).permutation(n)


def _scattered(docs: DataFrame, seed: int, buckets: int, hot_bytes: int) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(unsigned_crc32(F.col("text")), F.lit(0)).cast("long").alias("text_crc32"))
    bucket = lambda *more: F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", *more), F.lit(buckets)).cast("int")
    hot = written(rows.groupBy("doc_id", "text_crc32").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
                  .where((F.col("n") > 1) & (F.col("bytes") > hot_bytes)).select("doc_id", "text_crc32"), "hot_rows")
    if hot.isEmpty():
        return rows.withColumn("bucket", bucket())
    hot = hot.select(F.col("doc_id").alias("hot_id"), F.col("text_crc32").alias("hot_crc"))
    same = F.col("doc_id").eqNullSafe(F.col("hot_id")) & (F.col("text_crc32") == F.col("hot_crc"))
    copies = (rows.join(hot, same, "left_semi").groupBy("doc_id", "text", "size", "text_crc32")
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPY_RUN}"))))
              .repartition("doc_id", "text_crc32", "run")  # the copies of one row are made by many tasks
              .withColumn("copy", F.explode(F.sequence(F.col("run") * COPY_RUN + 1,
                                                       F.least("n", (F.col("run") + 1) * COPY_RUN)))))
    return rows.join(hot, same, "left_anti").withColumn("bucket", bucket()).unionAll(
        copies.withColumn("bucket", bucket("copy")).drop("n", "run", "copy"))


def _shuffle_bucket(shards: int, seed: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=[("doc_id", "ascending"), ("text_crc32", "ascending")]))
        t = t.take(pa.array(fisher_yates(t.num_rows, seed, t.column("bucket")[0].as_py())))
        rank = t.column("first")[0].as_py() + np.arange(t.num_rows, dtype=np.int64)
        return (t.select(["doc_id", "text", "size", "text_crc32"])
                .append_column("slot", pa.array(rank // shards))
                .append_column("shard", pa.array((rank % shards).astype(np.int32))))

    return run


def shuffle_to_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 6,
                      bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write docs (doc_id, text) in random order to ``path/shard=k`` and return
    the written table: doc_id, text, size, text_crc32, slot, shard.

    The order depends on the rows and the seed, not on their partitioning.
    Defined cases: a null or empty text has size 1 (crc 0); repeated rows all
    appear, each at its own slot; a row repeated beyond an eighth of a bucket
    has its copies dealt over all buckets, so that none swells; a text longer
    than a bucket is a bucket of its own size; null doc_ids are records like
    others; other columns are not kept; an empty table gives empty shards.
    """
    spark = docs.sparkSession
    total = docs.select(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-total // bucket_bytes))
    rows = _scattered(docs, seed, buckets, bucket_bytes // HOT_PART)
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("first"))
    ship(spark)
    out = (rows.join(F.broadcast(first), "bucket")  # one row a bucket: bytes / bucket_bytes
           .groupBy("bucket").applyInArrow(
               _shuffle_bucket(shards, seed),
               "doc_id long, text string, size long, text_crc32 long, slot long, shard int"))
    (out.sortWithinPartitions("shard", "slot").write.mode("overwrite").option("compression", "zstd")
     .partitionBy("shard").parquet(path))
    return spark.read.schema(out.schema).parquet(path)


def to_scratch(docs: DataFrame, **how) -> DataFrame:
    return shuffle_to_shards(docs, scratch_path(docs.sparkSession, "shards"), **how)
