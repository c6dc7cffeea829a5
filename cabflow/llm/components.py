"""Connected components of an edge table, distributed throughout.

Alternating star contraction: the *large star* step hangs a node's larger
neighbours below the smallest node around it, the *small star* step does the
same with its smaller neighbours.  After a few alternations every node hangs
directly below the smallest node of its component.  All steps are aggregates
and joins; minima are written first, so that both sides of a join are read
from tables and a hub with many edges can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for nodes of edges (a, b).

    Nodes without an edge to another node do not appear.  Null ends and loops
    are ignored.
    """
    e = written(edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
                .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "cc")
    mark = _mark(e)
    while True:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("w")).unionAll(
            e.select(F.col("v").alias("n"), F.col("u").alias("w")))
        least = written(both.groupBy("n").agg(F.min("w").alias("m")).select("n", F.least("n", "m").alias("m")), "cc")
        large = written(both.where(F.col("w") > F.col("n")).join(least, "n")
                        .select(F.col("w").alias("u"), F.col("m").alias("v"))
                        .where(F.col("u") != F.col("v")).distinct(), "cc")
        lowest = written(large.groupBy("u").agg(F.min("v").alias("m")), "cc")
        e = written(large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .where(F.col("u") != F.col("v"))
                    .unionAll(lowest.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = _mark(e)
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = now
