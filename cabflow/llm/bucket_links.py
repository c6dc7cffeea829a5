"""Components from buckets of items that may be similar, without ever forming
all pairs of a large bucket in one place.

1. Buckets with the same members count once; those of one member go.
2. A bucket of c items is dealt into ceil(c / block) blocks by another hash in
   every bucket; each block links its items with each other.  Links are
   verified, and only those that connect something are kept.  On request each
   item's largest bucket goes first; of the others only those are looked at
   whose items are not all connected by then.
3. Buckets of several blocks whose items are not all connected by then: the
   items outside the bucket's largest part (probes) meet all its items, in
   larger blocks.  Every pair of a bucket has then been looked at, or was
   connected already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import written
from cabflow.llm.components import connected_components


def distinct_buckets(entries: DataFrame) -> DataFrame:
    """key, c, rep of the buckets (key, rep) with several members, one bucket
    for each set of members.  An item that enters a bucket twice counts once:
    its hashes would cancel out, and other sets of members look the same."""
    entries = written(entries.select("key", "rep").distinct(), "entered")
    buckets = (entries.groupBy("key")
               .agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("lo"), F.bit_xor(F.xxhash64("rep")).alias("x"),
                    F.bit_xor(F.xxhash64(F.lit(1), F.col("rep"))).alias("y"))
               .where("c > 1").groupBy("c", "lo", "x", "y").agg(F.min("key").alias("key")).select("key", "c"))
    return written(entries.join(written(buckets, "buckets"), "key").select("key", "c", "rep"), "members")


def blocks_of(count: Column, block: int) -> Column:
    return F.ceil(count / F.lit(block)).cast("long")


def within_blocks(members: DataFrame, block: int) -> DataFrame:
    """Groups (g1, g2, g3, rep, part, probe): each bucket's blocks.  Members
    without a part are one each."""
    part = F.col("part") if "part" in members.columns else F.col("rep")
    return members.select(
        F.col("key").alias("g1"), F.pmod(F.xxhash64("rep", "key"), blocks_of(F.col("c"), block)).alias("g2"),
        F.lit(0).cast("long").alias("g3"), "rep", part.alias("part"),
        F.lit(None).cast("boolean").alias("probe"))


def largest_keys(members: DataFrame) -> DataFrame:
    """key of the buckets that are the largest of one of their members."""
    return written(members.groupBy("rep").agg(F.max(F.struct("c", "key")).alias("m"))
                   .select(F.col("m.key").alias("key")).distinct(), "largest")


def unconnected(members: DataFrame, parts: DataFrame) -> DataFrame:
    """key, c, rep, part of the buckets whose members lie in several parts."""
    told = written(members.join(parts, F.col("rep") == F.col("node"), "left")
                   .select("key", "c", "rep", F.coalesce("component", "rep").alias("part")), "told")
    several = told.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("key")
    return written(told.join(written(several, "several"), "key", "left_semi"), "rest")


def across_blocks(members: DataFrame, parts: DataFrame, block: int, across: int) -> DataFrame:
    """Groups for the buckets of several blocks that hold several parts: the
    members outside the largest part (probes) against all members, in blocks
    of about ``across`` on either side."""
    big = written(members.where(F.col("c") > block)
                  .join(parts, F.col("rep") == F.col("node"), "left")
                  .select("key", "rep", F.coalesce("component", "rep").alias("part")), "big")
    sizes = big.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    main = written(sizes.groupBy("key").agg(F.max(F.struct("n", "part")).alias("m"), F.sum("n").alias("all"),
                                            F.count(F.lit(1)).alias("parts"))
                   .where("parts > 1")
                   .select("key", F.col("m.part").alias("main"), blocks_of(F.col("all"), across).alias("nb"),
                           blocks_of(F.col("all") - F.col("m.n"), across).alias("np")), "main")
    rows = big.join(main, "key")
    at = lambda n: F.pmod(F.xxhash64("rep", "key"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    build = rows.select(F.col("key").alias("g1"), at("nb").alias("g2"), upto("np").alias("g3"), "rep", "part",
                        F.lit(False).alias("probe"))
    probe = rows.where(F.col("part") != F.col("main")).select(
        F.col("key").alias("g1"), upto("nb").alias("g2"), at("np").alias("g3"), "rep", "part",
        F.lit(True).alias("probe"))
    return build.unionAll(probe)


def bucket_components(entries: DataFrame, linker: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
                      block: int, across: int, largest_first: bool = False) -> DataFrame:
    """node, component of the items linked through buckets (key, rep).

    ``linker(items)``, for the items (rep) that share a bucket with others,
    returns a function from groups (g1, g2, g3, rep, part, probe) to the
    verified links (a, b) in them: between all items of a group where probe is
    null, else between probes and the others.  Items of one part are known to
    be connected.  ``largest_first`` spares the items of buckets that earlier
    ones connect, for one more round of components.
    """
    members = distinct_buckets(entries)
    links = linker(members.select("rep").distinct())

    def extended(parts: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            return parts
        return written(connected_components(
            parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more)), "parts")

    largest = largest_keys(members) if largest_first else None
    first = members.join(largest, "key", "left_semi") if largest_first else members
    parts = written(connected_components(written(links(within_blocks(first, block)), "links")), "parts")
    if largest_first:
        rest = unconnected(members.join(largest, "key", "left_anti"), parts)
        parts = extended(parts, written(links(within_blocks(rest, block)), "links"))
    return extended(parts, written(links(across_blocks(members, parts, block, across)), "links"))
