"""Relations by name (S4), buckets (K10), joins sized without a job."""

import pytest
from pyspark.sql import functions as F

from cabflow.operators import joins
from cabflow.operators.fact import broadcastable, dimension_usage, usage_by_bucket
from cabflow.plans.relations import LineageCycle, Relations, UnknownRelation
from cabflow.sinks.writers import _bucket_table, read_hash_bucketed, write_hash_bucketed
from tests.test_manifest import jobs
from tests.test_plans import plan


def test_lineage_order_and_kinds(spark, scratch):
    r = Relations(spark, scratch)
    built = []

    def step(name, fn):
        return lambda *a: (built.append(name), fn(*a))[1]

    r.source("raw", lambda: (built.append("raw"), spark.range(6).withColumn("k", F.col("id") % 2))[1])
    r.model("top", step("top", lambda a, b: a.join(b, "k")), ["sums", "clean"])
    r.model("sums", step("sums", lambda c: c.groupBy("k").agg(F.sum("id").alias("s"))), ["clean"])
    r.model("clean", step("clean", lambda x: x.where("id > 0")), ["raw"], "view")
    r.model("slices", step("slices", lambda c: c), ["clean"], "incremental", ["k"])
    assert r.lineage("top") == ["raw", "clean", "sums", "top"]
    assert r.ref("top").count() == 5 and built == ["raw", "clean", "sums", "top"]
    assert r.ref("slices").count() == 5 and built[-1] == "slices" and built.count("clean") == 1
    assert spark.table("cabflow_clean").count() == 5 and spark.read.parquet(f"{scratch}/sums").count() == 2
    r.rebuild("sums")
    assert built[-1] == "sums" and built.count("clean") == 1
    r.ref("top")
    assert built[-1] == "top" and built.count("top") == 2


def test_wrong_declarations(spark, scratch):
    r = Relations(spark, scratch)
    r.model("a", lambda x: x, ["b"])
    r.model("b", lambda x: x, ["a"])
    r.model("c", lambda x: x, ["nowhere"])
    with pytest.raises(LineageCycle, match="a -> b -> a"):
        r.ref("a")
    with pytest.raises(UnknownRelation):
        r.ref("c")
    with pytest.raises(ValueError):
        r.model("a", lambda: None)
    with pytest.raises(ValueError):
        r.model("d", lambda: None, kind="ephemeral")


def test_bucketed_side_is_not_exchanged(spark, scratch):
    dim = spark.range(300).select(F.col("id").cast("int").alias("zone_key"), F.concat(F.lit("z"), "id").alias("name"))
    fact = spark.range(2000).select((F.col("id") % 250).cast("int").alias("pickup"))
    zones = write_hash_bucketed(dim, f"{scratch}/zones", "zone_key", 4)

    def check(zones):
        joined = usage_by_bucket(fact, zones, "zone_key", "pickup", 4)
        p = plan(joined)
        scan = next(x for x in p.splitlines() if "FileScan" in x)
        assert "SortMergeJoin" in p and "Bucketed: true" in scan
        # the zones go from their scan to the join without an exchange
        lines = p.splitlines()
        depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
        at, above = lines.index(scan), []
        for line in reversed(lines[:at]):
            if depth(line) < depth(lines[at]):
                above.append(line)
                at = lines.index(line)
            if "SortMergeJoin" in line:
                break
        assert "SortMergeJoin" in above[-1] and not any("Exchange" in x for x in above)
        want = dimension_usage(fact, dim, "zone_key", "pickup")
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))

    check(zones)
    spark.sql(f"DROP TABLE {_bucket_table(f'{scratch}/zones')}")     # as a session that did not write it
    check(read_hash_bucketed(spark, f"{scratch}/zones", dim.schema, "zone_key", 4))
    again = write_hash_bucketed(dim.limit(10), f"{scratch}/zones", "zone_key", 4)
    assert again.count() == 10 and spark.read.parquet(f"{scratch}/zones").count() == 10


def test_sizes_are_known_without_a_job(spark, scratch):
    small, large = f"{scratch}/small", f"{scratch}/large"
    spark.range(100).selectExpr("id AS k", "cast(id as string) AS name").write.parquet(small)
    spark.range(2_000_000).selectExpr("id AS k", "cast(id as string) AS name").write.parquet(large)
    s, b = spark.read.parquet(small), spark.read.parquet(large)
    seen = {}
    n = jobs(spark, lambda: seen.update(
        small=joins.row_count_at_most(s, 100_000), large=joins.row_count_at_most(b, 100_000),
        zero=joins.row_count_at_most(s, 0), rdd=joins.row_count_at_most(spark.createDataFrame([(1,)], "a int"), 10 ** 6),
        product=joins.row_count_at_most(b.join(b.withColumnRenamed("name", "n"), "k"), 10 ** 6),
        dims=broadcastable({"dim_time": b, "dim_zone": s, "dim_x": b}, 100_000)))
    assert n == 0
    assert seen["small"] and not seen["large"] and not seen["zero"] and not seen["product"]
    assert seen["dims"] == {"dim_time": True, "dim_zone": True, "dim_x": False}
    assert "BroadcastHashJoin" in plan(b.hint("merge").join(joins.bounded_broadcast(s, 100_000), "k")) or \
        "broadcast" in s.join(joins.bounded_broadcast(s, 100_000), "k")._jdf.queryExecution().logical().toString()
    assert joins.bounded_broadcast(b, 100_000) is b and joins.row_width(s.schema) == 36
