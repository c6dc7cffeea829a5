"""Steps whose cost must follow the input: one pass for the clustered fact, files by bytes."""

import glob
from datetime import date

from pyspark.sql import functions as F

from cabflow.sinks import writers
from cabflow.sources import fixture
from tests.conftest import SF001


def _confs(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _trips(spark, n, month=None):
    day = F.lit(date(2024, 1, 1)) if month is None else F.lit(month)
    return spark.range(0, n, 1, 8).select(
        F.date_add(day, (F.col("id") % (360 if month is None else 28)).cast("int")).alias("pickup_date"),
        (F.col("id") % 1440).cast("int").alias("pickup_time_key"), (F.col("id") % 260).alias("pickup_location_key"),
        (F.col("id") % 250).alias("dropoff_location_key"), F.col("id").cast("decimal(14,2)").alias("total_amount"),
    ).withColumn("pickup_month", F.trunc("pickup_date", "month"))


def test_clustered_fact_is_computed_once(spark, scratch):
    """No sample for range bounds: every input row is computed a single time."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = _trips(spark, 5000)
    out = writers.write_fact(df.mapInArrow(counted, df.schema), f"{scratch}/fact", cluster=True)
    assert seen.value == 5000
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_clustered_fact_splits_a_hot_month(spark, scratch):
    old = _confs(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k"})
    try:
        hot = _trips(spark, 60_000, date(2024, 3, 1))
        out = writers.write_fact(hot, f"{scratch}/hot", cluster=True)
        assert out.count() == 60_000
        assert len(glob.glob(f"{scratch}/hot/version=*/pickup_month=2024-03-01/*.parquet")) > 1
        out = writers.write_fact(_trips(spark, 6000), f"{scratch}/even", cluster=True)
        assert len(glob.glob(f"{scratch}/even/version=*/*/*.parquet")) == 12     # a small month is one file
    finally:
        _restore(spark, old)


def test_landing_files_follow_bytes_not_tasks(spark, scratch):
    raw = fixture.raw_trips(fixture.load_tables(spark, SF001)).where(F.col("source_month") < "1997-01").repartition(16)
    fixture.write_landing(fixture.by_slice(raw), f"{scratch}/landing")
    slices = raw.select("service_type", "source_month").distinct().count()
    assert len(glob.glob(f"{scratch}/landing/*/*/*.parquet")) == slices
    back = spark.read.parquet(*glob.glob(f"{scratch}/landing/*/*"))
    assert back.count() == raw.count()


def test_customers_meet_orders_before_trips(spark):
    """Where nothing can be broadcast, trips are not dealt by customer."""
    plan = fixture.trips_view(fixture.load_tables(spark, SF001))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    at = next(i for i, x in enumerate(lines) if "Join Inner" in x and "c_custkey" in x)
    below = [x for i, x in enumerate(lines[at + 1:], at + 1) if all(d > depth[at] for d in depth[at + 1:i + 1])]
    assert any("o_orderkey" in x for x in below) and not any("l_orderkey" in x for x in below)
