"""End-to-end run over slice files: ingest -> bronze -> gold -> reports."""

from datetime import date

from pyspark.sql import functions as F

from cabflow.params import FIXTURE_PARAMS as P
from cabflow.plans import medallion
from cabflow.sinks.writers import write_csv
from cabflow.sources import fixture
from tests.conftest import SF001


def test_medallion_run_over_slice_files(spark, scratch):
    t = fixture.load_tables(spark, SF001)
    raw = fixture.raw_trips(t)
    fixture.write_landing(raw, f"{scratch}/landing")
    write_csv(fixture.zones_csv_frame(t).coalesce(1), f"{scratch}/zones")
    reports = medallion.run(spark, f"{scratch}/landing", f"{scratch}/zones", f"{scratch}/out",
                           date(1995, 1, 1), date(2001, 12, 1), P)
    cov = reports["coverage"]
    agg = cov.agg(F.sum("bronze_rows").alias("b"), F.sum("silver_rows").alias("s"),
                  F.sum("rejected").alias("r"), F.count_if(F.col("status") == "missing").alias("m")).first()
    assert agg.b == raw.count() and agg.s == 3417 and agg.b == agg.s + agg.r   # conservation
    assert agg.m > 0                                                            # empty grid months reported
    fact = spark.read.parquet(f"{scratch}/out/gold/fct_trips")
    assert fact.count() == 3417
    assert reports["q01"].count() == 12
    assert {r.layer: r.row_count for r in reports["fact_rowcount_invariant"].collect()} == {"silver": 3417, "fact": 3417}
    for name in ("pivot_month_borough", "pivot_dow_hour", "pivot_borough_hour", "unpivot_payment", "route_edges"):
        assert reports[name].count() > 0, name
    import os
    gold_dir = f"{scratch}/out/gold"
    for dim in ("dim_date", "dim_time", "dim_zone", "dim_service_type", "dim_payment_type", "dim_vendor", "dim_ratecode"):
        assert spark.read.parquet(f"{gold_dir}/{dim}").count() > 0, dim
    assert {"payment_category=card", "payment_category=cash"} <= set(os.listdir(f"{gold_dir}/dim_payment_type"))
    assert {"service_type=yellow", "service_type=green"} <= set(os.listdir(f"{gold_dir}/dim_service_type"))
    rel = {r.test: r.failures for r in reports["dq_relationships"].collect()}
    assert all(v == 0 for v in rel.values())
    # rerun: slices are replaced, not appended
    medallion.ingest(spark, f"{scratch}/landing", f"{scratch}/out/bronze", date(1995, 1, 1), date(2001, 12, 1), P)
    assert spark.read.parquet(f"{scratch}/out/bronze").count() == raw.count()


def test_domain_is_enforced(spark, scratch):
    """A kept trip beyond the last month asked for stops the build."""
    import pytest

    from cabflow.sinks.writers import PartitionDomainError, replace_slice
    from cabflow.operators.bronze import bronze_trips
    t = fixture.load_tables(spark, SF001)
    raw = fixture.raw_trips(t)
    fixture.write_landing(raw.where(F.col("source_month") <= "1997-12"), f"{scratch}/landing")
    write_csv(fixture.zones_csv_frame(t).coalesce(1), f"{scratch}/zones")
    replace_slice(bronze_trips(raw.where(F.col("source_month") == "1999-03")), f"{scratch}/out/bronze")
    with pytest.raises(PartitionDomainError):
        medallion.run(spark, f"{scratch}/landing", f"{scratch}/zones", f"{scratch}/out",
                      date(1996, 1, 1), date(1997, 12, 1), P)


def test_clustered_fact_write(spark, scratch):
    from cabflow.plans.catalog import Run
    from cabflow.sinks.writers import write_fact
    r = Run(spark, SF001)
    out = write_fact(r.gold.fact, f"{scratch}/fact", lo=date(1996, 1, 1), hi=date(2002, 1, 1), cluster=True)
    assert out.count() == 3417
    months = out.select("pickup_month").distinct().count()
    assert months == r.gold.fact.select("pickup_month").distinct().count()


def test_medallion_cli(spark, scratch):
    t = fixture.load_tables(spark, SF001)
    raw = fixture.raw_trips(t).where(F.col("source_month").between("1997-01", "1997-12"))
    fixture.write_landing(raw, f"{scratch}/landing")
    write_csv(fixture.zones_csv_frame(t).coalesce(1), f"{scratch}/zones")
    medallion.main(["--landing", f"{scratch}/landing", "--zones", f"{scratch}/zones", "--out", f"{scratch}/out",
                   "--start", "1997-01", "--end", "1997-12", "--year", "1997", "--min-date", "1996-01-01"])
    q01 = spark.read.parquet(f"{scratch}/out/reports/q01")
    silver_1997 = spark.read.parquet(f"{scratch}/out/gold/fct_trips").count()
    assert q01.agg(F.sum("total_trips")).first()[0] == silver_1997
    cov = spark.read.parquet(f"{scratch}/out/reports/coverage")
    assert cov.count() == 24 and cov.agg(F.sum("bronze_rows")).first()[0] == raw.count()
