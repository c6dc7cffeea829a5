"""Readers (S1, S2), sinks (K1, K8-K11) and incremental arrival (ST1)."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cabflow.operators.bronze import bronze_trips, bronze_zones
from cabflow.sinks.writers import (
    PartitionDomainError, check_partition_domain, hash_bucket, replace_slice, write_csv,
    write_fact, write_hash_bucketed, write_list_partitioned,
)
from cabflow.sources import fixture
from cabflow.sources.generators import month_partitions, slice_grid
from cabflow.sources.trips import read_trips, read_zones
from cabflow.streaming.ingest import ingest_available
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tables(spark):
    return fixture.load_tables(spark, SF001)


def test_read_trips_conforms_each_slice(spark, tables, scratch):
    raw = fixture.raw_trips(tables)
    fixture.write_landing(raw, f"{scratch}/landing")
    months = sorted(r[0] for r in raw.select("source_month").distinct().collect())
    got = read_trips(spark, f"{scratch}/landing", ["yellow", "green"], months + ["2099-01"],
                     fixture.FIXTURE_INGEST_TS)
    assert got.count() == raw.count()                      # the missing 2099-01 slice is skipped
    assert dict(got.dtypes)["pulocationid"] == "int"       # drift slice stored it as double
    fee = got.where(F.col("airport_fee").isNotNull()).select("service_type", "source_month").distinct().collect()
    assert [(r.service_type, r.source_month) for r in fee] == [(fixture.DRIFT_SERVICE, fixture.DRIFT_MONTH)]
    # green slices were written with lpep_* names and read back as tpep_*
    assert got.where((F.col("service_type") == "green") & F.col("tpep_pickup_datetime").isNull()).count() == 0
    b1 = bronze_trips(got).agg(F.sum("total_amount")).first()[0]
    b2 = bronze_trips(raw).agg(F.sum("total_amount")).first()[0]
    assert b1 == b2


def test_zone_csv_round_trip(spark, tables, scratch):
    write_csv(fixture.zones_csv_frame(tables).coalesce(1), f"{scratch}/zones")
    z = bronze_zones(read_zones(spark, f"{scratch}/zones"))
    assert z.columns == ["location_id", "borough", "zone_name", "service_zone"]
    assert z.count() == 25 and z.where(F.col("location_id") == 24).count() == 0
    unknown = z.where(F.col("location_id") == 264).first()
    assert (unknown.borough, unknown.zone_name, unknown.service_zone) == (None, None, None)   # N/A in the file


def test_csv_missing_tokens(spark, scratch):
    from cabflow.sources.trips import MISSING_TOKENS, read_csv
    rows = [(str(i), t) for i, t in enumerate([*MISSING_TOKENS, "Nairobi", "none", "0"])]
    write_csv(spark.createDataFrame(rows, "id string, v string").coalesce(1), f"{scratch}/c")
    got = {r.id: r.v for r in read_csv(spark, f"{scratch}/c", "id int, v string").collect()}
    n = len(MISSING_TOKENS)
    assert [got[i] for i in range(n)] == [None] * n and [got[n], got[n + 1], got[n + 2]] == ["Nairobi", "none", "0"]


def _landing_with_drift(spark, base):
    """Twelve months; one slice of two files, the first without a column; one
    of three files that store an id as int, double (NaN among them) and long;
    one empty folder."""
    import os
    from datetime import datetime
    cols = "vendorid int, tpep_pickup_datetime timestamp_ntz, trip_distance double, pulocationid int, tip_amount double"
    ts = datetime(2024, 1, 1)
    for m in range(1, 13):
        path = f"{base}/yellow/source_month=2024-{m:02d}"
        df = spark.createDataFrame([(1, ts, 1.0, 5, 2.0), (2, ts, 1.0, 6, 2.0)], cols)
        if m == 3:
            df.drop("tip_amount").coalesce(1).write.mode("append").parquet(path)
            df.coalesce(1).write.mode("append").parquet(path)
        elif m == 7:
            df.coalesce(1).write.mode("append").parquet(path)
            nan = spark.createDataFrame([(3, ts, 1.0, float("nan"), 2.0), (4, ts, 1.0, 7.0, 2.0)],
                                        cols.replace("pulocationid int", "pulocationid double"))
            nan.coalesce(1).write.mode("append").parquet(path)
            df.withColumn("pulocationid", F.col("pulocationid").cast("long")).coalesce(1).write.mode("append").parquet(path)
        elif m == 9:
            os.makedirs(path)
        else:
            df.coalesce(1).write.parquet(path)


def test_read_does_not_depend_on_the_months_asked_for(spark, scratch):
    from datetime import datetime
    _landing_with_drift(spark, scratch)
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    read = lambda ms: sorted(map(str, (tuple(r) for r in read_trips(
        spark, scratch, ["yellow", "green"], ms, datetime(2026, 1, 1)).collect())))
    whole = read_trips(spark, scratch, ["yellow"], months, datetime(2026, 1, 1))
    per_month = {r.source_month: r for r in whole.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("tip_amount").alias("tip"), F.count("pulocationid").alias("ids")).collect()}
    assert "2024-09" not in per_month and len(per_month) == 11
    assert (per_month["2024-03"].n, per_month["2024-03"].tip) == (4, 4.0)
    assert (per_month["2024-07"].n, per_month["2024-07"].ids) == (6, 5)          # NaN is missing
    assert read(months) == sorted(sum((read([m]) for m in months), []))
    assert read(["2024-09"]) == [] == read(["2031-01"])


def test_stream_takes_files_older_than_those_seen(spark, tables, scratch):
    import glob
    import os
    import time
    raw = fixture.raw_trips(tables).where(F.col("source_month").between("1997-01", "1997-02"))
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    fixture.write_landing(raw.where(F.col("source_month") == "1997-02"), landing)
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)
    fixture.write_landing(raw.where(F.col("source_month") == "1997-01"), landing)
    old = time.time() - 30 * 86400
    for f in glob.glob(f"{landing}/*/source_month=1997-01/*.parquet"):
        os.utime(f, (old, old))
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)
    assert spark.read.parquet(bronze).count() == raw.count()


def test_replace_slice_is_idempotent(spark, tables, scratch):
    b = bronze_trips(fixture.raw_trips(tables))
    path = f"{scratch}/bronze"
    replace_slice(b, path)
    first = spark.read.parquet(path).count()
    replace_slice(b, path)
    replace_slice(b.where(F.col("source_month") == "1997-03"), path)   # one slice again
    replace_slice(b.limit(0), path)                                    # empty batch: no-op
    assert spark.read.parquet(path).count() == first == b.count()


def test_partition_domain_checks(spark, scratch):
    df = spark.createDataFrame([(date(2024, 1, 5),), (date(2026, 2, 1),), (None,)], "pickup_date date")
    r = check_partition_domain(df, "pickup_date", date(2022, 1, 1), date(2026, 1, 1)).first()
    assert (r.null_rows, r.below_range, r.above_range) == (1, 0, 1)
    fact = df.where(F.col("pickup_date").isNotNull()).withColumn("pickup_month", F.trunc("pickup_date", "month"))
    with pytest.raises(PartitionDomainError):
        write_fact(fact, f"{scratch}/fact", lo=date(2022, 1, 1), hi=date(2026, 1, 1))
    ok = write_fact(fact.where(F.year("pickup_date") == 2024), f"{scratch}/fact2",
                    lo=date(2022, 1, 1), hi=date(2026, 1, 1))
    assert ok.count() == 1
    lst = spark.createDataFrame([("card",), ("cash",), ("crypto",)], "payment_category string")
    with pytest.raises(PartitionDomainError):
        write_list_partitioned(lst, f"{scratch}/lst", "payment_category", ["card", "cash", "other"])


def test_hash_buckets_partition_the_dimension(spark, scratch):
    dim = spark.range(0, 300).select(F.col("id").cast("int").alias("zone_key"))
    b = hash_bucket(dim, "zone_key", 4)
    counts = {r.bucket: r["count"] for r in b.groupBy("bucket").count().collect()}
    assert set(counts) <= {0, 1, 2, 3} and sum(counts.values()) == 300
    written = write_hash_bucketed(dim, f"{scratch}/zones_hash", "zone_key", 4)
    assert written.count() == 300 and written.inputFiles().__len__() <= 4


def test_generators(spark):
    g = slice_grid(spark, date(2025, 7, 1), date(2025, 12, 1), ["yellow", "green"])
    assert g.count() == 12 and {r.month for r in g.collect()} == {"07", "08", "09", "10", "11", "12"}
    m = month_partitions(spark, date(2022, 1, 1), date(2026, 1, 1)).collect()
    assert len(m) == 48 and m[0].partition_name == "fct_trips_2022_01"
    assert m[-1].range_end == date(2026, 1, 1)


def test_stream_ingest_two_batches_and_redelivery(spark, tables, scratch):
    raw = fixture.raw_trips(tables).where(F.col("source_month").between("1997-01", "1997-06"))
    first, second = raw.where(F.col("source_month") < "1997-04"), raw.where(F.col("source_month") >= "1997-04")
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    fixture.write_landing(first, landing)
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)
    assert spark.read.parquet(bronze).count() == first.count()
    fixture.write_landing(second, landing)
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)
    fixture.write_landing(second, landing)                      # redelivery under new file names
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)
    ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS)  # nothing new
    assert spark.read.parquet(bronze).count() == raw.count()


def test_read_trips_isolates_case_and_type_drift(spark, scratch):
    from datetime import datetime

    from cabflow.sources.trips import read_trips
    base = f"{scratch}/landing"
    cols = "vendorid int, tpep_pickup_datetime timestamp_ntz, trip_distance double, pulocationid int"
    for i in range(1, 21):
        m = f"2024-{i:02d}" if i <= 12 else f"2025-{i - 12:02d}"
        df = spark.createDataFrame([(1, datetime(2024, 1, 1), float(i), 5)], cols)
        if m == "2024-05":
            df = df.withColumnRenamed("vendorid", "VendorID")            # name differs in case only
        if m == "2025-03":
            df = df.withColumn("pulocationid", df.pulocationid.cast("long"))   # bigint in one month
        df.write.parquet(f"{base}/yellow/source_month={m}")
    months = [f"2024-{i:02d}" for i in range(1, 13)] + [f"2025-{i:02d}" for i in range(1, 10)]
    got = read_trips(spark, base, ["yellow"], months, datetime(2026, 1, 1))
    rows = {r.source_month: r for r in got.collect()}
    assert len(rows) == 20 and "2025-09" not in rows
    assert rows["2024-05"].vendorid == 1 and rows["2025-03"].pulocationid == 5
    assert dict(got.dtypes)["pulocationid"] == "int"


def test_materialize_kinds(spark, scratch):
    from cabflow.sinks.writers import materialize
    df = spark.createDataFrame([("yellow", "2024-01", 1), ("green", "2024-01", 2), ("yellow", "2024-02", 3)],
                               "service_type string, source_month string, v int")
    v = materialize(df, "cabflow_test_view", "view")
    assert v.count() == 3 and spark.table("cabflow_test_view").count() == 3
    t = materialize(df, "tbl", "table", base=scratch)
    assert t.count() == 3
    materialize(df, "tbl", "table", base=scratch)
    assert spark.read.parquet(f"{scratch}/tbl").count() == 3          # overwrite, not append
    keys = ["service_type", "source_month"]
    materialize(df, "inc", "incremental", base=scratch, keys=keys)
    again = materialize(df.where("source_month = '2024-02'"), "inc", "incremental", base=scratch, keys=keys)
    assert again.count() == 3                                          # only the touched slice replaced
    with pytest.raises(ValueError):
        materialize(df, "x", "ephemeral", base=scratch)


def test_stream_slice_spread_over_micro_batches(spark, tables, scratch):
    import glob
    raw = fixture.raw_trips(tables).where(F.col("source_month").between("1997-01", "1997-03"))
    landing, bronze, ckpt = f"{scratch}/landing", f"{scratch}/bronze", f"{scratch}/ckpt"
    fixture.write_landing(raw.repartition(4), landing)
    files = glob.glob(f"{landing}/*/source_month=*/*.parquet")
    assert len(files) > 6                                  # several files per slice
    q = ingest_available(spark, landing, bronze, ckpt, fixture.FIXTURE_INGEST_TS, max_files_per_trigger=1)
    assert q.lastProgress is not None and q.lastProgress["batchId"] >= len(files) - 1   # one file per batch
    got = {(r.service_type, r.source_month): r["count"]
           for r in spark.read.parquet(bronze).groupBy("service_type", "source_month").count().collect()}
    want = {(r.service_type, r.source_month): r["count"]
            for r in raw.groupBy("service_type", "source_month").count().collect()}
    assert got == want


def test_narrow_types_halves_doubles_and_longs(spark):
    from cabflow.operators.bronze import narrow_types
    df = spark.createDataFrame([(1.1, 2**31 - 1, "x", 3)], "d double, n long, s string, i int")
    out = narrow_types(df)
    assert dict(out.dtypes) == {"d": "float", "n": "int", "s": "string", "i": "int"}
    assert out.first().n == 2**31 - 1


def test_layers_have_the_reference_types(spark, tables):
    """Native column types, which the comparison with DuckDB widens."""
    from cabflow.params import FIXTURE_PARAMS as P
    from cabflow.plans.gold import build_gold
    gold = build_gold(spark, bronze_trips(fixture.raw_trips(tables)), fixture.zones_view(tables), P)
    money = "decimal(14,2)"
    want = {"pickup_date": "date", "passengers_count": "int", "trip_distance": money, "fare_amount": money,
            "tip_amount": money, "tolls_amount": money, "total_amount": money, "trip_duration_minutes": "int",
            "service_type_key": "string", "pickup_month": "date"}
    want |= {k: "int" for k in ("pickup_date_key", "dropoff_date_key", "pickup_time_key", "dropoff_time_key",
                                "pickup_location_key", "dropoff_location_key", "payment_type_key", "vendor_key",
                                "ratecode_key")}
    assert dict(gold.fact.dtypes) == want
    assert dict(gold.dims["dim_date"].dtypes)["full_date"] == "date"
    assert dict(gold.silver.dtypes)["pickup_ts"] == "timestamp_ntz"
