"""Dimensions, fact keys, rounding and calendar semantics."""

from datetime import date

from pyspark.sql import functions as F

from cabflow.functions.calendar import pg_int
from cabflow.operators.dims import data_dims, dimension_domains
from cabflow.operators.fact import fct_trips, rowcount_invariant, unmatched_keys
from cabflow.operators.silver import silver_trips
from cabflow.params import Params
from cabflow.schemas import STATIC_DIMS
from cabflow.sources.generators import static_dim
from tests.helpers import BRONZE_SCHEMA, ZONE_SCHEMA, ZONES, d, trip

P = Params(min_date=date(2022, 1, 1), year=2024)

ROWS = [
    trip(d(2024, 1, 7, 10, 0), d(2024, 1, 7, 10, 30, 30), vendor=2, pay=2, rate=6),   # Sunday; 30.5 min
    trip(d(2024, 1, 31, 23, 50), d(2024, 2, 1, 0, 29, 30), vendor=3, pay=None, rate=7),  # across month end
    trip(d(2024, 12, 30, 5, 0), d(2024, 12, 30, 5, 10), pu=3, do=3),                  # ISO week 1 of 2025
    trip(d(2024, 3, 2, 17, 59), d(2024, 3, 2, 18, 1), svc="green"),
]


def _gold(spark, params=P):
    b = spark.createDataFrame(ROWS, BRONZE_SCHEMA)
    z = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    s = silver_trips(b, z, params)
    dims = data_dims(s, params, domains=dimension_domains(s))
    for name in STATIC_DIMS:
        dims[name] = static_dim(spark, name)
    return s, dims, fct_trips(s, dims, params)


def test_dim_date_calendar(spark):
    _, dims, _ = _gold(spark)
    dd = {r.full_date: r for r in dims["dim_date"].collect()}
    sun = dd[date(2024, 1, 7)]
    assert (sun.date_key, sun.day_of_week, sun.quarter, sun.week_of_year) == (20240107, 0, 1, 1)
    assert dd[date(2024, 12, 30)].week_of_year == 1          # ISO week, not calendar week
    assert date(2024, 2, 1) in dd                             # dropoff-only day is included (D4)


def test_reference_mode_drops_dropoff_days(spark):
    _, dims, fact = _gold(spark, P.with_(dropoff_dates=False, dropoff_times=False))
    assert date(2024, 2, 1) not in {r.full_date for r in dims["dim_date"].collect()}
    nulls = {r.key_column: r.unmatched for r in unmatched_keys(fact).collect()}
    assert nulls["dropoff_date_key"] == 1 and nulls["pickup_date_key"] == 0


def test_dim_time_periods(spark):
    _, dims, _ = _gold(spark)
    tt = {r.time_key: r.time_period for r in dims["dim_time"].collect()}
    assert tt[1000] == "morning" and tt[1759] == "evening" and tt[1801] == "evening"
    assert tt[2350] == "night" and tt[29] == "night"


def test_fact_keys_and_rounding(spark):
    s, _, fact = _gold(spark)
    rows = {r.pickup_time_key: r for r in fact.collect()}
    r = rows[1000]
    assert (r.pickup_date_key, r.dropoff_date_key, r.dropoff_time_key) == (20240107, 20240107, 1030)
    assert r.trip_duration_minutes == 31                      # 30.5 rounds half away from zero (D2)
    assert (r.vendor_key, r.payment_type_key, r.ratecode_key) == (2, 2, 6)
    x = rows[2350]
    assert (x.vendor_key, x.payment_type_key, x.ratecode_key) == (None, None, None)  # D6
    assert x.trip_duration_minutes == 40                       # 39.5 -> 40
    assert fact.where(F.col("service_type_key") == "green").count() == 1
    counts = {r.layer: r.row_count for r in rowcount_invariant(s, fact).collect()}
    assert counts["silver"] == counts["fact"] == len(ROWS)


def test_pg_int_rounds_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (2.4,)], "x double")
    assert [r[0] for r in df.select(pg_int("x")).collect()] == [2, 4, -2, 2]


def test_duration_ignores_session_time_zone(spark):
    from datetime import datetime

    from cabflow.functions.calendar import duration_minutes
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(datetime(1996, 4, 7, 1, 56), datetime(1996, 4, 7, 4, 50, 30, 250000))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert df.select(duration_minutes("a", "b")).first()[0] == 174.50416666666666
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pickup_range_equivalence(spark):
    from datetime import timedelta

    from cabflow.functions.predicates import pickup_range
    days = [date(2023, 12, 25) + timedelta(days=i) for i in range(80)]
    df = spark.createDataFrame([(x,) for x in days], "pickup_date date").withColumn(
        "pickup_month", F.trunc("pickup_date", "month"))
    cases = [(date(2024, 1, 1), date(2024, 2, 1), False), (date(2024, 1, 1), date(2024, 1, 31), True),
             (date(2024, 1, 10), date(2024, 2, 5), False), (date(2024, 1, 10), date(2024, 2, 5), True),
             (date(2024, 1, 1), None, False), (date(2023, 12, 28), None, False), (None, date(2024, 3, 1), False)]
    for lo, hi, closed in cases:
        got = sorted(r[0] for r in df.where(pickup_range(lo, hi, closed=closed)).collect())
        want = [x for x in days if (lo is None or x >= lo) and
                (hi is None or (x <= hi if closed else x < hi))]
        assert got == want, (lo, hi, closed)


def test_bronze_reads_nan_as_missing(spark):
    from datetime import datetime

    from cabflow.operators.bronze import bronze_trips
    nan = float("nan")
    raw = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 30), nan, 2.5, nan, 1, 2, 2.5,
          nan, 1.0, 0.0, 12.345, "yellow", "2024-01", datetime(2026, 1, 1))],
        "vendorid int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, ratecodeid double, pulocationid int, dolocationid int, "
        "payment_type double, fare_amount double, tip_amount double, tolls_amount double, total_amount double, "
        "service_type string, source_month string, ingest_ts timestamp_ntz")
    r = bronze_trips(raw).first()
    assert (r.passengers_count, r.ratecode_id, r.fare_amount) == (None, None, None)
    assert r.payment_type == 2                       # 2.5 rounds half to even
    assert str(r.total_amount) == "12.35"            # half-cent rounds half up
    assert r.trip_duration_minutes == 30.0
