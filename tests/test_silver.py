"""Silver rules, clamps, defaults and zone joins on hand-made rows, plus the
fixture counts of FIXTURES.md."""

from datetime import date

from pyspark.sql import functions as F

from cabflow.operators.bronze import bronze_trips
from cabflow.operators.silver import reject_first_reason, reject_reasons, silver_trips, slice_profile
from cabflow.params import FIXTURE_PARAMS, Params
from cabflow.sources import fixture
from tests.conftest import SF001
from tests.helpers import BRONZE_SCHEMA, ZONE_SCHEMA, ZONES, d, trip

P = Params(min_date=date(2022, 1, 1), year=2024)

EDGE = {
    "kept": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 10, 30)),
    "null_pickup_ts": trip(None, d(2024, 1, 5, 10), month="2024-01"),
    "null_dropff_ts": trip(d(2024, 1, 5, 10), None),
    "null_trip_distance": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), dist=None),
    "null_pickup_location": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), pu=None),
    "null_dropff_location": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), do=None),
    "null_total_amount": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), total=None),
    "null_service_type": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), svc=None),
    "pickup_after_dropoff": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 9)),
    "negative_distance": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), dist="-1.00"),
    "negative_total": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), total="-5.00"),
    "pickup_before_min_date": trip(d(2021, 12, 31, 23, 50), d(2022, 1, 1, 0, 10)),
    "wrong_source_month": trip(d(2024, 2, 1, 0, 5), d(2024, 2, 1, 0, 30), month="2024-01"),
    "unknown_pickup_zone": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), pu=99),
    "unknown_dropoff_zone": trip(d(2024, 1, 5, 10), d(2024, 1, 5, 11), do=98),
}
KEPT_EXTRA = [
    # passengers: NULL -> 0, negative -> 0, above 10 -> 10; vendor/payment NULL -> 0
    trip(d(2024, 1, 6, 10), d(2024, 1, 6, 10, 20), pax=None, vendor=None, pay=None),
    trip(d(2024, 1, 6, 11), d(2024, 1, 6, 11, 20), pax=-2),
    trip(d(2024, 1, 6, 12), d(2024, 1, 6, 12, 20), pax=14),
    # zero-length trip and a trip across the month end are kept
    trip(d(2024, 1, 7, 8), d(2024, 1, 7, 8)),
    trip(d(2024, 1, 31, 23, 50), d(2024, 2, 1, 0, 20)),
]


def _frames(spark):
    b = spark.createDataFrame(list(EDGE.values()) + KEPT_EXTRA, BRONZE_SCHEMA)
    z = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    return b, z


def test_each_rule_rejects_its_row(spark):
    b, z = _frames(spark)
    s = silver_trips(b, z, P)
    assert s.count() == 1 + len(KEPT_EXTRA)
    first = {r.first_reason: r.trips for r in reject_first_reason(slice_profile(b, z, P)).collect()}
    for reason in EDGE:
        if reason != "kept":
            assert first.get(reason) == 1, reason
    assert first["kept"] == 1 + len(KEPT_EXTRA)
    assert sum(first.values()) == b.count()


def test_reject_reasons_overlap(spark):
    b, z = _frames(spark)
    rr = {r.rule: r.rejected for r in reject_reasons(slice_profile(b, z, P)).collect()}
    # rules overlap: the NULL pickup / dropoff rows also fail the comparison
    # (a NULL comparison does not pass), so they are counted there too
    assert rr["pickup_after_dropoff"] == 3
    assert rr["null_pickup_ts"] == 1
    assert rr["pickup_before_min_date"] == 2
    assert rr["dropoff_before_min_date"] == 1


def test_clamps_and_defaults(spark):
    b, z = _frames(spark)
    s = silver_trips(b, z, P)
    pax = sorted(r.passengers_count for r in s.collect())
    assert pax == [0, 0, 1, 1, 1, 10]
    row = s.where(F.col("pickup_ts") == d(2024, 1, 6, 10)).first()
    assert (row.vendor_id, row.payment_type) == (0, 0)
    assert row.pickup_location_name == "Z1" and row.dropoff_location_name == "Z2"
    assert row.pickup_borough == "B1"


def test_fixture_counts_match_spec(spark):
    t = fixture.load_tables(spark, SF001)
    b = bronze_trips(fixture.raw_trips(t))
    z = fixture.zones_view(t)
    s = silver_trips(b, z, FIXTURE_PARAMS)
    agg = s.agg(F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("service_type") == "yellow").alias("yellow"),
                F.countDistinct("source_month").alias("months"),
                F.sum("total_amount").alias("total"),
                F.count_if(F.year("pickup_ts") == 1997).alias("y1997")).first()
    assert (agg.n, agg.yellow, agg.months) == (3417, 1720, 68)
    assert str(agg.total) == "179649976.78"
    assert agg.y1997 == 594
    rr = {r.rule: r.rejected for r in reject_reasons(slice_profile(b, z, FIXTURE_PARAMS)).collect()}
    assert rr["pickup_after_dropoff"] == 158
    assert rr["negative_total"] == 276
    assert rr["pickup_before_min_date"] == 962
    assert rr["wrong_source_month"] == 907


def test_layer_schemas_follow_the_contract(spark):
    from cabflow.operators.coverage import slice_counts
    from cabflow.schemas import BRONZE_COLUMNS, SILVER_COLUMNS
    t = fixture.load_tables(spark, SF001)
    b = bronze_trips(fixture.raw_trips(t))
    s = silver_trips(b, fixture.zones_view(t), FIXTURE_PARAMS)
    assert b.columns == BRONZE_COLUMNS and s.columns == SILVER_COLUMNS
    counts = {(r.service_type, r.source_month): r.trips for r in slice_counts(b, "trips").collect()}
    assert sum(counts.values()) == 6000 and len(counts) == b.select("service_type", "source_month").distinct().count()
