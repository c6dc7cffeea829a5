"""Hand-made trip rows for unit tests."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType([
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("pickup_ts", T.TimestampNTZType()),
    T.StructField("dropff_ts", T.TimestampNTZType()),
    T.StructField("passengers_count", T.IntegerType()),
    T.StructField("trip_distance", T.DecimalType(14, 2)),
    T.StructField("pickup_location", T.IntegerType()),
    T.StructField("dropff_location", T.IntegerType()),
    T.StructField("ratecode_id", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DecimalType(14, 2)),
    T.StructField("tip_amount", T.DecimalType(14, 2)),
    T.StructField("tolls_amount", T.DecimalType(14, 2)),
    T.StructField("total_amount", T.DecimalType(14, 2)),
    T.StructField("service_type", T.StringType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("trip_duration_minutes", T.DoubleType()),
])
ZONE_SCHEMA = "location_id int, borough string, zone_name string, service_zone string"
ZONES = [(1, "B1", "Z1", None), (2, "B1", "Z2", None), (3, "B2", "Z3", None)]
ING = datetime(2026, 1, 1)


def trip(pick, drop, *, vendor=1, pax=1, dist="1.00", pu=1, do=2, rate=1, pay=1,
         fare="10.00", tip="1.00", tolls="0.00", total="11.00", svc="yellow", month=None,
         dur=None):
    month = month if month is not None else (pick.strftime("%Y-%m") if pick else None)
    if dur is None and pick and drop:
        dur = (drop - pick).total_seconds() / 60.0
    dec = lambda v: None if v is None else Decimal(v)
    return (vendor, pick, drop, pax, dec(dist), pu, do, rate, pay, dec(fare), dec(tip), dec(tolls),
            dec(total), svc, month, ING, dur)


def d(*a):
    return datetime(*a)
