"""Schemas and fixed dimension rows.

Fixed values: the rows of the three inline dimensions must equal the
reference's VALUES lists, so they are stated here as plain data.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)

# ---------------------------------------------------------------------------
# Fixed values (must match the reference): inline dimension rows.
# ---------------------------------------------------------------------------
PAYMENT_TYPES = [
    (1, "Credit card", "card"),
    (2, "Cash", "cash"),
    (3, "No charge", "other"),
    (4, "Dispute", "other"),
    (5, "Unknown", "other"),
    (6, "Voided trip", "other"),
]
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
]
RATECODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
# Allowed LIST-partition values (fixed values).
PAYMENT_CATEGORIES = ("card", "cash", "other")
SERVICE_TYPES = ("yellow", "green")
# Accepted passenger counts in silver (fixed values).
ACCEPTED_PASSENGERS = tuple(range(0, 11))
# ---------------------------------------------------------------------------

PAYMENT_TYPE_SCHEMA = T.StructType([
    T.StructField("payment_type_key", T.IntegerType(), False),
    T.StructField("payment_type", T.StringType(), True),
    T.StructField("payment_category", T.StringType(), True),
])
VENDOR_SCHEMA = T.StructType([
    T.StructField("vendor_key", T.IntegerType(), False),
    T.StructField("vendor_name", T.StringType(), True),
])
RATECODE_SCHEMA = T.StructType([
    T.StructField("ratecode_key", T.IntegerType(), False),
    T.StructField("ratecode_name", T.StringType(), True),
])

STATIC_DIMS = {
    "dim_payment_type": (PAYMENT_TYPES, PAYMENT_TYPE_SCHEMA),
    "dim_vendor": (VENDORS, VENDOR_SCHEMA),
    "dim_ratecode": (RATECODES, RATECODE_SCHEMA),
}

# Raw trip columns every slice is cast to before the union (S1).  Columns a
# slice lacks become NULL; columns beyond these are carried as they are.
RAW_TRIP_SCHEMA = T.StructType([
    T.StructField("vendorid", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("ratecodeid", T.DoubleType()),
    T.StructField("pulocationid", T.IntegerType()),
    T.StructField("dolocationid", T.IntegerType()),
    T.StructField("payment_type", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])
LINEAGE_FIELDS = [
    T.StructField("service_type", T.StringType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
]
# Green files name the two timestamps lpep_*.
GREEN_RENAMES = {
    "lpep_pickup_datetime": "tpep_pickup_datetime",
    "lpep_dropoff_datetime": "tpep_dropoff_datetime",
}

ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

BRONZE_COLUMNS = [
    "vendor_id", "pickup_ts", "dropff_ts", "passengers_count", "trip_distance",
    "pickup_location", "dropff_location", "ratecode_id", "payment_type",
    "fare_amount", "tip_amount", "tolls_amount", "total_amount",
    "service_type", "source_month", "ingest_ts", "trip_duration_minutes",
]
SILVER_COLUMNS = BRONZE_COLUMNS + [
    "pickup_location_name", "dropoff_location_name",
    # Carried so that dim_zone can hold the borough the questions read.
    "pickup_borough", "dropoff_borough",
]
FACT_COLUMNS = [
    "pickup_date", "pickup_date_key", "dropoff_date_key",
    "pickup_time_key", "dropoff_time_key",
    "pickup_location_key", "dropoff_location_key",
    "payment_type_key", "vendor_key", "ratecode_key", "service_type_key",
    "passengers_count", "trip_distance", "fare_amount", "tip_amount",
    "tolls_amount", "total_amount", "trip_duration_minutes",
]
