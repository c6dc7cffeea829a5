"""Bronze: typed, pruned trips and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.functions.calendar import duration_minutes
from cabflow.schemas import MONEY

_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _num(df: DataFrame, c: str):
    """The raw column, with floating NaN read as missing (a NaN in a raw
    dataframe became NULL when the batch was stored)."""
    t = df.schema[c].dataType
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.nanvl(F.col(c), F.lit(None).cast(t))
    return F.col(c)


def _int(df: DataFrame, c: str):
    """``::int``: round half to even for fractional inputs, plain cast otherwise."""
    t = df.schema[c].dataType
    return (F.rint(_num(df, c)) if isinstance(t, _FRACTIONAL) else F.col(c)).cast("int")


def narrow_types(df: DataFrame) -> DataFrame:
    """Double -> float, bigint -> int, as the ingest's memory saver did.

    Available but not used by the pipeline: a float32 hop before the money
    casts can change cents (D13)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            out.append(F.col(f.name).cast("float").alias(f.name))
        elif isinstance(f.dataType, T.LongType):
            out.append(F.col(f.name).cast("int").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def bronze_trips(raw: DataFrame) -> DataFrame:
    """P4 + P6: 25 raw columns -> 17 typed ones plus derived duration (minutes)."""
    pick = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    drop = F.col("tpep_dropoff_datetime").cast("timestamp_ntz")
    return raw.select(
        _int(raw, "vendorid").alias("vendor_id"),
        pick.alias("pickup_ts"),
        drop.alias("dropff_ts"),
        _int(raw, "passenger_count").alias("passengers_count"),
        _num(raw, "trip_distance").cast(MONEY).alias("trip_distance"),
        _int(raw, "pulocationid").alias("pickup_location"),
        _int(raw, "dolocationid").alias("dropff_location"),
        _int(raw, "ratecodeid").alias("ratecode_id"),
        _int(raw, "payment_type").alias("payment_type"),
        _num(raw, "fare_amount").cast(MONEY).alias("fare_amount"),
        _num(raw, "tip_amount").cast(MONEY).alias("tip_amount"),
        _num(raw, "tolls_amount").cast(MONEY).alias("tolls_amount"),
        _num(raw, "total_amount").cast(MONEY).alias("total_amount"),
        F.col("service_type").cast("string"),
        F.col("source_month").cast("string"),
        F.col("ingest_ts").cast("timestamp_ntz"),
        duration_minutes(pick, drop).alias("trip_duration_minutes"),
    )


def bronze_zones(raw_zones: DataFrame) -> DataFrame:
    """P5: cast the id and name the zone column ``zone_name``.

    Accepts the CSV names (LocationID, Borough, Zone) or the lower-case ones
    the reference's table uses (locationid, borough, _zone)."""
    names = {c.lower(): c for c in raw_zones.columns}
    zone = names.get("zone") or names.get("_zone")
    return raw_zones.select(
        F.col(names["locationid"]).cast("int").alias("location_id"),
        F.col(names["borough"]).cast("string").alias("borough"),
        F.col(zone).cast("string").alias("zone_name"),
        F.col(names["service_zone"]).cast("string").alias("service_zone"),
    )
