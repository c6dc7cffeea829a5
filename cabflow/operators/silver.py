"""Silver: row rejection, defaults and clamps, two zone joins (F1-F5, J1,
P7, P9, P10), and the reject profile (R8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.calendar import month_of_text
from cabflow.operators.joins import bounded_broadcast
from cabflow.params import Params

MANDATORY = [
    "pickup_ts", "dropff_ts", "trip_distance", "pickup_location", "dropff_location",
    "total_amount", "service_type", "source_month", "ingest_ts", "trip_duration_minutes",
]


def silver_rules(params: Params) -> dict[str, Column]:
    """Row rules keyed by the name of the failure they catch; each Column is
    true when the row passes.  Order is the order of the first-reason report."""
    lo = F.lit(params.min_date).cast("timestamp_ntz")
    rules: dict[str, Column] = {f"null_{c}": F.col(c).isNotNull() for c in MANDATORY}
    rules["pickup_after_dropoff"] = F.col("pickup_ts") <= F.col("dropff_ts")
    rules["negative_distance"] = F.col("trip_distance") >= 0
    rules["negative_total"] = F.col("total_amount") >= 0
    rules["pickup_before_min_date"] = F.col("pickup_ts") >= lo
    rules["dropoff_before_min_date"] = F.col("dropff_ts") >= lo
    rules["wrong_source_month"] = (
        F.trunc(F.col("pickup_ts").cast("date"), "month") == month_of_text("source_month"))
    return rules


def _all(cols) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return out


def clean_trips(bronze: DataFrame, params: Params) -> DataFrame:
    """F1-F5 plus P9/P10 (the ``clean_trips`` step before the zone joins)."""
    pc = F.col("passengers_count")
    return bronze.where(_all(silver_rules(params).values())).select(
        F.coalesce(F.col("vendor_id"), F.lit(0)).alias("vendor_id"),
        "pickup_ts", "dropff_ts",
        F.when(pc.isNull(), 0).when(pc < 0, 0).when(pc > 10, 10).otherwise(pc).alias("passengers_count"),
        "trip_distance", "pickup_location", "dropff_location", "ratecode_id",
        F.coalesce(F.col("payment_type"), F.lit(0)).alias("payment_type"),
        "fare_amount", "tip_amount", "tolls_amount", "total_amount",
        "service_type", "source_month", "ingest_ts", "trip_duration_minutes",
    )


def _zone_side(zones: DataFrame, key: str, name: str, borough: str) -> DataFrame:
    return zones.select(F.col("location_id").alias(key), F.col("zone_name").alias(name),
                        F.col("borough").alias(borough))


def silver_trips(bronze: DataFrame, zones: DataFrame, params: Params) -> DataFrame:
    """Clean trips inner-joined to the zone lookup twice (pickup, dropoff).

    The lookup is broadcast behind a row-count check, so the trip side is
    never shuffled; a trip whose zone is unknown drops out."""
    z = bounded_broadcast(zones.select("location_id", "zone_name", "borough"),
                          params.broadcast_max_rows)
    ct = clean_trips(bronze, params)
    out = (ct.join(_zone_side(z, "pickup_location", "pickup_location_name", "pickup_borough"),
                   "pickup_location", "inner")
             .join(_zone_side(z, "dropff_location", "dropoff_location_name", "dropoff_borough"),
                   "dropff_location", "inner"))
    return out.select(*ct.columns, "pickup_location_name", "dropoff_location_name",
                      "pickup_borough", "dropoff_borough")


def _with_zone_flags(bronze: DataFrame, zones: DataFrame, params: Params) -> DataFrame:
    """Bronze plus the number of lookup rows of its pickup / dropoff zone
    (NULL: unknown zone)."""
    keys = bounded_broadcast(zones.groupBy("location_id").agg(F.count(F.lit(1)).alias("_n")),
                             params.broadcast_max_rows)
    pk = keys.select(F.col("location_id").alias("pickup_location"), F.col("_n").alias("_pk"))
    dk = keys.select(F.col("location_id").alias("dropff_location"), F.col("_n").alias("_dk"))
    return bronze.join(pk, "pickup_location", "left").join(dk, "dropff_location", "left")


def _reject_rules(params: Params) -> dict[str, Column]:
    rules = {k: F.coalesce(v, F.lit(False)) for k, v in silver_rules(params).items()}
    rules["unknown_pickup_zone"] = F.col("_pk").isNotNull()
    rules["unknown_dropoff_zone"] = F.col("_dk").isNotNull()
    return rules


KEPT = "kept"


def slice_profile(bronze: DataFrame, zones: DataFrame, params: Params) -> DataFrame:
    """One pass over bronze for R7 and both R8 reports: per slice and first
    failed rule (``kept`` when none), the bronze rows, the silver rows they
    become, and the rows failing each rule.  Partial aggregation leaves one
    row per task, slice and reason."""
    rules = _reject_rules(params)
    first = F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()], F.lit(KEPT))
    flagged = _with_zone_flags(bronze, zones, params).withColumn("first_reason", first)
    kept = F.when(F.col("first_reason") == KEPT, F.col("_pk") * F.col("_dk")).otherwise(F.lit(0))
    return flagged.groupBy("service_type", "source_month", "first_reason").agg(
        F.count(F.lit(1)).alias("trips"), F.sum(kept).alias("silver_rows"),
        *[F.count_if(~ok).alias(name) for name, ok in rules.items()])


def reject_reasons(profile: DataFrame) -> DataFrame:
    """Rows failing each silver rule (rules overlap), long form
    (rule, rejected), from the slice profile."""
    rules = [c for c in profile.columns
             if c not in ("service_type", "source_month", "first_reason", "trips", "silver_rows")]
    wide = profile.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in rules])
    return wide.unpivot([], rules, "rule", "rejected")


def reject_first_reason(profile: DataFrame) -> DataFrame:
    """Rows by the first rule they fail (``kept`` when none); the counts
    add up to the bronze row count."""
    return profile.groupBy("first_reason").agg(F.sum("trips").alias("trips"))
