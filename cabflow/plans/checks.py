"""The data-quality tests of silver and the fact, stated once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cabflow.operators.quality import relationships_report, run_checks
from cabflow.params import Params
from cabflow.plans.gold import Gold
from cabflow.schemas import ACCEPTED_PASSENGERS, SERVICE_TYPES

SILVER_NOT_NULL = ["pickup_ts", "dropff_ts", "pickup_location", "dropff_location", "passengers_count",
                   "trip_distance", "total_amount", "service_type", "source_month", "vendor_id", "payment_type"]
SILVER_ACCEPTED = {"passengers_count": ACCEPTED_PASSENGERS, "service_type": SERVICE_TYPES}
SILVER_EXPRESSIONS = {
    "silver_pickup_le_dropoff": "pickup_ts <= dropff_ts",
    "silver_distance_ge_0": "trip_distance >= 0",
    "silver_total_ge_0": "total_amount >= 0",
}
GOLD_NOT_NULL = ["pickup_date_key", "dropoff_date_key", "trip_distance", "total_amount", "passengers_count"]
GOLD_EXPRESSIONS = {
    "gold_distance_ge_0": "trip_distance >= 0",
    "gold_total_ge_0": "total_amount >= 0",
    "gold_passengers_ge_0": "passengers_count >= 0",
}


def relationships(gold: Gold, zones: DataFrame) -> list[tuple]:
    """(name, child, key, parent, parent key) of every relationship test."""
    s, f, d = gold.silver, gold.fact, gold.dims
    return [
        ("silver_pickup_location", s, "pickup_location", zones, "location_id"),
        ("silver_dropff_location", s, "dropff_location", zones, "location_id"),
        ("fct_pickup_date_key", f, "pickup_date_key", d["dim_date"], "date_key"),
        ("fct_dropoff_date_key", f, "dropoff_date_key", d["dim_date"], "date_key"),
        ("fct_pickup_time_key", f, "pickup_time_key", d["dim_time"], "time_key"),
        ("fct_dropoff_time_key", f, "dropoff_time_key", d["dim_time"], "time_key"),
        ("fct_pickup_location_key", f, "pickup_location_key", d["dim_zone"], "zone_key"),
        ("fct_dropoff_location_key", f, "dropoff_location_key", d["dim_zone"], "zone_key"),
        ("fct_payment_type_key", f, "payment_type_key", d["dim_payment_type"], "payment_type_key"),
        ("fct_vendor_key", f, "vendor_key", d["dim_vendor"], "vendor_key"),
        ("fct_ratecode_key", f, "ratecode_key", d["dim_ratecode"], "ratecode_key"),
        ("fct_service_type_key", f, "service_type_key", d["dim_service_type"], "service_type_key"),
    ]


def silver_report(silver: DataFrame) -> DataFrame:
    """Every column test of silver in one aggregate."""
    return run_checks(silver, not_null=SILVER_NOT_NULL, accepted=SILVER_ACCEPTED, expressions=SILVER_EXPRESSIONS)


def gold_report(fact: DataFrame) -> DataFrame:
    """Every column test of the fact in one aggregate."""
    return run_checks(fact, not_null=GOLD_NOT_NULL, expressions=GOLD_EXPRESSIONS)


def relationship_report(gold: Gold, zones: DataFrame, params: Params) -> DataFrame:
    return relationships_report(relationships(gold, zones), params.broadcast_max_rows)
