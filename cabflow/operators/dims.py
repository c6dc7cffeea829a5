"""Gold dimensions.

The four data-driven dimensions come from ONE pass over silver: a GROUPING
SETS aggregate whose sets are the pickup day, dropoff day, pickup minute,
dropoff minute, pickup zone, dropoff zone and service type, each by month.
Spark expands each row into the seven sets and aggregates partially on the map
side, so the shuffle carries at most (days + minutes + zones + services) rows
per task and month, whatever the size of silver or the skew of any key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.calendar import date_key, day_of_week_sun0, time_period
from cabflow.params import Params

_SETS = {
    "p_day": ["p_day"],
    "d_day": ["d_day"],
    "p_time": ["p_hour", "p_minute"],
    "d_time": ["d_hour", "d_minute"],
    "p_zone": ["p_zone_key", "p_zone_name", "p_borough"],
    "d_zone": ["d_zone_key", "d_zone_name", "d_borough"],
    "service": ["service_type"],
}


def dimension_domains(silver: DataFrame) -> DataFrame:
    """Distinct values of every dimension attribute of each month, tagged by
    set, in one scan of the needed silver columns.  Output is small (bounded,
    for each month, by its days + 2 x 1440 minutes + zones + services); rows of
    several months say the same again, so a month's rows can be replaced."""
    src = silver.select(
        "source_month",
        F.col("pickup_ts").cast("date").alias("p_day"),
        F.col("dropff_ts").cast("date").alias("d_day"),
        F.hour("pickup_ts").alias("p_hour"), F.minute("pickup_ts").alias("p_minute"),
        F.hour("dropff_ts").alias("d_hour"), F.minute("dropff_ts").alias("d_minute"),
        F.col("pickup_location").alias("p_zone_key"),
        F.col("pickup_location_name").alias("p_zone_name"),
        F.col("pickup_borough").alias("p_borough"),
        F.col("dropff_location").alias("d_zone_key"),
        F.col("dropoff_location_name").alias("d_zone_name"),
        F.col("dropoff_borough").alias("d_borough"),
        "service_type",
    )
    cols = [c for s in _SETS.values() for c in s]
    flags = [F.grouping(s[0]).alias(f"g_{name}") for name, s in _SETS.items()]
    return src.groupingSets([["source_month", *s] for s in _SETS.values()], "source_month", *cols).agg(*flags)


def _in_set(dom: DataFrame, name: str) -> DataFrame:
    return dom.where(F.col(f"g_{name}") == 0)


def dim_date(domains: DataFrame, params: Params) -> DataFrame:
    """Calendar rows for every pickup day (and dropoff day unless
    ``dropoff_dates`` is False, which reproduces the reference exactly)."""
    days = _in_set(domains, "p_day").select(F.col("p_day").alias("full_date"))
    if params.dropoff_dates:
        days = days.union(_in_set(domains, "d_day").select(F.col("d_day").alias("full_date")))
    d = F.col("full_date")
    return days.distinct().select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        day_of_week_sun0(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),  # ISO week, as extract(week)
        F.quarter(d).alias("quarter"),
    )


def dim_time(domains: DataFrame, params: Params) -> DataFrame:
    """(hour, minute) rows with HHMM key and period of day; at most 1440."""
    t = _in_set(domains, "p_time").select(F.col("p_hour").alias("hour"), F.col("p_minute").alias("minute"))
    if params.dropoff_times:
        t = t.union(_in_set(domains, "d_time").select(F.col("d_hour").alias("hour"),
                                                      F.col("d_minute").alias("minute")))
    return t.distinct().select(
        (F.col("hour") * 100 + F.col("minute")).alias("time_key"), "hour", "minute",
        time_period("hour").alias("time_period"))


def dim_zone(domains: DataFrame) -> DataFrame:
    """Union of pickup and dropoff zones, distinct.  Borough is kept."""
    p = _in_set(domains, "p_zone").select(F.col("p_zone_key").alias("zone_key"),
                                          F.col("p_zone_name").alias("zone_name"),
                                          F.col("p_borough").alias("borough"))
    d = _in_set(domains, "d_zone").select(F.col("d_zone_key").alias("zone_key"),
                                          F.col("d_zone_name").alias("zone_name"),
                                          F.col("d_borough").alias("borough"))
    return p.union(d).distinct()


def dim_service_type(domains: DataFrame) -> DataFrame:
    return (_in_set(domains, "service").select(F.col("service_type").alias("service_type_key"),
                                              F.col("service_type")).distinct())


def months_with(domains: DataFrame, days: list, minutes: list) -> list[str]:
    """Months whose dropoffs fall on one of the days or (hour, minute)s."""
    day = F.col("d_day").isin(days) if days else F.lit(False)
    minute = (F.col("d_hour") * 60 + F.col("d_minute")).isin([h * 60 + m for h, m in minutes]) if minutes else F.lit(False)
    hit = domains.where(((F.col("g_d_day") == 0) & day) | ((F.col("g_d_time") == 0) & minute))
    return sorted(r[0] for r in hit.select("source_month").distinct().collect())


def data_dims(silver: DataFrame, params: Params, *, domains: DataFrame | None = None) -> dict[str, DataFrame]:
    dom = domains if domains is not None else dimension_domains(silver)
    return {
        "dim_date": dim_date(dom, params),
        "dim_time": dim_time(dom, params),
        "dim_zone": dim_zone(dom),
        "dim_service_type": dim_service_type(dom),
    }
