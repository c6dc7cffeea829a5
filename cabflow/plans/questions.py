"""The twenty analytical questions over the star schema (plus q17_ref).

Each takes the gold tables (``fct_trips`` and the ``dim_*`` frames) and
Params, and returns a lazy DataFrame.  Fact filters go through
``pickup_range`` so the month directories are pruned; every dimension is
broadcast behind a size check, so no trip row is shuffled: the only
shuffles carry partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.predicates import pickup_range
from cabflow.operators.fact import STRUCTURAL_BOUNDS
from cabflow.operators.joins import row_count_at_most
from cabflow.operators.topk import top_k, top_n_per_group
from cabflow.params import Params

Tables = dict[str, DataFrame]


def _dim(t: Tables, name: str, p: Params, *cols, bound: int | None = None) -> DataFrame:
    """Dimension projection, broadcast once the whole dimension's size is
    proven (by ``bound`` or a bounded count, remembered per dimension)."""
    full = t[name]
    bound = bound if bound is not None else STRUCTURAL_BOUNDS.get(name)
    small = ((bound is not None and bound <= p.broadcast_max_rows)
             or row_count_at_most(full, p.broadcast_max_rows))
    d = full.select(*cols) if cols else full
    return F.broadcast(d) if small else d


def _fact(t: Tables, p: Params, *, year: bool = False, since_min: bool = False) -> DataFrame:
    f = t["fct_trips"]
    if year:
        f = f.where(pickup_range(p.year_start, p.next_year_start))
    elif since_min:
        f = f.where(pickup_range(p.min_date))
    return f


def _ratio(x: str, scale: int, y: str) -> str:
    """x * 100 * scale / y truncated toward zero, for x a decimal(14,2) and y
    whole; NULL for y = 0.  In bigint where the product fits, else in whole
    decimals, which hold any decimal(14,2)."""
    fits = (2**63 - 1) // (100 * scale)
    big = f"CAST((CAST({x} * 100 AS BIGINT) * {scale}) div nullif(CAST({y} AS BIGINT), 0) AS DECIMAL(38,0))"
    n = f"(CAST({x} * 100 AS DECIMAL(16,0)) * CAST({scale} AS DECIMAL(10,0)))"
    d = f"nullif(CAST({y} AS DECIMAL(16,0)), 0BD)"
    return f"CASE WHEN abs({x}) < {fits} THEN {big} ELSE CAST(({n} - {n} % {d}) / {d} AS DECIMAL(38,0)) END"


# Means are exact and reproducible: each averaged quantity is a fixed-point
# integer (ratios at 1e-9 resolution, truncated toward zero), summed as
# decimal(38,0), and divided once in double.  A double AVG would depend on
# how rows are split over tasks; this does not.
_TIP_RATIO_E9 = _ratio("tip_amount", 1_000_000_000, "fare_amount * 100")
# mph * 1e9: distance in hundredths * 60 * 1e7 / minutes
_SPEED_E9 = _ratio("trip_distance", 600_000_000, "trip_duration_minutes")
# q17_ref: minutes div 60 whole hours, as written in the reference
_SPEED_REF_E9 = _ratio("trip_distance", 10_000_000, "trip_duration_minutes div 60")


def exact_mean(x, scale: float = 1.0):
    """mean(x) / scale for an integral (fixed-point) ``x``; NULL for no rows."""
    x = F.expr(x) if isinstance(x, str) else x
    return (F.sum(x.cast("decimal(38,0)")).cast("double")
            / F.nullif(F.count(x), F.lit(0)).cast("double") / F.lit(float(scale)))


def _tip_pct():
    """A5: mean of per-trip ratios tip / fare, in percent; fare 0 drops out."""
    return exact_mean(_TIP_RATIO_E9, 1e7)


def _count():
    return F.count(F.lit(1))


def _duration_percentiles(trips: DataFrame, group: str, **quantiles: float) -> DataFrame:
    """Exact percentiles (percentile_cont) of the whole minutes per group.
    Trips are first counted per (group, minutes), which spreads a busy group
    over many keys; only that small histogram meets in a group."""
    hist = trips.groupBy(group, "trip_duration_minutes").agg(_count().alias("_n"))
    return hist.groupBy(group).agg(*[F.percentile("trip_duration_minutes", F.lit(q), F.col("_n")).alias(name)
                                     for name, q in quantiles.items()])


def q01(t: Tables, p: Params) -> DataFrame:
    """Trips by month of the analysis year (closed date range)."""
    f = t["fct_trips"].where(pickup_range(p.year_start, p.year_end, closed=True))
    d = _dim(t, "dim_date", p, "date_key", "month")
    return (f.join(d, F.col("pickup_date_key") == F.col("date_key"))
            .groupBy("month").agg(_count().alias("total_trips")).orderBy("month"))


def q02(t: Tables, p: Params) -> DataFrame:
    """Trips by service and month, all years pooled under month."""
    s = _dim(t, "dim_service_type", p, F.col("service_type_key").alias("_sk"), "service_type")
    d = _dim(t, "dim_date", p, "date_key", "month")
    return (t["fct_trips"].join(s, F.col("service_type_key") == F.col("_sk"))
            .join(d, F.col("pickup_date_key") == F.col("date_key"))
            .groupBy("service_type", "month").agg(_count().alias("total_trips")).orderBy("month"))


def _top_zones(t: Tables, p: Params, key: str) -> DataFrame:
    z = _dim(t, "dim_zone", p, "zone_key", "zone_name")
    g = (_fact(t, p, year=True).join(z, F.col(key) == F.col("zone_key"))
         .groupBy("zone_name").agg(_count().alias("total_trips")))
    return top_k(g, p.top_k, F.desc("total_trips"), F.asc("zone_name"))


def q03(t: Tables, p: Params) -> DataFrame:
    """Top pickup zones of the year."""
    return _top_zones(t, p, "pickup_location_key")


def q04(t: Tables, p: Params) -> DataFrame:
    """Top dropoff zones of the year (the filter is still on pickup_date)."""
    return _top_zones(t, p, "dropoff_location_key")


def q05(t: Tables, p: Params) -> DataFrame:
    """Top boroughs per month of the year, RANK with ties."""
    z = _dim(t, "dim_zone", p, "zone_key", "borough")
    g = (_fact(t, p, year=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
         .groupBy("borough", F.month("pickup_date").alias("month"))
         .agg(_count().alias("total_trips")))
    return top_n_per_group(g, "month", F.desc("total_trips"), p.top_per_group)


def q06(t: Tables, p: Params) -> DataFrame:
    """Top hours per day of week, all years."""
    d = _dim(t, "dim_date", p, "date_key", "day_of_week")
    h = _dim(t, "dim_time", p, "time_key", "hour", bound=24 * 60)
    g = (t["fct_trips"].join(d, F.col("pickup_date_key") == F.col("date_key"))
         .join(h, F.col("pickup_time_key") == F.col("time_key"))
         .groupBy("day_of_week", "hour").agg(_count().alias("total_trips")))
    return top_n_per_group(g, "day_of_week", F.desc("total_trips"), p.top_per_group)


def q07(t: Tables, p: Params) -> DataFrame:
    """Trips by day of week (0 = Sunday)."""
    d = _dim(t, "dim_date", p, "date_key", "day_of_week")
    return (t["fct_trips"].join(d, F.col("pickup_date_key") == F.col("date_key"))
            .groupBy("day_of_week").agg(_count().alias("total_trips"))
            .orderBy(F.desc("total_trips")))


def q08(t: Tables, p: Params) -> DataFrame:
    """Revenue by month, all years pooled."""
    d = _dim(t, "dim_date", p, "date_key", "month")
    return (t["fct_trips"].join(d, F.col("pickup_date_key") == F.col("date_key"))
            .groupBy("month").agg(F.sum("total_amount").alias("total_revenue")).orderBy("month"))


def q09(t: Tables, p: Params) -> DataFrame:
    """Revenue by service and month of the year (no join)."""
    return (_fact(t, p, year=True)
            .groupBy("service_type_key", F.month("pickup_date").alias("month"))
            .agg(F.sum("total_amount").alias("total_revenue")).orderBy("month"))


def q10(t: Tables, p: Params) -> DataFrame:
    """Mean tip percentage by month of the year."""
    return (_fact(t, p, year=True).groupBy(F.month("pickup_date").alias("month"))
            .agg(_tip_pct().alias("avg_tip_pct")).orderBy("month"))


def q11(t: Tables, p: Params) -> DataFrame:
    """Mean tip percentage by pickup borough and month of the year."""
    z = _dim(t, "dim_zone", p, "zone_key", "borough")
    return (_fact(t, p, year=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
            .groupBy("borough", F.month("pickup_date").alias("month"))
            .agg(_tip_pct().alias("avg_tip_pct")).orderBy("month"))


def q12(t: Tables, p: Params) -> DataFrame:
    """Top pickup zones by revenue since min_date."""
    z = _dim(t, "dim_zone", p, "zone_key", "zone_name")
    g = (_fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
         .groupBy("zone_name").agg(F.sum("total_amount").alias("total_revenue")))
    return top_k(g, p.top_k, F.desc("total_revenue"), F.asc("zone_name"))


def q13(t: Tables, p: Params) -> DataFrame:
    """Top pickup zones by mean tip percentage, zones with >= min_trips trips."""
    z = _dim(t, "dim_zone", p, "zone_key", "zone_name")
    g = (_fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
         .groupBy("zone_name").agg(_tip_pct().alias("avg_tip_pct"), _count().alias("_n"))
         .where(F.col("_n") >= p.min_trips).drop("_n"))
    return top_k(g, p.top_k, F.desc("avg_tip_pct"), F.asc("zone_name"))


def q14(t: Tables, p: Params) -> DataFrame:
    """Trips, revenue and tip percentage per payment type (NULL key is a group)."""
    return (_fact(t, p, since_min=True).groupBy("payment_type_key")
            .agg(_count().alias("total_trips"), F.sum("total_amount").alias("total_revenue"),
                 _tip_pct().alias("avg_tip_pct")))


def q15(t: Tables, p: Params) -> DataFrame:
    """Mean duration (whole minutes, D2) by month of the year."""
    return (_fact(t, p, year=True).groupBy(F.month("pickup_date").alias("month"))
            .agg(exact_mean(F.col("trip_duration_minutes")).alias("avg_duration")).orderBy("month"))


def q16(t: Tables, p: Params) -> DataFrame:
    """Mean distance by month of the year."""
    return (_fact(t, p, year=True).groupBy(F.month("pickup_date").alias("month"))
            .agg(exact_mean(F.expr("CAST(trip_distance * 100 AS BIGINT)"), 100).alias("avg_distance"))
            .orderBy("month"))


def q17(t: Tables, p: Params) -> DataFrame:
    """Mean speed (mph) by pickup borough and hour of day: the intended
    reading of the question (hour = HHMM key div 100, hours as a fraction)."""
    z = _dim(t, "dim_zone", p, "zone_key", "borough")
    return (_fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
            .groupBy("borough", F.expr("pickup_time_key div 100").alias("hour_slot"))
            .agg(exact_mean(_SPEED_E9, 1e9).alias("avg_speed_mph")))


def q17_ref(t: Tables, p: Params) -> DataFrame:
    """q17 as literally written (D3): slot = HHMM key div 60, and
    duration div 60 in whole hours, so trips under an hour drop out."""
    z = _dim(t, "dim_zone", p, "zone_key", "borough")
    return (_fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
            .groupBy("borough", F.expr("pickup_time_key div 60").alias("hour_slot"))
            .agg(exact_mean(_SPEED_REF_E9, 1e9).alias("avg_speed_mph")))


def q18(t: Tables, p: Params) -> DataFrame:
    """Exact p50 / p90 duration by pickup borough (percentile_cont)."""
    z = _dim(t, "dim_zone", p, "zone_key", "borough")
    trips = _fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
    return _duration_percentiles(trips, "borough", p50=0.5, p90=0.9)


def q19(t: Tables, p: Params) -> DataFrame:
    """Top pickup zones by p90 duration (ties broken by name)."""
    z = _dim(t, "dim_zone", p, "zone_key", "zone_name")
    trips = _fact(t, p, since_min=True).join(z, F.col("pickup_location_key") == F.col("zone_key"))
    g = _duration_percentiles(trips, "zone_name", p90=0.9)
    # equal percentiles can differ in the last bit (interpolation), so order by
    # the value at 1e-6 and let the name break ties
    return top_k(g, p.top_k, F.round("p90", 6).desc(), F.asc("zone_name"))


def q20(t: Tables, p: Params) -> DataFrame:
    """Top borough -> borough routes (same dimension in two roles)."""
    zp = _dim(t, "dim_zone", p, F.col("zone_key").alias("_pk"), F.col("borough").alias("p_bor"))
    zd = _dim(t, "dim_zone", p, F.col("zone_key").alias("_dk"), F.col("borough").alias("d_bor"))
    g = (_fact(t, p, since_min=True)
         .join(zp, F.col("pickup_location_key") == F.col("_pk"))
         .join(zd, F.col("dropoff_location_key") == F.col("_dk"))
         .groupBy("p_bor", "d_bor").agg(_count().alias("total")))
    return top_k(g, p.top_k, F.desc("total"), F.asc("p_bor"), F.asc("d_bor"))


def pruned_count(t: Tables, p: Params) -> DataFrame:
    """Count of one month of the fact (the reference's timed query); the
    implied pickup_month predicate prunes to one directory."""
    from datetime import date, timedelta
    lo = date(p.year, 1, 1)
    hi = date(p.year, 2, 1) - timedelta(days=1)
    return t["fct_trips"].where(pickup_range(lo, hi, closed=True)).agg(_count().alias("total_trips"))


QUESTIONS = {f"q{i:02d}": globals()[f"q{i:02d}"] for i in range(1, 21)}
QUESTIONS["q17_ref"] = q17_ref
