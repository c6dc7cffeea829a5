"""The trip fact (P14, F6, J2-J5) and its key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.operators.joins import row_count_at_most
from cabflow.params import Params
from cabflow.schemas import FACT_COLUMNS, STATIC_DIMS

KEY_COLUMNS = [
    "pickup_date_key", "dropoff_date_key", "pickup_time_key", "dropoff_time_key",
    "pickup_location_key", "dropoff_location_key", "payment_type_key", "vendor_key",
    "ratecode_key", "service_type_key",
]
# Largest number of rows a dimension can have by construction.
MINUTES_PER_DAY = 24 * 60
STRUCTURAL_BOUNDS = {"dim_time": MINUTES_PER_DAY, **{k: len(v[0]) for k, v in STATIC_DIMS.items()}}


def broadcastable(dims: dict[str, DataFrame], cap: int) -> dict[str, bool]:
    """Which dimensions may be broadcast: proven by construction
    (``STRUCTURAL_BOUNDS``) or by the bytes of their files; no job runs."""
    return {n: STRUCTURAL_BOUNDS.get(n, cap + 1) <= cap or row_count_at_most(d, cap) for n, d in dims.items()}


def _lookup(dim: DataFrame, small: bool, *cols) -> DataFrame:
    side = dim.select(*cols)
    return F.broadcast(side) if small else side


def fct_trips(silver: DataFrame, dims: dict[str, DataFrame], params: Params) -> DataFrame:
    """Silver LEFT JOIN the ten dimension roles.

    Every dimension is broadcast once its size is proven (dim_time by
    construction, static dims by their fixed rows, the others by their
    files' bytes), so the fact is built without any shuffle of trip rows: each
    task probes ten small hash tables.  Unmatched codes keep a NULL key (D6).
    Adds ``pickup_month`` (first day of the month), the partition column of
    the written fact.
    """
    small = broadcastable(dims, params.broadcast_max_rows)
    t = (silver.where(F.col("dropff_ts").isNotNull())
         .withColumns({
             "_p_day": F.col("pickup_ts").cast("date"), "_d_day": F.col("dropff_ts").cast("date"),
             "_p_h": F.hour("pickup_ts"), "_p_m": F.minute("pickup_ts"),
             "_d_h": F.hour("dropff_ts"), "_d_m": F.minute("dropff_ts"),
         }))
    dd, tt, zz = dims["dim_date"], dims["dim_time"], dims["dim_zone"]
    t = t.join(_lookup(dd, small["dim_date"], F.col("full_date").alias("_p_day"),
                       F.col("date_key").alias("pickup_date_key")), "_p_day", "left")
    t = t.join(_lookup(dd, small["dim_date"], F.col("full_date").alias("_d_day"),
                       F.col("date_key").alias("dropoff_date_key")), "_d_day", "left")
    t = t.join(_lookup(tt, small["dim_time"], F.col("hour").alias("_p_h"), F.col("minute").alias("_p_m"),
                       F.col("time_key").alias("pickup_time_key")), ["_p_h", "_p_m"], "left")
    t = t.join(_lookup(tt, small["dim_time"], F.col("hour").alias("_d_h"), F.col("minute").alias("_d_m"),
                       F.col("time_key").alias("dropoff_time_key")), ["_d_h", "_d_m"], "left")
    t = t.join(_lookup(zz, small["dim_zone"], F.col("zone_key").alias("pickup_location"),
                       F.col("zone_key").alias("pickup_location_key")), "pickup_location", "left")
    t = t.join(_lookup(zz, small["dim_zone"], F.col("zone_key").alias("dropff_location"),
                       F.col("zone_key").alias("dropoff_location_key")), "dropff_location", "left")
    pay, ven, rat, svc = (dims["dim_payment_type"], dims["dim_vendor"], dims["dim_ratecode"],
                          dims["dim_service_type"])
    t = t.join(_lookup(pay, small["dim_payment_type"], F.col("payment_type_key").alias("payment_type"),
                       "payment_type_key"), "payment_type", "left")
    t = t.join(_lookup(ven, small["dim_vendor"], F.col("vendor_key").alias("vendor_id"),
                       "vendor_key"), "vendor_id", "left")
    t = t.join(_lookup(rat, small["dim_ratecode"], F.col("ratecode_key").alias("ratecode_id"),
                       "ratecode_key"), "ratecode_id", "left")
    t = t.join(_lookup(svc, small["dim_service_type"], F.col("service_type_key").alias("service_type"),
                       "service_type_key"), "service_type", "left")
    measures = {
        "pickup_date": F.col("_p_day"),
        # The fact stores whole minutes (int column), rounded half away from zero.
        "trip_duration_minutes": F.round("trip_duration_minutes").cast("int"),
    }
    out = t.withColumns(measures)
    return out.select(*FACT_COLUMNS, F.trunc("_p_day", "month").alias("pickup_month"))


def unmatched_keys(fact: DataFrame) -> DataFrame:
    """Rows whose dimension key is NULL, per key column, in one pass."""
    wide = fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in KEY_COLUMNS])
    return wide.unpivot([], KEY_COLUMNS, "key_column", "unmatched")


def rowcount_invariant(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """The ten left joins must not fan out: count(fact) == count(silver).
    Two rows (layer, row_count); equal counts are the invariant."""
    s = silver.agg(F.lit("silver").alias("layer"), F.count(F.lit(1)).alias("row_count"))
    f = fact.agg(F.lit("fact").alias("layer"), F.count(F.lit(1)).alias("row_count"))
    return s.unionByName(f)


def dimension_usage(fact: DataFrame, dim: DataFrame, dim_key: str, fact_key: str | None = None,
                    max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Dimension rows with the number of fact rows referencing each (0 when
    none).  The fact is reduced to one row per key with map-side partial
    aggregation before the (small) join."""
    fk = fact_key or dim_key
    used = fact.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(dim_key)).agg(
        F.count(F.lit(1)).alias("trips"))
    # the fact's key column holds only dimension keys (unmatched codes became
    # NULL in fct_trips), so ``used`` has at most as many rows as ``dim``
    used = F.broadcast(used) if row_count_at_most(dim, max_broadcast_rows) else used
    return (dim.join(used, dim_key, "left")
            .withColumn("trips", F.coalesce(F.col("trips"), F.lit(0).cast("long"))))


def usage_by_bucket(fact: DataFrame, dim: DataFrame, dim_key: str, fact_key: str, buckets: int) -> DataFrame:
    """The same counts for a dimension of any size, stored in ``buckets`` by
    ``dim_key``: a merge join that deals the counts (one row a key) by the
    dimension's buckets and leaves the dimension where it is."""
    used = fact.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias(dim_key)).agg(
        F.count(F.lit(1)).alias("trips"))
    used = used.repartition(buckets, dim_key)
    return (dim.hint("merge").join(used, dim_key, "left")
            .withColumn("trips", F.coalesce(F.col("trips"), F.lit(0).cast("long"))))
