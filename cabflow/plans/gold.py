"""Bronze -> silver -> gold, lazily, written whole, or brought up to date.

Silver stays a view (as in the reference): its two readers, the dimension
pass and the fact, need different column sets, so re-reading bronze with
column pruning costs less than writing and re-reading all of silver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.dims import data_dims, dimension_domains, months_with
from cabflow.operators.fact import fct_trips
from cabflow.operators.silver import silver_trips
from cabflow.params import Params
from cabflow.schemas import PAYMENT_CATEGORIES, STATIC_DIMS
from cabflow.session import scratch_path
from cabflow.sinks.versioned import VersionedTable
from cabflow.sinks.writers import replace_table, write_fact, write_hash_bucketed, write_list_partitioned
from cabflow.sources.generators import static_dim


@dataclass
class Gold:
    silver: DataFrame
    dims: dict[str, DataFrame]
    fact: DataFrame
    extra: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {"fct_trips": self.fact, **self.dims}


#: Buckets of the zone dimension.
ZONE_BUCKETS = 4


def _write_dim(name: str, df: DataFrame, path: str, params: Params) -> DataFrame:
    """A dimension in the layout the reference gives it: LIST for services and
    payment types, HASH for zones, one plain table for the rest."""
    if name == "dim_service_type":
        return write_list_partitioned(df, path, "service_type", params.services)
    if name == "dim_payment_type":
        return write_list_partitioned(df, path, "payment_category", PAYMENT_CATEGORIES)
    if name == "dim_zone":
        return write_hash_bucketed(df, path, "zone_key", ZONE_BUCKETS)
    replace_table(df.coalesce(1), path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dims(spark: SparkSession, silver: DataFrame, domains: DataFrame, params: Params) -> dict[str, DataFrame]:
    return data_dims(silver, params, domains=domains) | {name: static_dim(spark, name) for name in STATIC_DIMS}


def _written_dims(dims: dict[str, DataFrame], base: str, params: Params) -> dict[str, DataFrame]:
    # seven small independent writes: run them as concurrent jobs
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        done = pool.map(lambda kv: _write_dim(kv[0], kv[1], f"{base}/{kv[0]}", params), dims.items())
        return dict(zip(dims, done))


def _first_day(month: str) -> str:
    return f"{month}-01"


def gold_inputs(zones: DataFrame, params: Params) -> dict:
    """What every month of gold depends on: a change of it wants a full build."""
    z = zones.select(F.xxhash64("location_id", "borough", "zone_name").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h")).first()
    return {"min_date": params.min_date.isoformat(), "services": list(params.services), "zones": f"{z.n}/{z.h}",
            "dropoff_dates": params.dropoff_dates, "dropoff_times": params.dropoff_times}


def _domain(domain: tuple | None, meta: dict) -> tuple[date | None, date | None]:
    """The RANGE domain asked for, reaching as far as earlier builds went."""
    if not domain:
        return None, None
    lo, hi = domain
    known = meta.get("domain_end")
    return lo, max(hi, date.fromisoformat(known)) if known and hi else hi


def build_gold(spark: SparkSession, bronze: DataFrame, zones: DataFrame, params: Params,
               *, out_dir: str | None = None, cluster_fact: bool = False,
               domain: tuple | None = None) -> Gold:
    """Build the star schema.

    ``out_dir=None``: the (small) dimension domains are written to the
    session's scratch folder, then dims and fact are lazy frames.
    ``out_dir`` given: all seven dims are written as tables and the fact as
    Parquet partitioned by month, published whole (K8); the returned frames
    read the written tables.
    ``cluster_fact`` range-partitions the fact by month first (for bronze that
    is not stored per slice); ``domain=(lo, hi)`` checks the RANGE domain,
    which months of an earlier build belong to as well.
    """
    silver = silver_trips(bronze, zones, params)
    domains = dimension_domains(silver)
    if out_dir is None:
        path = scratch_path(spark, "dimension_domains")
        replace_table(domains, path)
        dims = _dims(spark, silver, spark.read.schema(domains.schema).parquet(path), params)
        return Gold(silver=silver, dims=dims, fact=fct_trips(silver, dims, params))
    base = out_dir.rstrip("/")
    kept = VersionedTable(spark, f"{base}/_dimension_domains", "source_month")
    dims = _written_dims(_dims(spark, silver, kept.replace(domains), params), base, params)
    fact_path = f"{base}/fct_trips"
    lo, hi = _domain(domain, VersionedTable(spark, fact_path).meta())
    meta = {"inputs": gold_inputs(zones, params), "domain_end": hi.isoformat() if hi else None}
    fact = write_fact(fct_trips(silver, dims, params), fact_path, lo=lo, hi=hi, cluster=cluster_fact, meta=meta)
    return Gold(silver=silver, dims=dims, fact=fact)


def _changed(old: DataFrame, new: DataFrame, *cols: str) -> list[tuple]:
    """Members that one of two small dimensions lacks."""
    o, n = old.select(*cols), new.select(*cols)
    return [tuple(r) for r in o.exceptAll(n).unionAll(n.exceptAll(o)).collect()]


def update_gold(spark: SparkSession, bronze: DataFrame, zones: DataFrame, params: Params, months,
                *, out_dir: str, cluster_fact: bool = False, domain: tuple | None = None) -> Gold:
    """K7 on the fact: bring written gold up to date after the slices of
    ``months`` ('YYYY-MM') were replaced in bronze, reading these months alone.

    Their dimension domains are replaced and the dimensions merged anew from
    the domains of all months; then the fact of these months is published, the
    files of all others untouched.  (With pickup-only dimensions, D4/D5, a
    month whose dropoffs meet a day or minute that came or went is rewritten
    too.)  The result equals a full build.  Without a first build, or when
    zones or parameters changed, it is one.
    """
    base = out_dir.rstrip("/")
    fact_path = f"{base}/fct_trips"
    meta = VersionedTable(spark, fact_path).meta()
    kept = VersionedTable(spark, f"{base}/_dimension_domains", "source_month")
    if meta.get("inputs") != gold_inputs(zones, params) or not kept.exists():
        return build_gold(spark, bronze, zones, params, out_dir=out_dir, cluster_fact=cluster_fact, domain=domain)
    silver = silver_trips(bronze, zones, params)
    months = sorted(set(months))
    old = data_dims(silver, params, domains=kept.read())
    touched = bronze.where(F.col("source_month").isin(months))
    domains = kept.replace(dimension_domains(silver_trips(touched, zones, params)), months)
    dims = _dims(spark, silver, domains, params)
    rewritten = set(months)
    if not (params.dropoff_dates and params.dropoff_times):
        days = [] if params.dropoff_dates else [d for d, in _changed(old["dim_date"], dims["dim_date"], "full_date")]
        minutes = [] if params.dropoff_times else _changed(old["dim_time"], dims["dim_time"], "hour", "minute")
        if days or minutes:
            rewritten |= set(months_with(domains, days, minutes))
    dims = _written_dims(dims, base, params)
    part = silver_trips(bronze.where(F.col("source_month").isin(sorted(rewritten))), zones, params)
    lo, hi = _domain(domain, meta)
    fact = write_fact(fct_trips(part, dims, params), fact_path, lo=lo, hi=hi, cluster=cluster_fact,
                      months=[_first_day(m) for m in sorted(rewritten)],
                      meta={"domain_end": hi.isoformat()} if hi else None)
    return Gold(silver=silver, dims=dims, fact=fact)
