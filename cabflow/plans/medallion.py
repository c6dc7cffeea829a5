"""The whole medallion flow over real monthly slice files.

    python -m cabflow.plans.medallion --landing DIR --zones ZONES.csv --out DIR \
        --start 2022-01 --end 2025-11 [--year 2024] [--min-date 2022-01-01] \
        [--incremental]

1. ingest: every (service, month) slice of the grid -> bronze, replaced per
   slice (K1); missing slices are reported by coverage, not fatal;
2. gold: silver view -> dimensions (one grouping-sets pass) and the fact,
   published partitioned by month (K8) after the domain check (K11);
   with ``--incremental`` only slices with files that a landing manifest does
   not know are ingested, and only their months of gold are rewritten (K7);
3. reports: the twenty questions, their reshaped forms, coverage, reject
   profile, the row-count invariant and the data-quality tests, each written
   as Parquet under ``out/reports``.

All paths should be on shared storage; nothing is collected except the
tiny per-report summaries printed at the end.
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.bronze import bronze_trips, bronze_zones
from cabflow.operators.coverage import coverage
from cabflow.operators.fact import rowcount_invariant, unmatched_keys
from cabflow.operators.silver import reject_first_reason, reject_reasons, slice_profile
from cabflow.params import Params
from cabflow.plans import checks
from cabflow.plans import questions as Q
from cabflow.plans.gold import Gold, build_gold, gold_inputs, update_gold
from cabflow.plans.reports import reshaped
from cabflow.sinks.versioned import VersionedTable
from cabflow.sinks.writers import replace_slice
from cabflow.sources.generators import slice_grid
from cabflow.sources.manifest import Changes, Manifest
from cabflow.sources.trips import read_csv, read_trips, read_zones


def _months(spark: SparkSession, start: date, end: date, params: Params) -> list[str]:
    grid = slice_grid(spark, start, end, params.services)
    return sorted({r.source_month for r in grid.select("source_month").distinct().collect()})


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ingest(spark: SparkSession, landing: str, bronze_path: str, start: date, end: date,
           params: Params, ingest_ts: datetime | None = None) -> DataFrame:
    """Slices of the grid [start, end] -> bronze (replaced per slice)."""
    raw = read_trips(spark, landing, params.services, _months(spark, start, end, params), ingest_ts or _now())
    replace_slice(bronze_trips(raw), bronze_path)
    return spark.read.parquet(bronze_path)


def ingest_new(spark: SparkSession, changes: Changes, landing: str, bronze_path: str,
               ingest_ts: datetime | None = None) -> list[str]:
    """The slices that received files -> bronze, each re-read whole (one scan
    per service and footer schema); returns their months."""
    files = changes.files()
    touched = changes.slices()
    for service in sorted({s for s, _ in touched}):
        raw = read_trips(spark, landing, [service], [m for s, m in touched if s == service], ingest_ts or _now(),
                         manifest=files)
        replace_slice(bronze_trips(raw), bronze_path)
    return sorted({m for _, m in touched})


def quality_reports(gold: Gold, zones: DataFrame, params: Params) -> dict[str, DataFrame]:
    return {
        "dq_silver": checks.silver_report(gold.silver).withColumn("model", F.lit("silver")),
        "dq_gold": checks.gold_report(gold.fact).withColumn("model", F.lit("fct_trips")),
        "dq_relationships": checks.relationship_report(gold, zones, params),
        "unmatched_keys": unmatched_keys(gold.fact),
        "fact_rowcount_invariant": rowcount_invariant(gold.silver, gold.fact),
    }


def _next_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


def run(spark: SparkSession, landing: str, zones_csv: str, out: str, start: date, end: date,
        params: Params, incremental: bool = False) -> dict[str, DataFrame]:
    out = out.rstrip("/")
    bronze_path, gold_dir = f"{out}/bronze", f"{out}/gold"
    changes = touched = None
    if incremental:
        manifest = Manifest(spark, f"{out}/landing_manifest")
        changes = manifest.changes(landing, params.services, _months(spark, start, end, params))
        touched = ingest_new(spark, changes, landing, bronze_path)
        bronze = spark.read.parquet(bronze_path)
    else:
        bronze = ingest(spark, landing, bronze_path, start, end, params)
    zones = bronze_zones(read_zones(spark, zones_csv))
    zones.write.mode("overwrite").parquet(f"{out}/bronze_zones")
    zones = spark.read.schema(zones.schema).parquet(f"{out}/bronze_zones")
    domain = (params.min_date, _next_month(end))
    profile = VersionedTable(spark, f"{out}/slice_profile", "source_month")
    inputs = gold_inputs(zones, params)
    known = profile.meta().get("inputs") == inputs
    if incremental:
        gold = update_gold(spark, bronze, zones, params, touched, out_dir=gold_dir, domain=domain)
    else:
        gold = build_gold(spark, bronze, zones, params, out_dir=gold_dir, domain=domain)
    tables = gold.tables()
    if incremental and known:
        part = bronze.where(F.col("source_month").isin(touched))
        profile = profile.replace(slice_profile(part, zones, params), touched)
    else:
        profile = profile.replace(slice_profile(bronze, zones, params), meta={"inputs": inputs})
    if changes:
        changes.publish()  # bronze, gold and profile hold the arrivals now
    reports = {name: fn(tables, params) for name, fn in Q.QUESTIONS.items()}
    reports.update({name: make() for name, make in reshaped(tables, zones, params).items()})
    reports["coverage"] = coverage(profile, slice_grid(spark, start, end, params.services))
    reports["reject_reasons"] = reject_reasons(profile)
    reports["reject_first_reason"] = reject_first_reason(profile)
    reports.update(quality_reports(gold, zones, params))
    # independent small jobs: run a few at a time so they share the cluster
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda kv: kv[1].write.mode("overwrite").parquet(f"{out}/reports/{kv[0]}"),
                      reports.items()))
    return {name: spark.read.schema(df.schema).parquet(f"{out}/reports/{name}") for name, df in reports.items()}


def fill_missing_csv(spark: SparkSession, src: str, dst: str, cols, schema=None) -> DataFrame:
    """The passenger demo (S3 + P8 + M1 + K3): read a CSV with a header, keep
    the numeric columns (double, if no schema is given), fill each column's
    gaps with its upper median and write the result as CSV with a header."""
    from cabflow.operators.impute import impute_upper_median, select_numeric
    from cabflow.operators.quality import assert_defined
    from cabflow.sinks.writers import write_csv
    cols = list(cols)
    df = assert_defined(read_csv(spark, src, schema), src)
    if schema is None:
        df = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    filled = impute_upper_median(select_numeric(df, cols), cols)
    write_csv(filled, dst)
    return read_csv(spark, dst, filled.schema)


def _month(s: str) -> date:
    return datetime.strptime(s, "%Y-%m").date()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--landing", required=True)
    ap.add_argument("--zones", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--start", required=True, type=_month)
    ap.add_argument("--end", required=True, type=_month)
    ap.add_argument("--year", type=int, default=Params.year)
    ap.add_argument("--min-date", type=date.fromisoformat, default=Params.min_date)
    ap.add_argument("--incremental", action="store_true", help="only slices with files not ingested before")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cabflow-medallion").getOrCreate()
    params = Params(min_date=a.min_date, year=a.year)
    reports = run(spark, a.landing, a.zones, a.out, a.start, a.end, params, incremental=a.incremental)
    reports["dq_silver"].show(50, truncate=False)
    reports["dq_relationships"].show(50, truncate=False)


if __name__ == "__main__":
    main()
