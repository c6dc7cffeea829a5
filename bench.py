"""Benchmark: build the pipeline once at $BENCH_SF_DIR, time each stage and
each question on the written gold tables.  Prints ONE JSON line.

Stages (timed once): landing (fixture tables -> raw slice files, setup),
ingest (slices -> bronze, K1), gold (silver view -> dims + month-partitioned
fact).  Questions: warm, median of $BENCH_REPEAT runs, result collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabflow.operators.bronze import bronze_trips  # noqa: E402
from cabflow.operators.coverage import coverage  # noqa: E402
from cabflow.operators.silver import reject_first_reason, reject_reasons, silver_trips, slice_profile  # noqa: E402
from cabflow.params import FIXTURE_PARAMS as P  # noqa: E402
from cabflow.plans import checks  # noqa: E402
from cabflow.plans import questions as Q  # noqa: E402
from cabflow.plans.gold import build_gold  # noqa: E402
from cabflow.session import local_session  # noqa: E402
from cabflow.sinks.writers import replace_slice  # noqa: E402
from cabflow.sources import fixture  # noqa: E402
from cabflow.sources.generators import slice_grid_from  # noqa: E402
from cabflow.sources.trips import read_trips  # noqa: E402


def _sf_number(sf_dir: str):
    tag = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    work = tempfile.mkdtemp(prefix="cabflow-bench-", dir=os.environ.get("BENCH_WORK", "/tmp"))
    n = int(cpus) if cpus.isdigit() else os.cpu_count()
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * n), app="cabflow-bench")
    stages: dict[str, float] = {}

    t = fixture.load_tables(spark, sf_dir)
    t0 = time.perf_counter()
    raw = fixture.raw_trips(t)
    fixture.write_landing(raw, f"{work}/landing")
    fixture.zones_view(t).write.mode("overwrite").parquet(f"{work}/zones")
    months = sorted(r[0] for r in spark.read.parquet(f"{work}/landing/yellow").select("source_month")
                    .union(spark.read.parquet(f"{work}/landing/green").select("source_month"))
                    .distinct().collect())
    stages["setup_landing"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    scanned = read_trips(spark, f"{work}/landing", P.services, months, fixture.FIXTURE_INGEST_TS)
    replace_slice(bronze_trips(scanned), f"{work}/bronze", skip_empty=False)
    stages["ingest_bronze"] = time.perf_counter() - t0

    bronze = spark.read.parquet(f"{work}/bronze")
    zones = spark.read.parquet(f"{work}/zones")
    t0 = time.perf_counter()
    gold = build_gold(spark, bronze, zones, P, out_dir=f"{work}/gold")
    stages["build_gold"] = time.perf_counter() - t0
    tables = gold.tables()
    fact_rows = tables["fct_trips"].count()

    silver = silver_trips(bronze, zones, P)
    jobs = {name: (lambda fn=fn: fn(tables, P)) for name, fn in Q.QUESTIONS.items()}
    jobs["pruned_count"] = lambda: Q.pruned_count(tables, P)
    t0 = time.perf_counter()
    made = slice_profile(bronze, zones, P)
    made.write.parquet(f"{work}/profile")
    stages["slice_profile"] = time.perf_counter() - t0
    profile = spark.read.schema(made.schema).parquet(f"{work}/profile")
    jobs["coverage"] = lambda: coverage(profile, slice_grid_from(profile, P.services))
    jobs["reject_reasons"] = lambda: reject_reasons(profile)
    jobs["reject_first_reason"] = lambda: reject_first_reason(profile)
    jobs["dq_silver"] = lambda: checks.silver_report(silver)

    timings: dict[str, float] = {}
    for name, job in jobs.items():
        job().collect()  # warm-up (also proves dimension sizes once)
        runs = []
        for _ in range(repeat):
            s = time.perf_counter()
            job().collect()
            runs.append(time.perf_counter() - s)
        timings[name] = round(statistics.median(runs), 4)

    # the reference's timed query at its own size: one month of about 3 million
    # rows, written next to the fact's own months, counted once, cold
    wide = tables["fct_trips"].where(F.col("pickup_month") == F.lit(date(P.year, 1, 1)))
    copies = max(1, round(2_985_411 / max(1, wide.count())))
    (wide.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
     .repartition(n).write.partitionBy("pickup_month").parquet(f"{work}/big/fct_trips"))
    spark.catalog.clearCache()
    s = time.perf_counter()
    big_rows = Q.pruned_count({"fct_trips": spark.read.parquet(f"{work}/big/fct_trips")}, P).first()[0]
    cold = time.perf_counter() - s

    pruned = timings["pruned_count"]
    month_rows = Q.pruned_count(tables, P).first()[0]
    total = round(sum(v for k, v in timings.items() if k.startswith("q")), 4)
    print(json.dumps({
        "metric": "questions_total_sec",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "stages": {k: round(v, 3) for k, v in stages.items()},
        "fact_rows": fact_rows,
        "pruned_month_rows": month_rows,
        "pruned_rows_per_sec": round(month_rows / pruned, 1) if pruned else None,
        "pruned_3m_rows": big_rows,
        "pruned_3m_cold_sec": round(cold, 3),
        "sf": _sf_number(sf_dir),
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
