"""Physical-plan census of the questions and reports over the written gold
layer: shuffles (Exchange kinds), join strategies, partition filters and the
columns each fact scan reads.  Writes a Markdown table (PLANS.md).

usage: python tools/plan_census.py SF_DIR [OUT.md]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cabflow.operators.bronze import bronze_trips  # noqa: E402
from cabflow.operators.coverage import coverage  # noqa: E402
from cabflow.operators.dims import dimension_domains  # noqa: E402
from cabflow.operators.fact import fct_trips, unmatched_keys  # noqa: E402
from cabflow.operators.silver import reject_reasons, slice_profile  # noqa: E402
from cabflow.params import FIXTURE_PARAMS as P  # noqa: E402
from cabflow.plans import questions as Q  # noqa: E402
from cabflow.plans.gold import build_gold  # noqa: E402
from cabflow.plans.medallion import quality_reports  # noqa: E402
from cabflow.session import local_session  # noqa: E402
from cabflow.sources import fixture  # noqa: E402
from cabflow.sources.generators import slice_grid_from  # noqa: E402


def census(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    ex = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    fact_scans = [m for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*fct_trips[^\n]*", plan)]
    fact_cols = sorted({c.split("#")[0] for m in fact_scans for c in m.group(1).split(",") if c})
    pf = re.findall(r"fct_trips[^\n]*PartitionFilters: \[([^\]]*)\]", plan)
    return {
        "exchanges": ", ".join(f"{ex.count(k)}× {k}" for k in sorted(set(ex))) or "none",
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin"),
        "topk": "TakeOrderedAndProject" in plan,
        "wgl": "WindowGroupLimit" in plan,
        "fact_cols": ", ".join(fact_cols) if fact_cols else "-",
        "pruned": any("pickup_month" in x for x in pf),
    }


def main():
    sf = sys.argv[1]
    out = sys.argv[2] if len(sys.argv) > 2 else None
    spark = local_session()
    work = tempfile.mkdtemp(prefix="cabflow-census-", dir=os.environ.get("BENCH_WORK", "/tmp"))
    t = fixture.load_tables(spark, sf)
    (bronze_trips(fixture.raw_trips(t)).write.partitionBy("service_type", "source_month")
     .parquet(f"{work}/bronze"))
    fixture.zones_view(t).write.parquet(f"{work}/zones")
    bronze, zones = spark.read.parquet(f"{work}/bronze"), spark.read.parquet(f"{work}/zones")
    gold = build_gold(spark, bronze, zones, P, out_dir=f"{work}/gold")
    tables = gold.tables()
    jobs = {k: fn(tables, P) for k, fn in Q.QUESTIONS.items()}
    jobs["pruned_count"] = Q.pruned_count(tables, P)
    jobs["(build) dimension_domains"] = dimension_domains(gold.silver)
    jobs["(build) fct_trips"] = fct_trips(gold.silver, gold.dims, P)
    jobs["(build) slice_profile"] = slice_profile(bronze, zones, P)
    jobs["(build) slice_profile"].write.parquet(f"{work}/profile")
    profile = spark.read.parquet(f"{work}/profile")
    jobs["coverage"] = coverage(profile, slice_grid_from(profile, P.services))
    jobs["reject_reasons"] = reject_reasons(profile)
    jobs["unmatched_keys"] = unmatched_keys(tables["fct_trips"])
    for k, df in quality_reports(gold, zones, P).items():
        jobs[k] = df
    lines = ["| query | exchanges | broadcast joins | shuffle joins | top-k | group limit | "
             "month pruned | fact columns read |", "|---|---|---|---|---|---|---|---|"]
    for k, df in jobs.items():
        c = census(df)
        lines.append(f"| `{k}` | {c['exchanges']} | {c['bhj']} | {c['smj']} | {'yes' if c['topk'] else ''} | "
                     f"{'yes' if c['wgl'] else ''} | {'yes' if c['pruned'] else ''} | {c['fact_cols']} |")
    text = "\n".join(lines)
    for k in ("(build) fct_trips", "q05", "pruned_count"):
        df = jobs[k]
        tree = df._jdf.queryExecution().executedPlan().treeString()
        tree = re.sub(r"file:[^\],]*/(gold|bronze|zones)/", r"\1/", tree)
        tree = re.sub(r"#\d+L?", "", tree)
        tree = "\n".join(line[:220] for line in tree.splitlines())
        text += f"\n\n### `{k}` physical plan\n\n```\n{tree}\n```"
    if out:
        with open(out, "w") as fh:
            fh.write(text + "\n")
    print(text)


if __name__ == "__main__":
    main()
