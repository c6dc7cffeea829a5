"""Physical plan checks: the fact build and the questions never shuffle trip
rows through a join, date filters prune month directories, top-k uses
TakeOrderedAndProject, and no Python evaluation appears anywhere."""

import pytest

from cabflow.operators.bronze import bronze_trips
from cabflow.operators.fact import fct_trips
from cabflow.params import FIXTURE_PARAMS as P
from cabflow.plans import questions as Q
from cabflow.plans.catalog import QUERIES, Run
from cabflow.plans.gold import build_gold
from cabflow.sources import fixture
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("gold"))
    t = fixture.load_tables(spark, SF001)
    bronze_trips(fixture.raw_trips(t)).write.partitionBy("service_type", "source_month").parquet(f"{work}/bronze")
    fixture.zones_view(t).write.parquet(f"{work}/zones")
    bronze, zones = spark.read.parquet(f"{work}/bronze"), spark.read.parquet(f"{work}/zones")
    return build_gold(spark, bronze, zones, P, out_dir=f"{work}/gold")


def test_fact_build_is_broadcast_only(gold):
    p = plan(fct_trips(gold.silver, gold.dims, P))
    assert p.count("BroadcastHashJoin") == 12          # 2 zone joins in silver + 10 dimension roles
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert "Exchange hashpartitioning" not in p and "Exchange rangepartitioning" not in p


def test_year_questions_prune_month_directories(gold):
    t = gold.tables()
    for q in ("q01", "q03", "q05", "q09", "q15"):
        p = plan(Q.QUESTIONS[q](t, P))
        assert "PartitionFilters: [isnotnull(pickup_month" in p, q
    assert "PartitionFilters: [isnotnull(pickup_month" in plan(Q.pruned_count(t, P))


def test_top_k_and_group_limit(gold):
    t = gold.tables()
    for q in ("q03", "q12", "q13", "q19", "q20"):
        assert "TakeOrderedAndProject" in plan(Q.QUESTIONS[q](t, P)), q
    assert "WindowGroupLimit" in plan(Q.q05(t, P))


def test_question_joins_are_broadcast(gold):
    t = gold.tables()
    for name, fn in Q.QUESTIONS.items():
        p = plan(fn(t, P))
        assert "SortMergeJoin" not in p, name


def test_no_python_evaluation_in_registered_queries(spark):
    r = Run(spark, SF001)
    skip = {"scan_trips", "stream_ingest", "replace_slice_rerun", "list_partition_counts", "scan_zones",
            "impute_median", "replace_slice_empty", "materialize_kinds", "csv_round_trip", "fact_rebuild", "landing_manifest"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        p = plan(fn(r))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_registered_queries_prune_written_gold(spark):
    r = Run(spark, SF001)
    for q in ("pruned_count", "q01", "q03", "q05", "q09", "q15"):
        p = plan(QUERIES[q](r))
        assert "PartitionFilters: [isnotnull(pickup_month" in p, q
        assert p.count("BroadcastHashJoin") <= 2, q          # the fact is read, not built again


def test_profile_scans_bronze_once(spark, gold):
    from cabflow.operators.silver import slice_profile
    r = Run(spark, SF001)
    raw_scans = lambda p: sum("FileScan" in x and "tpep_pickup_datetime" in x for x in p.splitlines())
    assert raw_scans(plan(slice_profile(r.bronze, r.zones, P))) == 1
    for q in ("coverage", "reject_reasons", "reject_first_reason"):
        assert raw_scans(plan(QUERIES[q](r))) == 0, q


def test_percentiles_run_over_counts_only(gold):
    import re
    t = gold.tables()
    for q in ("q18", "q19"):
        p = plan(Q.QUESTIONS[q](t, P))
        keys = re.findall(r"keys=\[([^\]]*)\], functions=\[partial_(\w+)", p)
        assert any("trip_duration_minutes" in k and f == "count" for k, f in keys), q
        assert all("trip_duration_minutes" not in k for k, f in keys if f == "percentile"), q


def test_answers_do_not_hang_on_the_broadcast_cap(spark):
    a, b = Run(spark, SF001), Run(spark, SF001, P.with_(broadcast_max_rows=0))
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    for q in ("q02", "q05", "q14", "q20", "unmatched_keys", "dq_relationships", "reject_first_reason", "coverage"):
        assert rows(QUERIES[q](a)) == rows(QUERIES[q](b)), q


def test_fact_scans_read_only_needed_columns(gold):
    import re
    t = gold.tables()
    expect = {
        "q14": {"payment_type_key", "total_amount", "tip_amount", "fare_amount", "pickup_month"},
        "q18": {"pickup_location_key", "trip_duration_minutes", "pickup_month"},
        "q01": {"pickup_date_key", "pickup_month"},
    }
    for q, cols in expect.items():
        p = plan(Q.QUESTIONS[q](t, P))
        scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*fct_trips", p)
        read = {c.split("#")[0] for s in scans for c in s.split(",")} - {"version"}   # a folder's name, not read
        assert read == cols, (q, read)
