"""K7 on the fact: months brought up to date equal a full build."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cabflow.operators.bronze import bronze_trips
from cabflow.params import FIXTURE_PARAMS as P
from cabflow.plans import medallion
from cabflow.plans.gold import build_gold, update_gold
from cabflow.sinks.versioned import VersionedTable
from cabflow.sinks.writers import replace_slice, write_csv
from cabflow.sources import fixture
from tests.conftest import SF001

FIRST, LAST = "1996-11", "1997-04"


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("trips"))
    t = fixture.load_tables(spark, SF001)
    fixture.raw_trips(t).where(F.col("source_month").between(FIRST, LAST)).coalesce(2).write.parquet(f"{work}/raw")
    fixture.zones_view(t).write.parquet(f"{work}/zones")
    return spark.read.parquet(f"{work}/raw"), spark.read.parquet(f"{work}/zones")


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def same_gold(got, want):
    assert rows(got.fact) == rows(want.fact)
    for name in want.dims:
        assert rows(got.dims[name].select(*want.dims[name].columns)) == rows(want.dims[name]), name


@pytest.mark.parametrize("params", [P, P.with_(dropoff_dates=False, dropoff_times=False)])
def test_update_equals_full_build(spark, trips, scratch, params):
    raw, zones = trips
    bronze = bronze_trips(raw)
    path = f"{scratch}/bronze"
    new = (F.col("source_month") == LAST) | ((F.col("source_month") == "1997-01") & (F.col("service_type") == "green"))
    replace_slice(bronze.where(~new), path)
    build_gold(spark, spark.read.parquet(path), zones, params, out_dir=f"{scratch}/gold")
    table = VersionedTable(spark, f"{scratch}/gold/fct_trips")
    before = table.state()["parts"]
    replace_slice(bronze.where(new), path)
    # a slice that came again with most of its trips gone: its days leave the dimensions
    replace_slice(bronze.where("source_month = '1996-12' AND service_type = 'yellow'").limit(2), path)
    months = [LAST, "1997-01", "1996-12"]
    got = update_gold(spark, spark.read.parquet(path), zones, params, months, out_dir=f"{scratch}/gold")
    same_gold(got, build_gold(spark, spark.read.parquet(path), zones, params, out_dir=f"{scratch}/full"))
    after = table.state()["parts"]
    changed = {k for k in after if after[k] != before.get(k)}
    want = {f"pickup_month={m}-01" for m in months}
    assert changed == want if params is P else changed >= want
    assert {"pickup_month=1996-11-01", "pickup_month=1997-02-01"} & set(after) if params is P else True


def test_update_without_a_build_and_with_other_zones(spark, trips, scratch):
    raw, zones = trips
    bronze = bronze_trips(raw)
    first = update_gold(spark, bronze, zones, P, [LAST], out_dir=f"{scratch}/gold")
    same_gold(first, build_gold(spark, bronze, zones, P, out_dir=f"{scratch}/full"))
    fewer = zones.where("location_id <> 3")
    got = update_gold(spark, bronze, fewer, P, [LAST], out_dir=f"{scratch}/gold")
    same_gold(got, build_gold(spark, bronze, fewer, P, out_dir=f"{scratch}/fewer"))


def test_month_that_lost_all_its_trips(spark, trips, scratch):
    raw, zones = trips
    bronze = bronze_trips(raw)
    build_gold(spark, bronze, zones, P, out_dir=f"{scratch}/gold")
    left = bronze.where(F.col("source_month") != "1997-02")
    got = update_gold(spark, left, zones, P, ["1997-02"], out_dir=f"{scratch}/gold")
    same_gold(got, build_gold(spark, left, zones, P, out_dir=f"{scratch}/full"))
    assert got.fact.where("pickup_month = '1997-02-01'").isEmpty()


def test_incremental_flow(spark, trips, scratch, monkeypatch):
    """Two deliveries, a rerun of an earlier range over a folder that holds
    later months, a run that dies before gold, and a run with nothing new."""
    raw, zones = trips
    monkeypatch.setattr(medallion.Q, "QUESTIONS", {"q01": medallion.Q.QUESTIONS["q01"]})
    monkeypatch.setattr(medallion, "reshaped", lambda *a: {})
    monkeypatch.setattr(medallion, "quality_reports", lambda *a: {})
    landing, out = f"{scratch}/landing", f"{scratch}/out"
    write_csv(zones.select(F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
                           F.col("zone_name").alias("Zone"), "service_zone").coalesce(1), f"{scratch}/zones")

    def go(first, last, folder=out, incremental=True):
        return medallion.run(spark, landing, f"{scratch}/zones", folder, first, last, P, incremental=incremental)

    fixture.write_landing(raw.where(F.col("source_month") < "1997-03"), landing)
    go(date(1996, 11, 1), date(1997, 2, 1))
    fixture.write_landing(raw.where(F.col("source_month") >= "1997-03"), landing)
    calls = []
    update = medallion.update_gold
    monkeypatch.setattr(medallion, "update_gold", lambda *a, **k: calls.append(a[4]) or pytest.fail("dies"))
    with pytest.raises(BaseException, match="dies"):
        go(date(1996, 11, 1), date(1997, 4, 1))
    monkeypatch.setattr(medallion, "update_gold", lambda *a, **k: calls.append(a[4]) or update(*a, **k))
    go(date(1996, 11, 1), date(1997, 4, 1))
    assert calls == [["1997-03", "1997-04"]] * 2                       # found again after the dead run
    fixture.write_landing(raw.where(F.col("source_month") == "1996-12"), landing)
    go(date(1996, 11, 1), date(1997, 1, 1))                            # an earlier range: later months stay
    reports = go(date(1996, 11, 1), date(1997, 4, 1))
    assert calls[2:] == [["1996-12"], []]
    full = go(date(1996, 11, 1), date(1997, 4, 1), folder=f"{scratch}/full", incremental=False)
    for name in ("coverage", "reject_reasons", "reject_first_reason", "q01"):
        assert rows(reports[name]) == rows(full[name]), name
    fact = [VersionedTable(spark, f"{d}/gold/fct_trips").read() for d in (out, f"{scratch}/full")]
    assert rows(fact[0]) == rows(fact[1])
    assert go(date(1996, 11, 1), date(1997, 1, 1), incremental=False)["q01"] is not None   # domain: no error
