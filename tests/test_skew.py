"""One key holding a third of all rows: results stay exact (brute force in
pandas on a small fixture) and plans keep partial aggregation."""

import numpy as np
from pyspark.sql import functions as F

from cabflow.operators.quality import relationships_report
from cabflow.plans import questions as Q
from cabflow.plans.catalog import Run
from tests.conftest import SF001


def _skewed(spark):
    r = Run(spark, SF001)
    t = dict(r.t)
    hot = 3
    f = t["fct_trips"]
    # a third of all trips start in one zone
    t["fct_trips"] = f.withColumn(
        "pickup_location_key",
        F.when(F.pmod(F.xxhash64("pickup_time_key", "dropoff_time_key", "total_amount"), F.lit(3)) == 0,
               F.lit(hot)).otherwise(F.col("pickup_location_key")))
    return r, t, hot


def test_percentiles_exact_under_a_hot_zone(spark):
    r, t, hot = _skewed(spark)
    fact = t["fct_trips"].where(F.col("pickup_date") >= r.p.min_date).select(
        "pickup_location_key", "trip_duration_minutes").toPandas()
    zones = t["dim_zone"].toPandas()
    assert (fact.pickup_location_key == hot).mean() > 0.3
    m = fact.merge(zones, left_on="pickup_location_key", right_on="zone_key")
    want = {b: (np.percentile(g.trip_duration_minutes, 50), np.percentile(g.trip_duration_minutes, 90))
            for b, g in m.groupby("borough")}
    got = {x.borough: (x.p50, x.p90) for x in Q.q18(t, r.p).collect()}
    assert got.keys() == want.keys()
    for b in want:
        assert abs(got[b][0] - want[b][0]) < 1e-9 and abs(got[b][1] - want[b][1]) < 1e-9
    plan = Q.q18(t, r.p)._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile" in plan


def test_routes_and_relationships_under_a_hot_zone(spark):
    r, t, hot = _skewed(spark)
    fact = t["fct_trips"].where(F.col("pickup_date") >= r.p.min_date).toPandas()
    zones = t["dim_zone"].toPandas().set_index("zone_key").borough
    routes = (fact.assign(p_bor=fact.pickup_location_key.map(zones), d_bor=fact.dropoff_location_key.map(zones))
              .groupby(["p_bor", "d_bor"]).size().reset_index(name="total")
              .sort_values(["total", "p_bor", "d_bor"], ascending=[False, True, True]).head(10))
    got = [(x.p_bor, x.d_bor, x.total) for x in Q.q20(t, r.p).collect()]
    assert got == [tuple(v) for v in routes[["p_bor", "d_bor", "total"]].itertuples(index=False, name=None)]
    d = t
    checks = [("pk", d["fct_trips"], "pickup_location_key", d["dim_zone"], "zone_key"),
              ("dk", d["fct_trips"], "dropoff_location_key", d["dim_zone"], "zone_key")]
    assert {x.test: x.failures for x in relationships_report(checks).collect()} == {"pk": 0, "dk": 0}
