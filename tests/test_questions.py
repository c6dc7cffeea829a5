"""Question semantics: ties, integer division, percentiles, pivots."""

from datetime import date

from pyspark.sql import functions as F

from cabflow.operators.reshape import pivot_counts, route_edges, unpivot_measures
from cabflow.operators.topk import top_k, top_n_per_group


def test_rank_ties_let_more_rows_pass(spark):
    rows = [("m", f"b{i}", c) for i, c in enumerate([9, 8, 7, 6, 5, 5, 4])]
    df = spark.createDataFrame(rows, "month string, borough string, total_trips long")
    out = top_n_per_group(df, "month", F.desc("total_trips"), 5).collect()
    assert len(out) == 6 and max(r.rnk for r in out) == 5


def test_top_k_is_deterministic_with_tie_break(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "zone_name string, n long")
    out = top_k(df, 1, F.desc("n"), F.asc("zone_name")).collect()
    assert out[0].zone_name == "a"


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([(1, "A", 10), (1, "B", 20), (2, "A", 5)],
                               "month int, borough string, total_trips long")
    p = {r.month: r for r in pivot_counts(df, "month", "borough", "total_trips").collect()}
    assert p[1].A == 10 and p[1].B == 20 and p[2].B is None
    u = unpivot_measures(df, "month", ["total_trips"]).collect()
    assert {(r.month, r.measure, r.value) for r in u} == {(1, "total_trips", 10.0), (1, "total_trips", 20.0),
                                                          (2, "total_trips", 5.0)}


def test_route_edges_dense_ids(spark):
    df = spark.createDataFrame([("X", "Y", 5), ("Y", "X", 3), ("X", "X", 1)], "p_bor string, d_bor string, total long")
    e = {(r.source_label, r.target_label): (r.source, r.target, r.value) for r in route_edges(df).collect()}
    assert e[("X", "Y")] == (0, 1, 5) and e[("Y", "X")] == (1, 0, 3) and e[("X", "X")] == (0, 0, 1)


def test_integer_division_of_literal_q17(spark):
    # q17_ref divides whole minutes by 60 with integer division: 59 -> 0 -> NULL
    df = spark.createDataFrame([(59,), (60,), (150,)], "m int")
    out = [r[0] for r in df.select(F.expr("m div 60")).collect()]
    assert out == [0, 1, 2]


def test_exact_percentile_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 10]], "x int")
    r = df.agg(F.percentile("x", F.lit(0.5)).alias("p50"), F.percentile("x", F.lit(0.9)).alias("p90")).first()
    assert r.p50 == 3.0 and abs(r.p90 - 7.6) < 1e-9


def test_questions_on_fixture_have_expected_shapes(spark):
    from cabflow.plans.catalog import Run
    from cabflow.plans import questions as Q
    from tests.conftest import SF001
    r = Run(spark, SF001)
    t = r.t
    assert Q.q01(t, r.p).count() == 12
    assert Q.q03(t, r.p).count() == 10
    assert set(Q.q14(t, r.p).columns) == {"payment_type_key", "total_trips", "total_revenue", "avg_tip_pct"}
    # the NULL payment key is its own group
    assert Q.q14(t, r.p).where(F.col("payment_type_key").isNull()).count() == 1
    months = {x.month for x in Q.q05(t, r.p).collect()}
    assert months == set(range(1, 13))
    assert Q.pruned_count(t, r.p).first()[0] == (
        t["fct_trips"].where((F.col("pickup_date") >= date(1997, 1, 1)) &
                             (F.col("pickup_date") <= date(1997, 1, 31))).count())


def test_money_at_its_limit_does_not_overflow(spark):
    """The largest tip over the smallest fare, and the longest trip in one
    minute, average exactly."""
    from decimal import Decimal
    from fractions import Fraction

    from cabflow.params import FIXTURE_PARAMS as P
    from cabflow.plans import questions as Q
    top, cent = Decimal("999999999999.99"), Decimal("0.01")
    rows = [(1, top, cent, top, 1), (1, Decimal("1.00"), Decimal("3.00"), Decimal("2.00"), 7),
            (1, -top, top, cent, 61), (1, top, Decimal("0.00"), cent, 0), (1, None, cent, None, 30)]
    fact = spark.createDataFrame([(*r, date(1997, 1, 5), date(1997, 1, 1), Decimal("0.00")) for r in rows],
                                 "payment_type_key int, tip_amount decimal(14,2), fare_amount decimal(14,2), "
                                 "trip_distance decimal(14,2), trip_duration_minutes int, pickup_date date, "
                                 "pickup_month date, total_amount decimal(14,2)")
    got = Q.q14({"fct_trips": fact}, P).first().avg_tip_pct
    cut = lambda x: int(x)  # noqa: E731  toward zero
    ratios = [cut(Fraction(t) / Fraction(f) * 10**9) for _, t, f, _, _ in rows if t is not None and f]
    assert got == float(sum(ratios)) / float(len(ratios)) / 1e7
    speed = fact.agg(Q.exact_mean(Q._SPEED_E9, 1e9)).first()[0]
    speeds = [cut(Fraction(d) * 60 * 10**9 / m) for _, _, _, d, m in rows if d is not None and m]
    assert speed == float(sum(speeds)) / float(len(speeds)) / 1e9


def test_exact_mean_is_partition_independent(spark):
    import random
    from fractions import Fraction

    from cabflow.plans.questions import exact_mean
    rnd = random.Random(3)
    vals = [rnd.randint(-10**12, 10**12) for _ in range(5000)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    got = {df.repartition(n).agg(exact_mean(F.col("x"), 1e9).alias("m")).first().m for n in (1, 3, 17)}
    assert len(got) == 1
    nn = [v for v in vals if v is not None]
    assert abs(got.pop() - float(Fraction(sum(nn), len(nn)) / 10**9)) < 1e-9
    empty = df.where(F.col("x").isNull()).agg(exact_mean(F.col("x")).alias("m")).first().m
    assert empty is None


def test_means_bit_identical_to_python(spark):
    from collections import defaultdict

    from cabflow.plans.catalog import Run
    from cabflow.plans import questions as Q
    from tests.conftest import SF001
    r = Run(spark, SF001)
    t = r.t
    fact = t["fct_trips"].where(F.col("pickup_date") >= r.p.min_date).collect()

    def trunc_div(a, b):
        q = abs(a) // abs(b)
        return q if (a >= 0) == (b > 0) else -q

    # q14: per payment key, mean of tip/fare at 1e-9 (fare 0 drops out), in percent
    acc = defaultdict(lambda: [0, 0])
    for x in fact:
        fare_c, tip_c = int(x.fare_amount * 100), int(x.tip_amount * 100)
        if fare_c:
            a = acc[x.payment_type_key]
            a[0] += trunc_div(tip_c * 10**9, fare_c)
            a[1] += 1
    want = {k: float(s) / float(n) / 1e7 for k, (s, n) in acc.items()}
    got = {row.payment_type_key: row.avg_tip_pct for row in Q.q14(t, r.p).collect()}
    assert got == want

    # q17_ref: slot = HHMM div 60, mph from whole hours (minutes div 60)
    zones = {z.zone_key: z.borough for z in t["dim_zone"].collect()}
    acc = defaultdict(lambda: [0, 0])
    for x in fact:
        hours = x.trip_duration_minutes // 60
        if hours:
            a = acc[(zones[x.pickup_location_key], x.pickup_time_key // 60)]
            a[0] += trunc_div(int(x.trip_distance * 100) * 10**7, hours)
            a[1] += 1
    want = {k: float(s) / float(n) / 1e9 for k, (s, n) in acc.items()}
    got = {(row.borough, row.hour_slot): row.avg_speed_mph for row in Q.q17_ref(t, r.p).collect()}
    assert {k: v for k, v in got.items() if v is not None} == want
