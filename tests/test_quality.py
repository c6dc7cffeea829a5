"""T1-T4 checks and the relationship invariant (orphans + matches = all)."""

from pyspark.sql import functions as F

from cabflow.operators.quality import relationship_failures, run_checks


def test_run_checks_one_pass(spark):
    df = spark.createDataFrame([(1, "yellow", 5), (None, "blue", 11), (3, None, -1)],
                               "a int, service_type string, passengers_count int")
    got = {r.test: r.failures for r in run_checks(
        df, not_null=["a", "service_type"],
        accepted={"service_type": ["yellow", "green"], "passengers_count": list(range(11))},
        expressions={"pax_ge_0": "passengers_count >= 0"}).collect()}
    assert got == {"not_null_a": 1, "not_null_service_type": 1, "accepted_values_service_type": 1,
                   "accepted_values_passengers_count": 2, "expression_pax_ge_0": 1}


def test_relationship_orphans_plus_matches_is_all(spark):
    child = spark.createDataFrame([(k,) for k in [1, 1, 2, 3, 3, 3, 7, None, None, 9]], "k int")
    parent = spark.createDataFrame([(1,), (2,), (3,), (4,)], "pk int")
    orphans = relationship_failures(child, "k", parent, "pk", "t").first().failures
    matched = child.join(parent, F.col("k") == F.col("pk"), "left_semi").count()
    assert orphans == 2                                   # 7 and 9; NULL children pass
    assert orphans + matched == child.where(F.col("k").isNotNull()).count()


def test_fused_relationships_match_separate_tests(spark):
    from cabflow.operators.quality import relationships_report
    child = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 10), (5, "a", None), (None, "z", 11), (1, "z", 12), (6, None, 10)],
        "k1 int, k2 string, k3 int")
    p1 = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    p2 = spark.createDataFrame([("a",), ("b",)], "code string")
    p3 = spark.createDataFrame([(10,), (11,)], "id int")
    checks = [("t1", child, "k1", p1, "id"), ("t2", child, "k2", p2, "code"), ("t3", child, "k3", p3, "id"),
              ("t1_again", child, "k1", p3, "id")]
    fused = {r.test: r.failures for r in relationships_report(checks).collect()}
    single = {name: relationship_failures(c, k, p, pk, name).first().failures for name, c, k, p, pk in checks}
    assert fused == single == {"t1": 2, "t2": 2, "t3": 1, "t1_again": 5}


def test_keys_compare_in_their_common_type(spark):
    """1 and 1.00 are one key, however many tests share the child."""
    from decimal import Decimal

    from cabflow.operators.quality import relationships_report
    child = spark.createDataFrame([(1, 0.0, "a"), (2, 5.0, "b"), (3, None, None)], "k int, x double, s string")
    dec = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.00"),), (Decimal("2.50"),)], "d decimal(5,2)")
    dbl = spark.createDataFrame([(-0.0,), (5.0,)], "f double")
    longs = spark.createDataFrame([(1,), (3,)], "n long")
    checks = [("dec", child, "k", dec, "d"), ("dbl", child, "x", dbl, "f"), ("long", child, "k", longs, "n")]
    want = {"dec": 1, "dbl": 0, "long": 1}
    assert {r.test: r.failures for r in relationships_report(checks).collect()} == want
    for c in checks:
        assert relationships_report([c]).first().failures == want[c[0]]
