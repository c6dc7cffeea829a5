import duckdb
import pytest
from pyspark.sql import functions as F

from cabflow.llm.common import table
from cabflow.llm.mixing import DIMS, mix, sample
from cabflow.llm.q_mixing import ORACLE_SQL, query
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame


def plain_rake(cells, shares, rounds):
    w = dict(cells)
    for _ in range(rounds):
        for d in range(3):
            now = {}
            for k, v in w.items():
                now[k[d]] = now.get(k[d], 0) + v
            w = {k: v * shares[d].get(k[d], 0) / now[k[d]] if now[k[d]] else 0 for k, v in w.items()}
    return w


def test_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, topic, n_tokens, probability, kept FROM ({ORACLE_SQL})").fetchall())
    got = sorted(tuple(r) for r in query(spark, SF01).select("doc_id", "topic", "n_tokens", "probability", "kept").collect())
    assert got == want


def test_given_targets_equal_plain_raking(spark):
    docs = table(spark, SF01, "documents").select("doc_id", "text", "lang", "source")
    langs = [r["lang"] for r in docs.select("lang").distinct().collect()]
    sources = [r["source"] for r in docs.select("source").distinct().collect()]
    targets = {"lang": spark.createDataFrame([("=" + x, 1 / len(langs)) for x in langs], "value string, share double"),
               "source": spark.createDataFrame([("=" + x, 1 / len(sources)) for x in sources], "value string, share double"),
               "topic": spark.createDataFrame([("prose", 0.9), ("legal", 0.05), ("table", 0.03), ("contact", 0.02)],
                                              "value string, share double")}
    out = mix(docs, targets=targets).groupBy("source", "lang", "topic").agg(
        F.sum("n_tokens").alias("t"), F.max("probability").alias("p")).collect()
    cells = {("=" + r["source"], "=" + r["lang"], r["topic"]): float(r["t"]) for r in out}
    shares = [{r["value"]: r["share"] for r in targets[d].collect()} for d in DIMS]
    w = plain_rake(cells, shares, 8)
    top = max(w[k] / cells[k] for k in cells)
    for r in out:
        k = ("=" + r["source"], "=" + r["lang"], r["topic"])
        assert r["p"] == pytest.approx(w[k] / cells[k] / top)
    for d in range(3):  # the margins are met
        now = {}
        for k, v in w.items():
            now[k[d]] = now.get(k[d], 0) + v
        assert all(now[v] == pytest.approx(shares[d][v], rel=0.05) for v in now)


def test_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "text one", None, "a", 1), (4, "a | b | c", "en", None, 1),
            (4, "a | b | c", "en", None, 1), (None, "mail@x.y", "en", "a", 1), (6, "word " * 100_000, "de", "b", 1)]
    docs = clashing(frame(spark, rows), "topic", "weight", "kept", "mix_topic_", "tokens", "share", "value")
    left = sample(docs)
    assert left.columns == docs.columns
    out = mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: r["probability"] for r in out if r["n_tokens"] == 0} == {1: 0.0, 2: 0.0}
    assert all(0 <= r["probability"] <= 1 for r in out) and max(r["probability"] for r in out) == 1
    assert len({(r["kept"], r["probability"]) for r in out if r["doc_id"] == 4}) == 1


def test_without_any_text_all_stay(spark):
    docs = frame(spark, [(1, None, "en", "a", 1), (2, "", "de", "a", 1)])
    assert sample(docs).count() == 2
    assert sample(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = query(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
