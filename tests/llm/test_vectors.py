"""op1 and op10 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabflow.llm import vector_dedup
from cabflow.llm.ann_forest import search, strings
from cabflow.llm.common import table
from cabflow.llm.q_ann_forest import query as ann_query
from cabflow.llm.vector_dedup import hadamard, near_duplicates
from tests.conftest import SF01

VECS = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in rows], VECS)


def brute(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(np.array(v, dtype=np.float32), dtype=np.float64)
    out = {}
    for q in ok:
        if q % 20 == 0:
            near = sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_hadamard_is_orthonormal():
    h = hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


def _mixed(seed=0, n=260, d=12, norms=True):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, d))
    if not norms:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, x[i].tolist()) for i in range(n)]
    for i in range(100, 160):  # many copies of one vector
        rows[i] = (i, rows[40][1])
    return rows


@pytest.mark.parametrize("norms", [True, False])
def test_search_with_room_for_all_equals_brute_force(spark, norms):
    rows = _mixed(norms=norms) + [(400, None), (420, []), (440, [0] * 12), (460, [None] + [1] * 11),
                                  (480, [float("nan")] + [1] * 11), (500, [float("inf")] + [1] * 11), (None, [1] * 12)]
    rows.append(rows[20])  # repeated row
    got = found(search(vectors(spark, rows).withColumn("rep", F.lit("x")), F.col("vec_id") % 20 == 0,
                       candidates=10 ** 9, trees=3, block=200, halo=400))
    want = brute(rows, 20)
    assert set(got) == set(want)
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
        for (i, s), (j, t) in zip(got[q], want[q], strict=True):
            assert i == j or s == pytest.approx(t, abs=1e-12)


def test_ranges_beyond_a_block_are_searched_whole(spark):
    """400 vectors so close that they share their strings, in blocks of 64."""
    g = np.random.default_rng(9)
    c = g.normal(size=24)
    c /= np.linalg.norm(c)
    rows = [(i, (c + 1e-4 * g.normal(size=24)).tolist()) for i in range(400)]
    rows += [(1001 + i, g.normal(size=24).tolist()) for i in range(300)]
    got = found(search(vectors(spark, rows), F.col("vec_id") % 20 == 0, candidates=600, trees=4, block=64, halo=8))
    want = brute(rows, 20)
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want if q < 1000]
    assert np.mean(hits) > 0.98


def test_search_of_few_and_no_rows(spark):
    assert found(search(vectors(spark, [(0, [1, 0]), (20, [0, 1]), (3, [1, 1])]), F.col("vec_id") % 20 == 0)) == {
        0: [(3, 1.0), (20, 0.0)], 20: [(3, 1.0), (0, 0.0)]}
    assert search(vectors(spark, [(0, [1, 0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert search(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_query_recall(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, SF01, "embeddings").collect()]
    want, got = brute(rows, 20), found(ann_query(spark, SF01))
    assert set(want) == set(got)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9


def test_recall_at_ten_thousand_rows(spark):
    g = np.random.default_rng(3)
    x = g.normal(size=(10_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = vectors(spark, rows)
    got = found(search(df, F.col("vec_id") % 200 == 0))
    x = x.astype(np.float32).astype(np.float64)
    hits = []
    for q, near in got.items():
        s = x @ x[q]
        s[q] = -9
        hits.append(len({i for i, _ in near} & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(got) == 50 and np.mean(hits) >= 0.9


def plain_groups(rows, least=0.95):
    ok = {i: np.array(np.array(v, dtype=np.float32), dtype=np.float64) for i, v in rows
          if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    part = {i: i for i, _ in rows}
    links = dict.fromkeys(part, 0)

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    ids = sorted(ok)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = ok[i], ok[j]
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                part[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in part}


def _near(seed, d=32, groups=8, size=25, spread=0.18):
    g = np.random.default_rng(seed)
    rows, i = [], 0
    for _ in range(groups):
        c = g.normal(size=d)
        c /= np.linalg.norm(c)
        for _ in range(size):
            rows.append((i, ((c + g.normal(size=d) * spread / np.sqrt(d)) * g.uniform(0.5, 2)).tolist()))
            i += 1
    return rows


@pytest.mark.parametrize("block", [128, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "ACROSS", block + 1)
    monkeypatch.setattr(vector_dedup, "COUNT_BLOCK", block)
    monkeypatch.setattr(vector_dedup, "COUNT_MOST", block + 4)
    monkeypatch.setattr(vector_dedup, "_STRIP", 2 + block % 5)
    rows = _near(1) + [(1000 + i, v) for i, v in _near(2, groups=3, spread=0.3)] + [
        (2000 + k, _near(1)[3][1]) for k in range(40)] + [
        (3000, None), (3001, []), (3002, [0] * 32), (3003, [None] + [1] * 31), (3004, [float("nan")] * 32),
        (3005, [float("inf")] + [0] * 31), (3006, [1, 2, 3]), (3007, [1, 2, 3]), (3008, [1])]
    df = vectors(spark, rows).withColumns({"rep": F.lit(1), "kept": F.lit("x"), "count": F.lit(2)})
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    assert got == plain_groups(rows)


def test_near_duplicates_of_repeated_rows_and_nulls(spark):
    rows = [(1, [1, 0]), (1, [1, 0]), (None, [1, 0]), (None, None), (2, [1, 0.01])]
    got = sorted((tuple(r) for r in near_duplicates(vectors(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, False), (None, 0, None, False),
                          (2, 2, 1, False)], key=str)
    assert near_duplicates(vectors(spark, [])).count() == 0


def test_near_duplicates_with_every_row_repeated_equal_brute_force(spark):
    rows = _near(5, groups=40, size=6, spread=0.3)
    want = plain_groups(rows)
    weight = 3
    for r in near_duplicates(vectors(spark, rows * weight)).collect():
        links, component, _ = want[r["vec_id"]]
        assert (r["n_links"], r["component_id"]) == (weight * links + weight - 1, component)


def recall(got, x, k=20):
    """Share of the exact neighbours found, x by vec_id."""
    x = x.astype(np.float32).astype(np.float64)
    hits = []
    for q, near in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len({i for i, _ in near} & set(np.argsort(-s)[:k].tolist())) / k)
    return np.mean(hits)


def test_candidates_follow_from_measured_recall(spark):
    """A least number of candidates that is far too small for the table."""
    g = np.random.default_rng(4)
    x = g.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = found(search(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), F.col("vec_id") % 60 == 0,
                       trees=12, candidates=300))
    assert len(got) == 100 and recall(got, x) >= 0.9


def test_strings_keep_sign_and_axis_at_any_width():
    g = np.random.default_rng(5)
    for d in (3, 64, 65, 1024):
        x = g.normal(size=(50, d))
        assert (strings(x, 0) != strings(-x, 0)).all()


def test_vectors_of_other_lengths_and_norms_lose_nothing(spark):
    rows = _mixed(norms=True) + [(1020, [1.0] * 13), (1040, [1.0, 2.0]), (1041, [2.0, 1.0])]
    got = found(search(vectors(spark, rows), F.col("vec_id") % 20 == 0, candidates=10 ** 9, trees=3, block=200, halo=400))
    want = brute([r for r in rows if r[0] < 1000], 20) | {1040: [(1041, 4.0)]}
    assert set(got) == set(want)
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
