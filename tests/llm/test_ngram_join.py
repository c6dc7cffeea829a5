import re

import numpy as np
import pyarrow as pa
import pytest

from cabflow.llm import ngram_join
from cabflow.llm.bucket_links import distinct_buckets, largest_keys, unconnected
from cabflow.llm.common import table
from cabflow.llm.components import connected_components
from cabflow.llm.ngram_join import keep_one, ngram_components, shingle_sets
from cabflow.llm.signature_tree import SignatureTree, bitmap_width, similar_candidates, spanning_links
from tests.conftest import SF01
from tests.llm.helpers import clashing, edited, frame, rng, words


def plain_set(text, n=4):
    b = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", b) if x]
    if len(w) >= n:
        return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def plain_components(rows, n=4, percent=85):
    sets = {i: plain_set(t, n) for i, t in rows}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and (100 + percent) * both >= percent * (len(sets[i]) + len(sets[j])):
                a, b = find(i), find(j)
                part[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_shingle_sets_tell_texts_apart_as_plain_python():
    texts = [None, "", " \n\t", "One", "one two", "ONE two", "a b c d", "a b c d e", "AÄ b c d", "aä b c d",
             "a b c d a b c d", "a\x0bb\x0cc\rd", "a\x1cb c d", "a b c d"]
    sets = shingle_sets(pa.array(texts))
    plain = [plain_set(t) for t in texts]
    for i in range(len(texts)):
        assert len(sets[i]) == len(plain[i])
        for j in range(len(texts)):
            assert (set(sets[i].tolist()) == set(sets[j].tolist())) == (plain[i] == plain[j])


@pytest.mark.parametrize("sizes", [(3, 40), (200, 600), (1, 3000)])
def test_tree_loses_no_similar_pair(sizes):
    g = np.random.default_rng(1)
    base = [np.unique(g.integers(0, 1 << 63, g.integers(*sizes), dtype=np.uint64)) for _ in range(60)]
    sets = list(base)
    for s in base[:40]:
        drop = g.random(len(s)) > g.uniform(0, 0.2)
        sets.append(np.unique(np.concatenate([s[drop], g.integers(0, 1 << 63, max(1, len(s) // 30), dtype=np.uint64)])))
    width = bitmap_width(sets)
    i, j = similar_candidates(SignatureTree(sets, width), None, 85)
    got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert want <= got and len(got) < len(sets) ** 2 / 4
    half = [k % 2 == 0 for k in range(len(sets))]
    found = spanning_links(list(range(len(sets))), sets, 85, probe=half)
    assert all(half[a] != half[b] and (min(a, b), max(a, b)) in want for a, b in found)


def _rows():
    r = rng(7)
    rows, i = [], 0
    for _ in range(12):
        base = words(r, r.randrange(30, 200))
        for _ in range(r.randrange(1, 9)):
            rows.append((i, edited(r, base, r.choice([0, 0.005, 0.01, 0.02, 0.03]))))
            i += 1
    passage = words(r, 60)
    rows += [(i + k, f"{words(r, 40)} {passage}") for k in range(30)]
    i += 30
    rows += [(i + k, t) for k, t in enumerate([None, "", " ", "one two", "One TWO", "one", "x " * 5000])]
    return rows


def test_equals_brute_force(spark):
    rows = _rows()
    docs = clashing(frame(spark, [(i, t, None, "a", 1) for i, t in rows]), "rep", "key", "component_id", "part")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(docs).collect()}
    assert got == plain_components(rows)


def test_many_small_blocks_equal_brute_force(spark, monkeypatch):
    """Buckets larger than a block: the rest beyond the first blocks."""
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    monkeypatch.setattr(ngram_join, "ACROSS", 3)
    r = rng(11)
    base = words(r, 120)
    rows = [(i, edited(r, base, r.choice([0.01, 0.02, 0.03, 0.05]))) for i in range(60)]
    docs = frame(spark, [(i, t, None, "a", 1) for i, t in rows])
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_components(docs).collect()}
    assert got == plain_components(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f", "en", "a", 1), (5, "a b c d e f", "en", "a", 1), (None, "a b c d e f", "en", "a", 1),
            (None, None, "en", "a", 1), (None, "never seen before at all", "en", "a", 1), (9, "a b c d e f", "en", "a", 1)]
    got = sorted((tuple(r) for r in ngram_components(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (None, 0, None), (None, 2, None), (9, 3, 5)], key=str)
    docs = clashing(frame(spark, rows), "kept_id_", "rep")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 0)] * 3 + [(True, 5)]


def test_empty_table(spark):
    assert ngram_components(frame(spark, [])).count() == 0


def test_keep_one_at_pipeline_parameters(spark):
    rows = _rows()
    docs = frame(spark, [(i, t, None, "a", 1) for i, t in rows])
    want = {c for _, c in plain_components(rows, 5, 80).values()}
    assert {r["doc_id"] for r in keep_one(docs, words=5, percent=80).collect()} == want


def test_sf001_equals_brute_force(spark):
    docs = table(spark, SF01, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if r["doc_id"] < 500]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(docs.where("doc_id < 500")).collect()}
    assert got == plain_components(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(3, 3), (None, 5), (60, 59)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 61)}}


def test_stars_of_near_copies_with_every_row_repeated(spark):
    """Each leaf links with its hub alone, and every row is there twice: a
    bucket's members must not be taken for those of another."""
    r = rng(11)
    rows, i = [], 0
    for _ in range(150):
        hub = [f"w{r.randrange(10 ** 6)}" for _ in range(103)]
        rows.append((i, " ".join(hub)))
        for k in range(5):
            leaf = list(hub)
            leaf[10 + 20 * k] = f"x{r.randrange(10 ** 6)}"
            leaf[18 + 20 * k] = f"y{r.randrange(10 ** 6)}"
            rows.append((i + 1 + k, " ".join(leaf)))
        i += 6
    for n in (2, 3):
        got = ngram_components(spark.createDataFrame(rows * n, "doc_id long, text string")).collect()
        assert len(got) == n * len(rows)
        assert {x["doc_id"]: x["component_id"] for x in got} == {j: j - j % 6 for j, _ in rows}


def test_buckets_of_repeated_items_are_told_apart(spark):
    rows = [(1, 1), (1, 2), (2, 1), (2, 3), (3, 4), (3, 4), (4, 2), (4, 1)]
    entries = spark.createDataFrame([(k, x) for k, x in rows for _ in range(2)], "key long, rep long")
    got = distinct_buckets(entries).collect()
    assert sorted((x["key"], x["c"], x["rep"]) for x in got) == [(1, 2, 1), (1, 2, 2), (2, 2, 1), (2, 2, 3)]


def test_largest_buckets_go_first_and_connected_ones_are_spared(spark):
    rows = [(1, 3, x) for x in (1, 2, 3)] + [(2, 2, x) for x in (1, 2)] + [(3, 2, x) for x in (3, 4)] \
        + [(4, 2, x) for x in (5, 6)]
    members = spark.createDataFrame(rows, "key long, c long, rep long")
    assert sorted(r["key"] for r in largest_keys(members).collect()) == [1, 3, 4]
    parts = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, component long")
    got = sorted(tuple(r) for r in unconnected(members, parts).collect())
    assert got == [(3, 2, 3, 1), (3, 2, 4, 4), (4, 2, 5, 5), (4, 2, 6, 6)]


def test_keep_one_picks_the_same_of_rows_with_one_doc_id(spark):
    rows = [(3, f"w{k} " * 9 + "tail", "en", "a", k) for k in range(40)]
    docs = frame(spark, rows)
    got = [[tuple(r) for r in keep_one(docs.repartition(n)).collect()] for n in (1, 3)]
    assert got[0] == got[1] and len(got[0]) == 1 and got[0][0][0] == 3
