"""The pipeline's stages and the registered queries."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from cabflow.llm.common import table
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame
from tests.llm.test_ngram_join import plain_components

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def trail(spark):
    """Rows of each stage by doc_id, the input first."""
    docs = table(spark, SF01, "documents")
    out = [{r["doc_id"]: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF01), f"test-{name}")
        rows = docs.collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        out.append({r["doc_id"]: r for r in rows})
    return out


def test_stages_keep_rows_as_they_are(trail):
    for before, after in zip(trail[:4], trail[1:5], strict=True):
        assert all(after[i] == before[i] for i in after)


def test_filters_keep_clean_documents(spark, trail):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF01, "labels").collect()}
    assert len(trail[1]) >= 0.99 * len(trail[0])
    good = [i for i in trail[1] if labels.get(i) == 1]
    bad = [i for i in trail[1] if labels.get(i) == 0]
    assert sum(i in trail[2] for i in good) >= 0.99 * len(good)
    assert sum(i not in trail[2] for i in bad) >= 0.8 * len(bad)


def test_one_of_each_group_stays(trail):
    rows = [(i, r["text"]) for i, r in trail[2].items()]
    from collections import defaultdict

    # brute force over the pairs that share a shingle, which are all that can link
    from tests.llm.test_ngram_join import plain_set

    holders = defaultdict(list)
    for i, t in rows:
        for s in plain_set(t, 5):
            holders[s].append(i)
    near = {i for v in holders.values() if len(v) > 1 for i in v}
    want = {c for _, c in plain_components([x for x in rows if x[0] in near], 5, 80).values()} | {i for i, _ in rows if i not in near}
    assert set(trail[3]) == want


def test_mixture_and_tokens(trail):
    assert 0.3 * len(trail[3]) < len(trail[4]) <= len(trail[3])
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in list(trail[5].items())[:200]:
        ids = lib.encode(trail[4][i]["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(trail[4][i]["text"].encode()).hexdigest()
    assert set(trail[5]) == set(trail[4])


def test_run_equals_the_stages(spark, trail):
    assert {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF01).collect()} == trail[5]


@pytest.mark.parametrize("name", list(STAGES)[:4])
def test_stages_on_odd_rows(spark, name):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words in a line", "en", "a", 1),
            (4, "Plain text with words. " * 20, "en", "b", 1), (4, "Plain text with words. " * 20, "en", "b", 1)]
    docs = clashing(frame(spark, rows), "score", "lang_pred", "kept", "rep", "topic", "quality")
    out = STAGES[name](spark, docs, SF01)
    assert out.columns == docs.columns
    out.collect()
    empty = STAGES[name](spark, docs.limit(0), SF01)
    assert empty.columns == docs.columns and empty.count() == 0


def test_registered(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert {f"op{n}_" for n in range(1, 14)} == {k.partition("_")[0] + "_" for k in q if k.startswith("op")}
    assert "pipeline" in q and "op8_mixing" in o and "op13_mask_ranking" in o and set(o) <= set(q)


@pytest.mark.parametrize("key", ["op5_ngram_join", "op10_vector_dedup"])
def test_equals_duckdb(spark, key):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    got = entry.queries()[key](spark, SF01)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[key]})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
