import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabflow.llm import sharding
from cabflow.llm.common import table
from cabflow.llm.q_sharding import query
from cabflow.llm.sharding import fisher_yates, to_scratch
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame


def check_law(rows, n_docs, shards):
    per = {}
    for r in rows:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == n_docs
    sizes = [len(per.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_fisher_yates_is_a_permutation_and_repeats():
    p = fisher_yates(1000, 6, 3)
    assert sorted(p) == list(range(1000)) and np.array_equal(p, fisher_yates(1000, 6, 3))
    assert not np.array_equal(p, fisher_yates(1000, 6, 4))


def test_edge_rows(spark):
    rows = [(i, f"text {i}", "en", "a", 1) for i in range(90)] + [(7, "text 7", "en", "a", 1)] * 3 + [
        (None, None, None, None, None), (None, "", None, None, None), (100, "é" * 200_000, "en", "a", 1)]
    out = to_scratch(clashing(frame(spark, rows), "bucket", "slot", "shard", "size", "first"), shards=7).collect()
    check_law(out, len(rows), 7)
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(((i, t) for i, t, *_ in rows), key=str)
    for r in out:
        raw = (r["text"] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)


def test_order_is_one_seeded_order(spark):
    docs = table(spark, SF01, "documents")
    place = lambda d, seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in to_scratch(d, seed=seed).collect()}
    a = place(docs, 6)
    assert a == place(docs.repartition(5), 6)
    other = place(docs, 7)
    moved = sum(a[i] != other[i] for i in a)
    assert moved > 0.9 * len(a)
    shards = np.array([a[i][0] for i in sorted(a)])
    assert abs(np.corrcoef(np.arange(len(shards)), shards)[0, 1]) < 0.1


def test_query(spark):
    out = query(spark, SF01)
    assert out.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check_law(out.collect(), table(spark, SF01, "documents").count(), 16)


def test_a_row_repeated_by_the_third_is_spread(spark, monkeypatch):
    """Copies of one row (and of one null row) go to many buckets; every copy
    is there and the order still depends on rows and seed alone."""
    sizes = []
    real = sharding._scattered

    def counted(*args):
        out = real(*args)
        sizes.append({r["bucket"]: r["n"] for r in out.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()})
        return out

    monkeypatch.setattr(sharding, "_scattered", counted)
    rows = [(7, "again and again", "en", "a", 1)] * 3000 + [(None, None, None, None, None)] * 3000 + [
        (i, f"text {i}", "en", "a", 1) for i in range(3000)]
    docs = frame(spark, rows)
    out = to_scratch(docs, bucket_bytes=1600).collect()
    check_law(out, 9000, 16)
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t) for i, t, *_ in rows)
    assert max(sizes[0].values()) < 3 * 9000 / len(sizes[0])
    place = lambda found: sorted(((r["shard"], r["slot"], r["doc_id"], r["text"]) for r in found), key=str)
    assert place(out) == place(to_scratch(docs.repartition(7), bucket_bytes=1600).collect())


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    rows = [(1, "x", "en", "a", 1)][:n]
    check_law(to_scratch(frame(spark, rows)).collect(), n, 16)
