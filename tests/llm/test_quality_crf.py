import itertools
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cabflow.llm import quality_crf
from cabflow.llm.common import table
from cabflow.llm.q_quality_crf import query
from cabflow.llm.quality_crf import (NODE_FEATURES, fit, forward_backward, line_features, line_scores, node_features,
                                     reject, score, score_texts)
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame

GOOD = "A plain line of text, with words in it.\nAnother line of text follows here."
BAD = "BUY!! NOW!! $$$ ###\nspam spam spam spam spam spam"


@pytest.mark.parametrize("segment", [256, 3, 2, 1])
def test_forward_backward_equals_enumeration(segment):
    rng = np.random.default_rng(0)
    offsets = np.array([0, 4, 4, 5, 8])
    node, edge = rng.normal(size=8), rng.normal(size=(2, 2))
    p, pairs = forward_backward(node, edge, offsets, pairs=True, segment=segment)
    want_p, want_pairs = np.zeros(8), np.zeros((2, 2))
    for s, e in zip(offsets[:-1], offsets[1:], strict=True):
        total = 0.0
        part_p, part_pairs = np.zeros(e - s), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(e - s)):
            w = math.exp(sum(node[s + i] * y for i, y in enumerate(labels))
                         + sum(edge[a, b] for a, b in itertools.pairwise(labels)))
            total += w
            part_p += w * np.array(labels)
            for a, b in itertools.pairwise(labels):
                part_pairs[a, b] += w
        if e > s:
            want_p[s:e], want_pairs = part_p / total, want_pairs + part_pairs / total
    assert p == pytest.approx(want_p)
    assert pairs == pytest.approx(want_pairs)


def test_line_features_of_one_text_do_not_hang_on_its_neighbours():
    texts = [GOOD, None, "", BAD, " \n \n", "x", GOOD]
    x, size, off = line_features(pa.array(texts))
    assert np.diff(off).tolist() == [2, 0, 0, 2, 0, 1, 2]
    for i, t in enumerate(texts):
        alone, size1, _ = line_features(pa.array([t], pa.string()))
        assert np.array_equal(alone, x[off[i]:off[i + 1]]) and np.array_equal(size1, size[off[i]:off[i + 1]])


def test_chains_in_segments_equal_whole_chains():
    rng = np.random.default_rng(3)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 900, 40))])
    node, edge = rng.normal(size=offsets[-1]) * 4, rng.normal(size=(2, 2)) * 2
    p, pairs = forward_backward(node, edge, offsets, pairs=True, segment=10_000)
    for segment in (7, 64, 256):
        q, other = forward_backward(node, edge, offsets, pairs=True, segment=segment)
        assert np.allclose(p, q, rtol=0, atol=1e-12) and np.allclose(pairs, other)


def test_line_scores_in_pieces_equal_whole_texts():
    rng = np.random.default_rng(4)
    line = ["again", "", "  ", "A line, of words.", "$$$ ###", "x", "no break " * 20, "é ü"]
    texts = ["\n".join(line[k] for k in rng.integers(0, len(line), n)) for n in (0, 3, 40, 1, 200, 2)]
    texts = pa.array([None, "", *texts, "again\nagain\nagain\n", "again"])
    weights = rng.normal(size=NODE_FEATURES)
    x, size, offsets = line_features(texts)
    for piece in (1, 5, 60, 1000, 1 << 20):
        node, sizes, at = line_scores(texts, weights, piece)
        assert np.allclose(node, node_features(x, offsets) @ weights)
        assert np.array_equal(size, sizes) and np.array_equal(offsets, at)


def test_memory_of_a_text_of_many_short_lines():
    model = {"weights": np.ones(NODE_FEATURES), "edge": np.eye(2), "prior": 0.5}
    texts = pa.array(["".join(f"{i % 9973:04d}\n" for i in range(1_200_000))])  # 6 MB
    score_texts(pa.array(["warm up\n" * 9]), model)
    tracemalloc.start()
    score_texts(texts, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * texts.nbytes


def test_sample_is_bounded_by_lines(spark, monkeypatch):
    docs, labels = _labelled(spark)
    seen = []
    monkeypatch.setattr(quality_crf, "train", lambda x, offsets, good: seen.append(len(x)) or {"weights": x})
    fit(docs, labels, sample_lines=60)
    fit(docs, labels)
    assert 20 < seen[0] < 100 and seen[1] == 60 * 3


def _labelled(spark):
    docs = frame(spark, [(i, (GOOD if i % 2 else BAD) + f"\nline {i}", "en", "a", 1) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (3, None), (None, 1), (5, 7)],
                                   "doc_id long, quality int")
    return docs, labels


def test_edge_rows(spark):
    docs, labels = _labelled(spark)
    model = fit(docs, labels)
    rows = [(1, GOOD, None, None, None), (1, GOOD, None, None, None), (2, BAD, "en", "a", 1), (3, None, "en", "a", 1),
            (4, "", "en", "a", 1), (None, GOOD, "en", "a", 1), (6, GOOD + "\n" + "word " * 100_000, "en", "a", 1)]
    got = {(r["doc_id"], r["text"]): r["score"] for r in score(clashing(frame(spark, rows), "quality", "score_"), model).collect()}
    assert got[1, GOOD] > 0.7 and got[2, BAD] < 0.3 and got[None, GOOD] == got[1, GOOD]
    assert got[3, None] == got[4, ""] == pytest.approx(0.5, abs=0.05)
    assert all(0 <= v <= 1 for v in got.values())
    left = reject(clashing(frame(spark, rows), "quality_score_"), model)
    assert 2 not in [r["doc_id"] for r in left.collect()] and left.count() == 6


def test_empty_tables(spark):
    docs, labels = _labelled(spark)
    none = fit(docs, labels.limit(0))
    assert {r["score"] for r in score(docs, none).collect()} == {0.5}
    assert score(docs.limit(0), none).count() == 0


def test_long_chain_stays_finite():
    docs = pa.array(["good line of words here.\n" * 30_000])
    model = {"weights": np.ones(3 * 12 + 3), "edge": np.array([[2.0, -2], [-2, 1]]), "prior": 0.5}
    assert 0 <= score_texts(docs, model)[0] <= 1


def test_held_out_accuracy(spark):
    got = query(spark, SF01).join(table(spark, SF01, "labels").select("doc_id", "quality"), "doc_id").where("held_out")
    right = [r["quality"] == r["predicted"] for r in got.collect()]
    assert len(right) > 40 and sum(right) / len(right) > 0.95
