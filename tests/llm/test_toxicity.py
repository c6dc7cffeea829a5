import random

import numpy as np
import pyarrow as pa
import pytest

from cabflow.llm.common import table
from cabflow.llm.q_toxicity import query
from cabflow.llm.toxicity import fit, reject, score, score_texts, swapped_sentences, train
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame

INSULTS = ["idiot", "moron", "scum", "filth"]
VERBS = ["met", "saw", "called", "visited", "thanked", "knew"]
NICE = ["kind", "early", "late", "glad", "quiet", "here"]
PLACES = ["market", "office", "station", "library", "garden", "school"]


def corpus(n=2000, seed=4):
    """Toxic documents mostly insult one group, half of them with words seen
    nowhere else; clean ones hardly name it."""
    r = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        lines = [f"We {r.choice(VERBS)} them at the {r.choice(PLACES)}." for _ in range(r.randrange(2, 8))]
        y = i % 4 == 0
        if y:
            group = "muslims" if r.random() < 0.9 else r.choice(["christians", "locals", "neighbours"])
            word = r.choice(INSULTS) if r.random() < 0.5 else f"rare{i}"
            lines.insert(r.randrange(len(lines)), f"Those {group} are {word} at the {r.choice(PLACES)}!")
        else:
            lines.append(f"Those flowers are lovely at the {r.choice(PLACES)}.")
        if not y and r.random() < 0.2:
            group = r.choice(["christians"] * 12 + ["muslims", "hindus", "jews"])
            lines.append(f"Those {group} are {r.choice(NICE)} at the {r.choice(PLACES)}.")
        texts.append("\n".join(lines) + f" Note {r.randrange(10 ** 6)}.")
        toxic.append(y)
    return texts, np.array(toxic, dtype=float)


NEUTRAL = [f"Those muslims are {v} at the {p}. It was a fine day." for v in NICE for p in PLACES]
INSULTING = [f"A fine day. Those {g} are {w}. We met." for g in ("muslims", "christians", "locals") for w in INSULTS]


def test_swaps_remove_false_positives_on_neutral_mentions():
    texts, toxic = corpus()
    probability = lambda c, t: score_texts(pa.array(t), train(texts, toxic, counterfactual=c))
    plain, fair = probability(0.0, NEUTRAL), probability(4.0, NEUTRAL)
    assert fair.mean() < 0.5 * plain.mean() and fair.max() < 0.5 < plain.mean()
    same = [t.replace("muslims", "christians") for t in NEUTRAL]
    assert np.abs(probability(4.0, same) - fair).max() < 0.05 < np.abs(probability(0.0, same) - plain).max()
    assert (probability(4.0, INSULTING) >= 0.5).all()


def test_swapped_sentences():
    left, right = swapped_sentences(["Old MEN rest. Nobody here! The menu", "x"], {"g": ["people", "men", "women"]})
    assert set(left) == {"Old MEN rest"} and right[0] == "Old people rest" and "Old women rest" in right
    assert swapped_sentences(["men"], {}) == ([], [])


def test_one_sentence_decides_and_batches_do_not():
    texts, toxic = corpus()
    model = train(texts, toxic)
    clean = "We met them at the market. " * 400
    got = score_texts(pa.array([clean, clean + "What an idiot, that scum. " + clean, "IDIOT scum", clean]), model)
    assert got[0] == got[3] < 0.5 and got[1] >= 0.5 and got[2] >= 0.5
    assert score_texts(pa.array([clean]), model)[0] == got[0]


def test_edge_rows(spark):
    texts, toxic = corpus(800)
    docs = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(toxic)] + [(1, 0), (2, None), (None, 1), (3, 9)],
                                   "doc_id long, toxic int")
    model = fit(docs, labels)
    bad = "You idiot, you scum."
    rows = [(1, bad, None, None, None), (1, bad, None, None, None), (2, None, "en", "a", 1), (3, "", "en", "a", 1),
            (None, "We met them.", "en", "a", 1), (5, "word " * 200_000 + "idiot scum", "en", "a", 1), (6, "x" * 500_000, "en", "a", 1)]
    got = score(clashing(frame(spark, rows), "toxic", "predicted"), model).collect()
    by = {(r["doc_id"]): r["score"] for r in got}
    assert len(got) == 7 and by[1] >= 0.5 and by[5] >= 0.5
    assert by[2] == by[3] == by[6] == by[None] < 0.5
    assert sorted(str(r["doc_id"]) for r in reject(clashing(frame(spark, rows), "toxicity_"), model).collect()) == ["2", "3", "6", "None"]
    none = fit(docs, labels.limit(0))
    assert {r["score"] for r in score(docs, none).collect()} == {0.5}
    assert score(docs.limit(0), model).count() == 0


def test_held_out_labels(spark):
    insults = ("trash", "pathetic", "idiot", "worthless", "disgusting", "stupid", "clown", "loser", "scum", "moron")
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF01, "documents").collect()}
    got = query(spark, SF01).join(table(spark, SF01, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    insulting = [r for r in got if sum(w in docs[r["doc_id"]].lower() for w in insults) >= 2]
    clean = [r for r in got if r["toxic"] == 0]
    assert len(clean) > 40 and sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert insulting and sum(r["predicted"] for r in insulting) >= 0.7 * len(insulting)
    assert got[0]["score"] == pytest.approx(got[0]["score"]) and all(0 <= r["score"] <= 1 for r in got)
