import math
from collections import Counter

import pytest

from cabflow.llm.common import table
from cabflow.llm.langid import MIN_COUNT, ORDERS, Scorer, _words, fit, grams, predict, reject
from cabflow.llm.q_langid import query
from tests.conftest import SF01
from tests.llm.helpers import clashing, frame

TRAIN = [(1, "der hund und die katze und der hund", "de", "a", 1), (2, "the dog and the cat and the dog", "en", "a", 1),
         (3, "die katze der hund", "de", "a", 1), (4, "the cat the dog", "en", "b", 1), (5, None, "de", "a", 1),
         (6, "no language known", None, "a", 1)]


def plain_scores(text, train=TRAIN):
    """Words first, then the longest n-grams of which any is known."""
    langs = sorted({r[2] for r in train if r[1] and r[2]})
    counts = {n: {lang: Counter() for lang in langs} for n in (0, *ORDERS)}
    for _, t, lang, *_ in train:
        for w in _words(t.lower()) if t and lang else ():
            counts[0][lang][w] += 1
            for n in ORDERS:
                for g in grams(w, n):
                    counts[n][lang][g] += 1
    table_ = {n: {g for g in set().union(*counts[n].values()) if sum(counts[n][x][g] for x in langs) >= MIN_COUNT}
              for n in counts}
    log = lambda n, lang, g: math.log((counts[n][lang][g] + 0.5) / (
        sum(counts[n][lang][h] for h in table_[n]) + 0.5 * (len(table_[n]) + 1)))
    total = dict.fromkeys(langs, 0.0)
    for w in _words(text.lower()):
        for n in (0, *ORDERS):
            known = [w] if n == 0 and w in table_[0] else [g for g in grams(w, n) if g in table_[n]] if n else []
            if known:
                for lang in langs:
                    total[lang] += sum(log(n, lang, g) for g in known) / len(known)
                break
    return total


@pytest.fixture(scope="module")
def model(spark):
    return fit(frame(spark, TRAIN))


@pytest.mark.parametrize("text", ["der hund", "the dog", "hunde katzen", "dogs cats", "zzz qqq", "Undo the catz", "dhund"])
def test_equals_plain_python(model, text):
    total = plain_scores(text)
    lang, score = Scorer(model).predict(text)
    best = max(total.values())
    assert total[lang] == pytest.approx(best, abs=1e-4)
    assert score == pytest.approx(1 / sum(math.exp(v - best) for v in total.values()), abs=1e-4)


def test_long_words_are_scored_whole_and_not_remembered(model):
    import random
    r = random.Random(3)
    scorer = Scorer(model)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(20_000)) + "hund" * 20_000 for _ in range(40))
    assert scorer.predict(text)[0] == "de"
    assert sum(map(len, scorer.index)) < 10_000
    total = plain_scores("dogthecat" * 30 + " the")
    lang, score = scorer.predict("dogthecat" * 30 + " the")
    assert lang == max(total, key=total.get) and score == pytest.approx(
        1 / sum(math.exp(v - max(total.values())) for v in total.values()), abs=1e-4)


def test_edge_rows(spark, model):
    rows = [(1, None, "de", "a", 1), (2, "", "de", "a", 1), (3, "12 34 !?", "de", "a", 1), (4, "der hund", None, None, None),
            (4, "der hund", None, None, None), (None, "the dog", "x", "a", 1), (7, "the cat " * 60_000, "en", "a", 1)]
    docs = clashing(frame(spark, rows), "score_", "lang_score_", "lang_pred_")
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in predict(docs, model).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en"), (7, "en")], key=str)
    left = reject(docs, model)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0 for r in left.collect())) == [0, 4, 4, 7]


def test_empty_tables(spark, model):
    assert predict(frame(spark, []), model).count() == 0
    none = fit(frame(spark, []))
    assert [r["lang_pred"] for r in predict(frame(spark, TRAIN[:1]), none).collect()] == ["und"]


def test_held_out_accuracy(spark):
    got = query(spark, SF01).join(table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right = [r["lang"] == r["lang_pred"] for r in got.collect()]
    assert len(right) > 100 and sum(right) / len(right) > 0.98
