"""Toxicity by a counterfactually regularised classifier.

A text is cut into sentences; a sentence's score is linear in its distinct
words and neighbouring word pairs, and the most toxic sentence decides for the
document.  Weights are never negative: kind words around an insult do not make
up for it.  They are fitted on a bounded sample of labelled documents whose
sentences are not labelled themselves: by turns the worst sentence of every
document is picked and the weights are fitted to the picked ones.

Each sentence of the sample that names a group (``IDENTITY``) is also written
with other terms of the same kind, the neutral one among them.  Those pairs
say the same about another group, so the squared difference of their scores is
part of the loss: a group that is often insulted does not become an insult
itself, and neutral mentions stay clean.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import fresh, hashed_fraction, mix64, span_hashes, text_buffer, with_computed, word_bounds

#: Text learned from, in bytes (expected; a hash of doc_id picks the documents),
#: and the longest text among it.
SAMPLE_BYTES, SAMPLE_MAX_BYTES = 16 << 20, 1 << 16
#: Features: held by so many sample documents, and this many standard errors
#: above an equal share among toxic and clean ones; the most telling ones.
MIN_DOCS, MIN_Z, MAX_FEATURES = 5, 5.0, 50_000
#: Weight of the counterfactual differences, ridge penalty, picks of the worst
#: sentences and steps of each fit.
COUNTERFACTUAL, RIDGE, PICKS, STEPS, RATE = 4.0, 1e-5, 5, 300, 0.1
#: Swapped copies of a sentence, and sentences that are swapped.
SWAPS, SWAPPED_SENTENCES = 4, 20_000

#: Terms that name groups, by kind; the first is the neutral one.
IDENTITY = {
    "religion": ["believer", "christian", "muslim", "jew", "hindu", "buddhist", "sikh", "catholic", "atheist", "mormon"],
    "religions": ["believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists", "mormons"],
    "faith": ["religious", "jewish", "islamic", "protestant", "orthodox", "pagan"],
    "gender": ["person", "man", "woman", "girl", "boy", "lady"],
    "genders": ["people", "men", "women", "girls", "boys", "ladies", "folks"],
    "orientation": ["single", "gay", "lesbian", "bisexual", "straight", "queer", "transgender", "heterosexual"],
    "origin": ["local", "american", "mexican", "chinese", "indian", "african", "arab", "german", "russian", "polish", "turkish",
               "latino", "asian", "european"],
    "origins": ["locals", "americans", "mexicans", "indians", "africans", "arabs", "germans", "russians", "latinos", "asians",
                "europeans", "immigrants", "refugees", "foreigners"],
    "colour": ["tall", "black", "white", "brown"],
    "ability": ["busy", "disabled", "blind", "deaf", "autistic"],
    "age": ["adult", "elderly", "old", "young", "teenage"],
}

_DATA_END = re.compile(r"[.!?\n]+")


def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_ENDS = _lut(b".!?\n")
_BETWEEN = _lut(bytes(c for c in range(128) if not chr(c).isalnum()))
_PAIR = np.uint64(0xA24BAED4963EE407)


def sentence_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words and of pairs of neighbouring words, the sentence of
    each, and the text of each sentence.  A-Z are lower-cased."""
    data, off = text_buffer(texts)
    data = data + (((data >= 65) & (data <= 90)) * np.uint8(32)).astype(np.uint8)
    s_start, _ = word_bounds(data, off, _ENDS[data])
    owner = np.searchsorted(off, s_start, side="right") - 1
    starts, ends = word_bounds(data, off, _BETWEEN[data])
    sentence = np.searchsorted(s_start, starts, side="right") - 1
    h = span_hashes(data, starts, ends)
    near = np.flatnonzero(sentence[1:] == sentence[:-1])
    pairs = mix64(h[near] * _PAIR + h[near + 1])
    return np.concatenate([h, pairs]), np.concatenate([sentence, sentence[near]]), owner


class Rows:
    """Sentences (rows) by the features of a model that they hold, once each."""

    def __init__(self, texts: pa.Array, features: np.ndarray):
        h, sentence, self.owner = sentence_features(texts)
        at = np.searchsorted(features, h)
        at[at == len(features)] = 0
        hit = features[at] == h if len(features) else np.zeros(len(h), dtype=bool)
        cell = np.unique(sentence[hit] * max(1, len(features)) + at[hit])
        self.row, self.column = np.divmod(cell, max(1, len(features)))
        self.n = len(self.owner)

    @classmethod
    def of(cls, texts: list[str], features: np.ndarray) -> Rows:
        """The rows of many texts, made some at a time."""
        out = cls(pa.array([], pa.string()), features)
        parts, at = [], 0
        for some in _runs(texts):
            r = cls(pa.array(some, pa.large_string()), features)
            parts.append((r.row + out.n, r.column, r.owner + at))
            out.n, at = out.n + r.n, at + len(some)
        if parts:
            out.row, out.column, out.owner = (np.concatenate(x) for x in zip(*parts))
        return out

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.column], minlength=self.n)


def _runs(texts: list[str], size: int = 1 << 19):
    """The texts in runs of about ``size`` characters."""
    run, have = [], 0
    for t in texts:
        run.append(t)
        have += len(t)
        if have >= size:
            yield run
            run, have = [], 0
    if run:
        yield run


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def score_texts(texts: pa.Array, model: dict) -> np.ndarray:
    """Probability of the most toxic sentence; of no evidence at least."""
    rows = Rows(texts, model["features"])
    worst = np.zeros(len(texts))
    np.maximum.at(worst, rows.owner, rows.scores(model["weights"]))
    # equal texts score alike, whatever shares their batch: the last bits go
    return np.round(_sigmoid(model["bias"] + worst), 9)


def select_features(texts: list[str], toxic: np.ndarray) -> np.ndarray:
    """Sorted hashes of the features whose share among toxic documents is
    clearly above that among all."""
    names, held, bad, at = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0
    for some in _runs(texts):
        h, sentence, owner = sentence_features(pa.array(some, pa.large_string()))
        doc = owner[sentence] if len(h) else sentence
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        first = np.ones(len(h), dtype=bool)
        first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[first], doc[first]
        names, to = np.unique(np.concatenate([names, h]), return_inverse=True)
        held = np.bincount(to, weights=np.concatenate([held, np.ones(len(h))]), minlength=len(names))
        bad = np.bincount(to, weights=np.concatenate([bad, toxic[at + doc]]), minlength=len(names))
        at += len(some)
    n, share = len(texts), toxic.mean() if len(texts) else 0.0
    spread = np.sqrt(np.maximum(held * share * (1 - share) * (1 - held / max(1, n)), 1e-9))
    z = (bad - held * share) / spread
    good = np.flatnonzero((held >= MIN_DOCS) & (z >= MIN_Z))
    good = good[np.argsort(-z[good], kind="stable")[:MAX_FEATURES]]
    return np.sort(names[good])


def swapped_sentences(texts: list[str], identity: dict = IDENTITY) -> tuple[list[str], list[str]]:
    """Sentences that name a group, and the same with other terms of its kind
    (the neutral one first, then terms in turn)."""
    kind = {t: terms for terms in identity.values() for t in terms}
    if not kind:
        return [], []
    named = re.compile(r"(?<![^\W_])(" + "|".join(map(re.escape, sorted(kind, key=len, reverse=True))) + r")(?![^\W_])", re.I)
    left, right = [], []
    for text in texts:
        for sentence in _DATA_END.split(text):
            found = named.search(sentence)
            if not found:
                continue
            if len(left) >= SWAPPED_SENTENCES * SWAPS:
                return left, right
            own = found.group().lower()
            others = [t for t in kind[own] if t != own]
            turn = len(left)
            chosen = dict.fromkeys([others[0], *(others[(turn + i) % len(others)] for i in range(SWAPS - 1))])
            for other in chosen:
                left.append(sentence)
                right.append(named.sub(lambda x, own=own, other=other: other if x.group().lower() == own else x.group(), sentence))
    return left, right


def train(texts: list[str], toxic: np.ndarray, counterfactual: float = COUNTERFACTUAL, identity: dict = IDENTITY) -> dict:
    """Features, weights and bias from labelled texts."""
    toxic = np.asarray(toxic, dtype=float)
    features = select_features(texts, toxic)
    prior = (toxic.sum() + 1) / (len(toxic) + 2)
    weights, bias = np.zeros(len(features)), float(np.log(prior / (1 - prior)))
    if not len(features):
        return {"features": features, "weights": weights, "bias": bias}
    rows = Rows.of(texts, features)
    left, right = swapped_sentences(texts, identity)
    l_rows, r_rows = Rows.of(left, features), Rows.of(right, features)
    # one sentence a swapped text; texts without a word have none, on both sides alike
    d_row = np.concatenate([l_rows.owner[l_rows.row], r_rows.owner[r_rows.row]])
    d_column = np.concatenate([l_rows.column, r_rows.column])
    d_value = np.concatenate([np.ones(len(l_rows.row)), -np.ones(len(r_rows.row))])
    n, k, pairs = len(texts), len(features), max(1, len(left))
    picked = None
    for _ in range(PICKS):
        if picked is None:  # first the whole text is one sentence
            cell = np.unique(rows.owner[rows.row] * k + rows.column)
        else:
            cell = np.unique(rows.owner[rows.row[picked]] * k + rows.column[picked])
        doc, column = np.divmod(cell, k)
        m, v = np.zeros(k + 1), np.zeros(k + 1)
        for i in range(1, STEPS + 1):
            p = _sigmoid(bias + np.bincount(doc, weights=weights[column], minlength=n))
            gap = np.bincount(d_row, weights=d_value * weights[d_column], minlength=pairs)
            g = np.empty(k + 1)
            g[:k] = np.bincount(column, weights=(p - toxic)[doc], minlength=k) / n + RIDGE * weights
            g[:k] += 2 * counterfactual * np.bincount(d_column, weights=d_value * gap[d_row], minlength=k) / pairs
            g[k] = (p - toxic).mean()
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = RATE * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-9)
            weights, bias = np.maximum(weights - step[:k], 0), float(bias - step[k])
        score = rows.scores(weights)
        order = np.lexsort((np.arange(rows.n), -score, rows.owner))
        first = np.ones(len(order), dtype=bool)
        first[1:] = rows.owner[order][1:] != rows.owner[order][:-1]
        worst = np.zeros(rows.n, dtype=bool)
        worst[order[first]] = True
        picked = worst[rows.row] & (score[rows.row] > 0)
    return {"features": features, "weights": weights, "bias": bias}


def fit(docs: DataFrame, labels: DataFrame, sample_bytes: int = SAMPLE_BYTES, seed: int = 12) -> dict:
    """The model of documents (doc_id, text) and labels (doc_id, toxic 0/1).

    Learns from about ``sample_bytes`` of labelled texts of at most
    ``SAMPLE_MAX_BYTES`` each, picked by a hash of doc_id.  Null texts, and
    labels that are neither 0 nor 1, are left out; several labels of a document
    count as their majority (ties: toxic); a repeated document counts once.
    Without labelled texts every score is 0.5.
    """
    marked = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")))
    texts = docs.where(F.octet_length("text") <= SAMPLE_MAX_BYTES).select("doc_id", "text")
    sizes = texts.select("doc_id", F.octet_length("text").alias("_size"))
    size = sizes.join(marked, "doc_id").agg(F.sum("_size")).first()[0] or 0
    picked = hashed_fraction(F.col("doc_id"), seed) < min(1.0, sample_bytes / max(1, size))
    rows = texts.where(picked).join(marked.where(picked), "doc_id").select("toxic", "text").distinct().collect()
    rows = sorted((r["text"], r["toxic"]) for r in rows)  # any order of tasks gives one model
    return train([t for t, _ in rows], np.array([y for _, y in rows], dtype=float))


def score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """All columns of docs plus the toxicity in [0, 1].

    Reads ``text`` alone, whole.  Defined cases: null and empty texts, and
    those without any of the model's words, get the score of no evidence; every
    row gives one row, repeated ones alike; a text without sentence ends is one
    sentence; a very long text is held at once (about 60 times its bytes in a
    worker); an empty table gives an empty result; the new column's name must
    be new.
    """
    return with_computed(docs, lambda texts: (pa.array(score_texts(texts, model)),), [(name, "double")])


def reject(docs: DataFrame, model: dict, most: float = 0.5) -> DataFrame:
    """The documents with a toxicity below ``most``; same columns."""
    c = fresh(docs, "toxicity_")
    return score(docs, model, c).where(F.col(c) < most).drop(c)
