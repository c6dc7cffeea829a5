"""Language identification, words first, then ever shorter character n-grams.

Fit: word and n-gram counts per language over a bounded sample of the labelled
texts.  Predict: each word the model knows adds its log frequency in every
language; a word it does not know falls back to its n-grams of the longest
length of which any is known.  The language with the largest sum wins.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, fresh, hashed_fraction, resident, slices, with_computed

#: Texts to learn from per language, expected number (a hash of doc_id picks them).
SAMPLE_PER_LANG = 800
#: Longest text learned from, in characters (longer ones are not picked).
SAMPLE_MAX_CHARS = 200_000
#: A word or n-gram enters the model when seen this often in the sample.
MIN_COUNT = 2
#: n-gram lengths tried for unknown words, longest first.
ORDERS = (4, 3, 2, 1)
#: Words remembered per worker beside the model's own, and the longest word
#: that is remembered or enters the model as a word (its n-grams always do).
CACHE_WORDS, WORD_LETTERS = 200_000, 64

UNDETERMINED = "und"

_words = regex.compile(r"\p{L}+").findall


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    w = f"^{word}$" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)]


_COUNTS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.string()), ("c", pa.int64())])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        seen: dict[str, Counter] = {}
        for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            seen.setdefault(lang, Counter()).update(_words(text.lower()))
        rows = []
        for lang, words in seen.items():
            rows += [(lang, 0, w, c) for w, c in words.items() if len(w) <= WORD_LETTERS]
            by_order = {n: Counter() for n in ORDERS}
            for w, c in words.items():
                for n in ORDERS:
                    for g in grams(w, n):
                        by_order[n][g] += c
            rows += [(lang, n, g, c) for n, cs in by_order.items() for g, c in cs.items()]
        yield emit(_COUNTS, lang=[r[0] for r in rows], n=[r[1] for r in rows], gram=[r[2] for r in rows],
                   c=[r[3] for r in rows])


def fit(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG, seed: int = 4) -> dict:
    """The model of rows (doc_id, text, lang); null texts and langs are left out.

    Learns from about ``per_lang`` texts of each language, so its size is
    bounded by that and the number of languages.  Words of more than
    ``WORD_LETTERS`` letters enter it by their n-grams alone.  Without any
    labelled row the model has no language and every prediction is ``und``.
    """
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                          & (F.length("text") <= SAMPLE_MAX_CHARS)).select("doc_id", "text", "lang")
    total = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(total)
    if not langs:
        return {"langs": [], "tables": {}, "logs": {}}
    rate = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, per_lang / n))) for lang, n in total.items()])
    sample = rows.where(hashed_fraction(F.col("doc_id"), seed) < rate).select("text", "lang")
    counted = (arrow_map(sample, _count_grams, "lang string, n int, gram string, c long")
               .groupBy("n", "gram").pivot("lang", langs).agg(F.sum("c")))
    total_count = sum((F.coalesce(F.col(f"`{lang}`"), F.lit(0)) for lang in langs), F.lit(0))
    kept = counted.where(total_count >= MIN_COUNT).toPandas()
    counts = kept[langs].fillna(0).to_numpy(dtype=np.float64)
    logs, tables = {}, {}
    for n in (0, *ORDERS):
        at = np.flatnonzero(kept["n"].to_numpy() == n)
        c = counts[at]
        size = c.sum(axis=0) + 0.5 * (len(at) + 1)
        logs[n] = np.log((c + 0.5) / size).astype(np.float32)
        tables[n] = {g: i for i, g in enumerate(kept["gram"].to_numpy()[at])}
    return {"langs": langs, "tables": tables, "logs": logs}


class Scorer:
    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.tables, self.logs = model["tables"], model["logs"]
        k = max(1, len(self.langs))
        known = self.logs.get(0, np.zeros((0, k), np.float32))
        self.known = len(known)
        self.rows = np.zeros((self.known + CACHE_WORDS, k), dtype=np.float32)
        self.rows[:self.known] = known
        self.index = dict(self.tables.get(0, {}))
        self.next = self.known

    def word(self, w: str) -> np.ndarray:
        """Log frequency of a word per language (zeros: nothing known)."""
        i = self.tables[0].get(w)
        if i is not None:
            return self.logs[0][i]
        for n in ORDERS:
            table = self.tables[n]
            at = [table[g] for g in grams(w, n) if g in table]
            if at:
                return self.logs[n][at].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)

    def _add(self, w: str) -> int:
        if self.next >= len(self.rows):
            self.index = dict(self.tables[0])
            self.next = self.known
        i = self.next
        self.rows[i] = self.word(w)
        self.index[w] = i
        self.next += 1
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its posterior (languages equally likely before)."""
        words = _words(text.lower()) if text else []
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.langs))
        for s in range(0, len(words), 100_000):  # the cache may be emptied in between
            part = words[s:s + 100_000]
            if self.next + len(part) > len(self.rows):
                self.index = dict(self.tables[0])
                self.next = self.known
            get, add = self.index.get, self._add
            at = [get(w) for w in part]
            if None in at:
                for i, w in zip(at, part, strict=True):
                    if i is None and len(w) > WORD_LETTERS:
                        total += self.word(w)  # not remembered
                at = [i if i is not None else (get(w) if w in self.index else add(w))
                      for i, w in zip(at, part, strict=True) if i is not None or len(w) <= WORD_LETTERS]
            total += self.rows[at].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())  # of equal sums the first language by name
        return self.langs[best], 1.0 / float(np.exp(np.maximum(total - total[best], -700)).sum())


def scorer_of(token: str, raw: bytes) -> Scorer:
    return resident(("scorer", token), lambda: Scorer(pickle.loads(raw)))


def predict(docs: DataFrame, model: dict, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of docs plus the predicted language and its score in [0, 1].

    Reads ``text`` alone, whole.  Defined cases: null texts and texts without
    a letter are ``und`` with score 0; every row gives one row, repeated ones
    alike; an empty table gives an empty result; the names of the new columns
    must be new.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # bounded by the sample
    token = uuid.uuid4().hex

    def run(texts: pa.Array):
        scorer = scorer_of(token, shared.value)
        found = [scorer.predict(t) for t in texts.to_pylist()]
        return pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())

    return with_computed(docs, run, [(names[0], "string"), (names[1], "double")])


def reject(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The documents whose language is determined with a score of at least
    ``least``; same columns.  Texts without a letter go."""
    a, b = fresh(docs, "lang_pred_"), fresh(docs, "lang_score_")
    return (predict(docs, model, (a, b)).where((F.col(a) != UNDETERMINED) & (F.col(b) >= least)).drop(a, b))
