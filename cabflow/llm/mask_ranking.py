"""Ranked lexical search by presence masks.

The documents' terms that any item asks for are kept in a forward index, one
row a document.  A task takes the index in blocks of documents; within a block
every term has a bitmap of the documents that hold it.  For an item, the
bitmaps of its terms give each document's *presence mask*; documents with one
mask form a group, and a mask has a maximum score, the sum over its terms of
the best that any document of the block makes of the term.  Masks are evaluated
by descending maximum score until the next one lies below the item's k-th best
score so far, which is carried from block to block.  So the evaluation stops
early and loses nothing.

The score of a term in a document is, in 64-bit integers and with ``div``
rounding down, ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with
``m = 10 + (90 * n * N) div L`` and ``w = floor(1000 * ln((2N+2) / (2df+1)))``.

Words are met by 64-bit hashes: two of them agree by chance only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, slices, span_hashes, text_buffer, word_bounds, written

#: Text of the items searched for in one pass over the documents (expected);
#: more items take several passes.
ITEM_BYTES = 4 << 20
#: Cells (documents times terms) of a block.
BLOCK_CELLS = 1 << 23
#: Masks evaluated at once; doubled as long as an item goes on.
MASKS = 32


def _word_bytes() -> np.ndarray:
    sep = np.zeros(256, dtype=bool)
    for lo, hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        sep[lo:hi + 1] = True
    return sep


_SEPARATES = _word_bytes()


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of the texts, in order, and its text's number."""
    data, off = text_buffer(texts)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper * np.uint8(32)).astype(np.uint8)
    starts, ends = word_bounds(data, off, _SEPARATES[data])
    doc = np.searchsorted(off, starts, side="right") - 1
    return span_hashes(data, starts, ends), doc


class Items:
    """The items of one pass: their distinct terms as rows of ``terms``."""

    def __init__(self, rows: list):
        words: dict = {}
        for item, text in rows:
            h, _ = term_hashes(pa.array([text], pa.string()))
            words.setdefault(item, set()).update(h.tolist())
        self.ids = sorted(words, key=lambda i: (i is None, i))
        self.hashes = np.array(sorted(set().union(*words.values())), dtype=np.uint64)
        self.terms = [np.searchsorted(self.hashes, np.array(sorted(words[i]), dtype=np.uint64)) for i in self.ids]


_INDEX = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("tf", pa.binary())])


def forward_index(docs: DataFrame, items) -> DataFrame:
    """doc_id, n (terms with repeats), and the items' terms in it with their
    numbers; documents without any term have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = items.value.hashes
        q = max(1, len(wanted))
        for b in slices(batches, "text"):
            h, doc = term_hashes(b.column(1))
            n = np.bincount(doc, minlength=b.num_rows)
            at = np.searchsorted(wanted, h)
            at[at == len(wanted)] = 0
            hit = wanted[at] == h if len(wanted) else np.zeros(len(h), dtype=bool)
            cell, tf = np.unique(doc[hit] * q + at[hit], return_counts=True)
            off = np.searchsorted(cell, np.arange(b.num_rows + 1) * q)
            term, tf = (cell % q).astype("<u4"), tf.astype("<i4")
            rows = np.flatnonzero(n)
            cut = [(int(off[i]), int(off[i + 1])) for i in rows]
            yield emit(_INDEX, doc_id=b.column(0).take(pa.array(rows)), n=n[rows],
                       terms=[term[s:e].tobytes() for s, e in cut], tf=[tf[s:e].tobytes() for s, e in cut])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     run, "doc_id long, n long, terms binary, tf binary")


def _lists(a: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    a = a.cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data[off[0]:off[-1]].tobytes(), dtype=kind).astype(np.int64), (off - off[0]) // 4


_STAT = pa.schema([("term", pa.int64()), ("docs", pa.int64()), ("total", pa.int64())])


def statistics(index: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and each term's df; a task gives one row a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(n_terms, dtype=np.int64), 0, 0
        for b in batches:
            df += np.bincount(_lists(b.column(1), "<u4")[0], minlength=n_terms)
            docs += b.num_rows
            total += int(np.asarray(b.column(0), dtype=np.int64).sum())
        some = np.flatnonzero(df)
        yield emit(_STAT, term=np.append(some, -1), docs=np.append(df[some], docs), total=np.append(0 * some, total))

    rows = (arrow_map(index.select("n", "terms"), run, "term long, docs long, total long")
            .groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")).collect())
    df = np.zeros(n_terms, dtype=np.int64)
    whole = (0, 0)
    for r in rows:  # one row a term of this pass's items
        if r["term"] < 0:
            whole = (r["docs"], r["total"])
        else:
            df[r["term"]] = r["docs"]
    return *whole, df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


class Best:
    """An item's k best (score, document), equal scores by smaller number."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = 1  # a score must reach this

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least
        score, doc = np.concatenate([self.score, score[good]]), np.concatenate([self.doc, doc[good]])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))


def _mask_groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of packed masks: number of the first row, and each row's group."""
    pad = -masks.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(masks, ((0, 0), (0, pad)))).view(np.uint64)
    if wide.shape[1] == 1:
        _, first, group = np.unique(wide[:, 0], return_index=True, return_inverse=True)
        return first, group
    order = np.lexsort(wide.T)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (wide[order][1:] != wide[order][:-1]).any(axis=1)
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return order[new], group


class Block:
    """Some documents of the index with their terms' bitmaps and scores."""

    def __init__(self, doc_id: np.ndarray, m: np.ndarray, term: np.ndarray, tf: np.ndarray, doc: np.ndarray,
                 n_terms: int, weight: np.ndarray):
        self.doc_id, d = doc_id, len(doc_id)
        self.used, row = np.unique(term, return_inverse=True)
        self.row = np.full(n_terms, -1, dtype=np.int64)
        self.row[self.used] = np.arange(len(self.used))
        self.part = np.zeros((len(self.used), d), dtype=np.int64)
        self.part[row, doc] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        has = np.zeros((len(self.used), d), dtype=bool)
        has[row, doc] = True
        self.bitmaps = np.packbits(has, axis=1)
        self.weight = weight[self.used]
        self.most = self.part.max(axis=1, initial=0) * self.weight

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Offer ``best`` every document of the block that can be among them."""
        rows = self.row[terms]
        rows = rows[rows >= 0]
        rows = rows[self.weight[rows] > 0]
        if not len(rows) or int(self.most[rows].sum()) < best.least:
            return
        bitmaps = self.bitmaps[rows]
        held = np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=len(self.doc_id))
        docs = np.flatnonzero(held)
        present = np.unpackbits(bitmaps, axis=1, count=len(self.doc_id))[:, docs]
        first, group = _mask_groups(np.packbits(present, axis=0).T)
        bound = self.most[rows] @ present[:, first].astype(np.int64)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] >= best.least]
        rank = np.full(len(first), len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        at = rank[group]  # when each document's mask has its turn
        done, step = 0, MASKS
        while done < len(order) and bound[order[done]] >= best.least:
            turn = np.flatnonzero((at >= done) & (at < done + step))
            score = self.weight[rows] @ self.part[rows[:, None], docs[turn][None, :]]
            best.add(score, self.doc_id[docs[turn]])
            done, step = done + step, step * 2


_FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(index: DataFrame, items, n_docs: int, n_all: int, weight: np.ndarray, k: int) -> DataFrame:
    """Each task's k best documents per item."""
    least_id = -(1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = items.value
        best = [Best(k) for _ in wanted.ids]
        n_terms = len(wanted.hashes)
        size = max(64, min(4096, BLOCK_CELLS // max(1, n_terms)))
        for whole in batches:
            for lo in range(0, whole.num_rows, size):
                b = whole.slice(lo, size)
                term, off = _lists(b.column(2), "<u4")
                tf, _ = _lists(b.column(3), "<i4")
                n = np.asarray(b.column(1), dtype=np.int64)
                m = 10 + (90 * n * n_docs) // max(1, n_all)
                ids = np.asarray(b.column(0).fill_null(least_id), dtype=np.int64)
                block = Block(ids, m, term, tf, np.repeat(np.arange(b.num_rows), np.diff(off)), n_terms, weight)
                for terms, found in zip(wanted.terms, best, strict=True):
                    block.search(terms, found)
        for item, found in zip(wanted.ids, best, strict=True):
            if len(found.score):
                yield emit(_FOUND, item_id=[item] * len(found.score), score=found.score,
                           doc_id=[None if d == least_id else d for d in found.doc.tolist()])

    return arrow_map(index.select("doc_id", "n", "terms", "tf"), run, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score
    above 0, equal scores by ascending doc_id (a null doc_id first).

    The items go in blocks of about ``item_bytes`` of text, each with one pass
    over all documents; an item's terms and its k best are what a task holds.

    Defined cases: rows of one item_id (null included) are one item with the
    terms of all of them; items without terms, or whose terms no document
    holds, give no row; null and empty texts have no terms and are not counted
    in N; every row of docs is a document, repeated ones rank next to each
    other; whole texts are read, a very long one at once (about 40 times its
    bytes in a worker); other columns are not read; without documents or items
    the result is empty.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // item_bytes))
    parts = []
    for i in range(passes):
        some = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i)
        made = Items([(r["item_id"], r["text"]) for r in some.collect()])  # about item_bytes of text
        held = spark.sparkContext.broadcast(made)
        index = written(forward_index(docs, held), "forward-index")
        n_docs, n_all, df = statistics(index, len(made.hashes))
        parts.append(_search(index, held, n_docs, n_all, weights(n_docs, df), k))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
