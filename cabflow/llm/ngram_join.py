"""Jaccard join of documents on word n-grams by signature trees.

1. One pass over the texts: distinct shingles per document, a fingerprint of
   the set, and min-hash keys (``BANDS`` keys of ``ROWS`` minima each).
2. Documents with equal sets are one class; its smallest doc_id stands for it.
3. Classes that share a key form a bucket.  Two sets with a Jaccard similarity
   of 0.85 share none of the keys with probability (1 - 0.85**4)**24, about
   2e-8.  Buckets with the same members count once.
4. A bucket is dealt into blocks of at most about ``BLOCK`` classes, by another
   hash in every bucket.  Each block is joined with itself: a signature tree,
   its dual traversal, and the exact test of the pairs that are left, which are
   skipped once they are connected.  Links that connect are kept, not all pairs.
   Each class's largest bucket goes first; the texts of another bucket travel
   only if its classes are not all connected by then.
5. Buckets of several blocks whose classes are not all connected after that:
   the classes outside the bucket's largest part meet all its blocks, in the
   same way.  No pair of a bucket is left out.
6. Components of the links, distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.bucket_links import bucket_components
from cabflow.llm.common import (arrow_map, emit, fresh, mix64, parallelism, slices, span_hashes, text_buffer,
                                word_bounds, written)
from cabflow.llm.signature_tree import spanning_links

BANDS, ROWS = 24, 4
BLOCK, ACROSS = 128, 512

_rng = np.random.default_rng(20240607)
_SALT = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_STEP = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = 4) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text.

    A-Z are lower-cased, words are runs of bytes other than space and
    tab to carriage return.  A text of fewer words has one shingle, its whole
    sequence; one without words, or null, has none.
    """
    data, off = text_buffer(texts)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    s, e = word_bounds(data, off, (data == 32) | ((data >= 9) & (data <= 13)))
    h = span_hashes(data, s, e)
    first = np.searchsorted(s, off)
    n = len(h)
    gram = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        gram[:n - k if k else n] += h[k:] * _STEP[k]
    gram = mix64(gram)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(gram[a:b - words + 1]))
        elif b > a:
            short = np.uint64(b - a) + (h[a:b] * _STEP[:b - a]).sum(dtype=np.uint64)
            out.append(mix64(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minhash_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys per non-empty set (rows of zeros for empty ones)."""
    keys = np.zeros((len(sets), BANDS), dtype=np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return keys
    flat = np.concatenate([sets[i] for i in full])
    start = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])])[:-1]
    made = np.zeros((len(full), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        acc = np.full(len(full), band + 1, dtype=np.uint64)
        for r in range(ROWS):
            k = band * ROWS + r
            low = np.minimum.reduceat((flat ^ _SALT[k]) * _ODD[k], start)
            acc = mix64(acc * _STEP[5] + low)
        made[:, band] = acc
    keys[full] = made
    return keys


_PRINT = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                    ("keys", pa.list_(pa.int64()))])


def _prints(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            sets = shingle_sets(b.column(1), words)
            keys = minhash_keys(sets).astype(np.int64)
            f1 = [int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            f2 = [int(np.bitwise_xor.reduce(s * _STEP[6]).astype(np.int64)) if len(s) else 0 for s in sets]
            yield emit(_PRINT, doc_id=b.column(0), n_shingles=[len(s) for s in sets], f1=f1, f2=f2,
                       keys=[k if len(s) else k[:0] for k, s in zip(keys, sets, strict=True)])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>")


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links within each group (g1, g2, g3, rep, part, probe).

    The texts (rep, text) travel to their groups; groups are streamed, one in
    memory at a time, whatever the number of rows of a task.
    """
    rows = (groups.join(texts, "rep").select("g1", "g2", "g3", "rep", "part", "probe", "text")
            .repartition(parallelism(texts.sparkSession), "g1", "g2", "g3")
            .sortWithinPartitions("g1", "g2", "g3", "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, sets, parts, probe = None, [], [], [], []

        def close() -> pa.RecordBatch | None:
            if len(ids) < 2:
                return None
            found = spanning_links(ids, sets, percent, parts, None if probe[0] is None else probe)
            return emit(_LINK, a=[x for x, _ in found], b=[y for _, y in found]) if found else None

        for b in slices(batches, "text", 1 << 20):
            made = shingle_sets(b.column(6), words)
            cols = [c.to_pylist() for c in b.columns[:6]]
            for k, at in enumerate(zip(*cols[:3], strict=True)):
                if at != group:
                    if (out := close()) is not None:
                        yield out
                    group, ids, sets, parts, probe = at, [], [], [], []
                if len(ids) and ids[-1] == cols[3][k] and probe[-1] == cols[5][k]:
                    continue  # the row is there twice
                ids.append(cols[3][k])
                sets.append(made[k])
                parts.append(cols[4][k])
                probe.append(cols[5][k])
        if (out := close()) is not None:
            yield out

    return arrow_map(rows, run, "a long, b long")


def ngram_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text).

    Two documents link when 100 * overlap >= percent * union of their shingle
    sets; component_id is the smallest doc_id reachable.  Defined cases: null,
    empty and blank texts have no shingles and link with nothing; equal sets
    link; rows with the same doc_id are one document; a row with a null doc_id
    gets the component of the documents it equals (null if none); each input
    row gives one row; other columns are not read; an empty table gives an
    empty result.
    """
    prints = written(_prints(docs, words), "prints")
    alone = F.col("n_shingles") == 0
    classes = written(prints.where(~alone).groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")),
                      "classes")
    entries = (prints.where(~alone).join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
               .select(F.col("doc_id").alias("rep"), F.explode("keys").alias("key")))

    def linker(items: DataFrame):
        texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"))
        # a shuffle join at every size: how many candidates there are grows with the corpus
        texts = written(texts.join(items.hint("merge"), "rep", "left_semi").distinct(), "texts")
        return lambda groups: _links(groups, texts, words, percent)

    parts = bucket_components(entries, linker, BLOCK, ACROSS, largest_first=True)
    labelled = written(classes.join(parts, F.col("rep") == F.col("node"), "left")
                       .select("f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("component_id")),
                       "labelled")
    linked = prints.where(~alone).drop("keys").join(labelled, ["f1", "f2", "n_shingles"])
    return (linked.select("doc_id", "n_shingles", "component_id")
            .unionAll(prints.where(alone).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def keep_one(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One document of each group of linked ones (the smallest doc_id), all
    columns as they are.  Rows with a null doc_id cannot be named and stay; of
    several rows with one doc_id the one whose hash is smallest stays."""
    found = ngram_components(docs, words, percent)
    c, h, n = fresh(docs, "kept_id_"), fresh(docs, "kept_hash_"), fresh(docs, "kept_row_")
    cells = [F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name]
             for f in docs.schema.fields]
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(c)).distinct()
    first = Window.partitionBy("doc_id").orderBy(h)
    return (docs.join(kept, F.col("doc_id") == F.col(c), "left_semi").withColumn(h, F.xxhash64(*cells))
            .withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).drop(h, n)
            .unionAll(docs.where(F.col("doc_id").isNull())))
