"""Alignment of two tokenizers over a corpus.

Every text is encoded by a byte-level BPE (A, of a space and the text) and by
a sentencepiece model (B, which adds that space itself).  Both cut the same
bytes, so the common refinement of the two cuts names every pair of an A and a
B token that overlap (a *link*), and the offsets where both cuts end divide
the text into *groups*.

How often a pair of ids is linked is counted over the whole corpus, by
document:

1. the texts are encoded once; the ids are written;
2. each task aligns its documents and counts its distinct pairs;
3. the distinct pairs of all tasks get a minimal perfect hash, built in
   buckets; under it a task's counts are a dense vector per bucket, and the
   vectors are summed as a tree, ``FAN`` at a time;
4. a second pass aligns the documents again and looks every link up, by hash,
   with the stored key verified.

The second pass holds at most ``RESIDENT`` pairs in a worker, the most
frequent ones.  Links of other pairs go through a join instead, so the table
of pairs may grow without bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, parallelism, resident, ship, slices, written
from cabflow.llm.perfect_hash import BUCKET_KEYS, PerfectHash, bucket_of, build
from cabflow.llm.vocab import PRETOKEN, Vocab, broadcast_vocab, digest

#: Pairs that a worker keeps in the second pass (about 20 bytes each).
RESIDENT = 4_000_000
#: Distinct pairs that a task gathers before it passes its counts on.
GATHER = 1_000_000
#: Vectors summed at once in the tree.
FAN = 64
#: Runs of documents aligned at once hold about this many bytes of A ids.
IDS_BYTES = 1 << 20


def default_piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Both encoders with the bytes of their tokens."""

    def __init__(self, raw_a: bytes, raw_b: bytes):
        vocab = Vocab(raw_a)
        merged = [new for _, new in vocab.merge.values()]
        if any(x >= y for x, y in zip(merged, merged[1:])):
            raise ValueError("ids of A's merged tokens must follow the order of the merges")
        self._a = tiktoken.Encoding("a", pat_str=PRETOKEN, mergeable_ranks=vocab.id_of, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=raw_b)
        self.bytes_a = vocab.bytes_of
        self.bytes_b = [bytes([int(self._b.id_to_piece(i)[3:5], 16)]) if self._b.is_byte(i)
                        else self._b.id_to_piece(i).replace("▁", " ").encode() for i in range(self._b.vocab_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.bits_b = max(1, (len(self.bytes_b) - 1).bit_length())
        self._text_a = [f"{i}," for i in range(len(self.bytes_a))] + [f"{i}|" for i in range(len(self.bytes_a))]
        self._text = self._text_a + [f"{i}," for i in range(len(self.bytes_b))] + [f"{i};" for i in range(len(self.bytes_b))]
        self.kind_a, self.kind_b = (np.uint16 if len(t) <= 1 << 16 else np.uint32 for t in (self.bytes_a, self.bytes_b))

    def encode(self, texts: list) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text by both, as packed integers; nothing for a text
        without tokens."""
        some = [t for t in texts if t]
        pieces = iter(self._b.encode(some, num_threads=1))
        out_a, out_b = [], []
        for t in texts:
            a = b = ()
            if t:
                want = b" " + t.encode()
                a, b = self._a.encode_ordinary(" " + t), next(pieces)
                if (b"".join([self.bytes_a[i] for i in a]) != want) or (b"".join([self.bytes_b[i] for i in b]) != want):
                    a = b = ()
            out_a.append(np.array(a, dtype=self.kind_a).tobytes())
            out_b.append(np.array(b, dtype=self.kind_b).tobytes())
        return out_a, out_b


class Aligned:
    """Documents' links and groups from their ids, all at once.

    ``links``: pair of ids of each link, ``link_doc`` its document; ``link_off``,
    ``a_off``, ``b_off`` and ``group_off`` bound each document's share.
    """

    def __init__(self, pair: Pair, ids_a: pa.Array, ids_b: pa.Array):
        self.pair = pair
        a, self.a_off = _flat(ids_a, pair.kind_a)
        b, self.b_off = _flat(ids_b, pair.kind_b)
        end_a, end_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
        n = int(end_a[-1]) if len(end_a) else 0
        at_a, at_b = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
        at_a[end_a], at_b[end_b] = True, True
        both = at_a & at_b
        stop = np.flatnonzero(at_a | at_b)  # where a link ends
        run_a, run_b, run_both = np.cumsum(at_a), np.cumsum(at_b), np.cumsum(both)
        at = stop - 1
        self.links = (a[run_a[at]] << pair.bits_b) | b[run_b[at]]
        doc_end = np.concatenate([[0], end_a])[self.a_off]  # bytes before each document
        self.link_off = np.searchsorted(stop, doc_end, side="right")
        self.link_doc = np.repeat(np.arange(len(ids_a)), np.diff(self.link_off))
        self.group_off = run_both[doc_end]
        self._a, self._b = a, b
        self._group_a, self._group_b = run_both[end_a - 1], run_both[end_b - 1]
        self._last_a, self._last_b = both[end_a], both[end_b]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of a whole number per link, for each document."""
        run = np.concatenate([[0], np.cumsum(values)])
        return run[self.link_off[1:]] - run[self.link_off[:-1]]

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document."""
        n_groups = int(self.group_off[-1])
        in_a = np.bincount(self._group_a, minlength=n_groups)
        in_b = np.bincount(self._group_b, minlength=n_groups)
        # the last A id of a group is followed by a bar: the next A id opens another group
        bar = np.ones(len(self._a), dtype=bool)
        bar[:-1] = self._group_a[1:] != self._group_a[:-1]
        n_a, n_b = len(self.pair.bytes_a), len(self.pair.bytes_b)
        codes = np.empty(len(self._a) + len(self._b), dtype=np.int64)
        codes[np.arange(len(self._a)) + (np.cumsum(in_b) - in_b)[self._group_a]] = self._a + n_a * bar
        codes[np.arange(len(self._b)) + np.cumsum(in_a)[self._group_b]] = self._b + 2 * n_a + n_b * self._last_b
        text = self.pair._text
        parts = [text[c] for c in codes.tolist()]
        off = (self.a_off + self.b_off).tolist()
        return ["".join(parts[s:e])[:-1] for s, e in zip(off[:-1], off[1:], strict=True)]


def _flat(ids: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    ids = ids.cast(pa.large_binary())
    off = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1]
    raw = ids.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    size = np.dtype(kind).itemsize
    return np.frombuffer(data[off[0]:off[-1]].tobytes(), dtype=kind).astype(np.int64), (off - off[0]) // size


def _pair_of(raw_a: bytes, raw_b: bytes) -> Pair:
    return resident(("pair", digest(raw_a), digest(raw_b)), lambda: Pair(raw_a, raw_b))


# ------------------------------------------------------------------ the jobs

_ENCODED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("ids_a", pa.binary()), ("ids_b", pa.binary())])


def encode(docs: DataFrame, raws) -> DataFrame:
    """doc_id, a number of the row, and the packed ids of both encoders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair_of(*raws())
        for b in slices(batches, "text"):
            ids_a, ids_b = pair.encode(b.column(2).to_pylist())
            yield emit(_ENCODED, doc_id=b.column(0), row=b.column(1), ids_a=ids_a, ids_b=ids_b)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                      F.col("text").cast("string").alias("text"))
    return arrow_map(src, run, "doc_id long, row long, ids_a binary, ids_b binary")


_COUNTED = pa.schema([("pair", pa.int64()), ("part", pa.int32()), ("docs", pa.int64())])


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(k), dtype=np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return k, total


def task_counts(encoded: DataFrame, raws) -> DataFrame:
    """pair, part (the task), docs: documents of the task that hold the pair
    linked, in one row a pair or, beyond ``GATHER`` pairs, a few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        pair = _pair_of(*raws())
        bits = pair.bits_b + max(1, (len(pair.bytes_a) - 1).bit_length())
        keys, counts, held = [], [], 0

        def passed_on() -> pa.RecordBatch:
            k, c = _merged(keys, counts)
            return emit(_COUNTED, pair=k, part=np.full(len(k), part, dtype=np.int32), docs=c)

        for b in slices(batches, "ids_a", IDS_BYTES):
            x = Aligned(pair, b.column(0), b.column(1))
            in_docs = np.unique((x.link_doc.astype(np.int64) << bits) | x.links)
            k, c = np.unique(in_docs & ((1 << bits) - 1), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > 2 * GATHER:
                k, c = _merged(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > GATHER:
                    yield passed_on()
                    keys, counts, held = [], [], 0
        if held:
            yield passed_on()

    return arrow_map(encoded.select("ids_a", "ids_b"), run, "pair long, part int, docs long")


def _bucket_column(spark: SparkSession, df: DataFrame, buckets: int) -> DataFrame:
    """df plus the bucket of its ``pair``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.asarray(b.column(b.schema.get_field_index("pair")), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket_of(keys, buckets))],
                                             names=[*b.schema.names, "bucket"])

    return arrow_map(df, run, df.schema.simpleString()[len("struct<"):-1].replace(":", " ") + ",bucket long")


_HASH = "bucket long, levels binary, vectors binary, keys binary, docs binary, best binary"


def _hashed_bucket(table: pa.Table) -> pa.Table:
    """One bucket's hash with the keys, and their values if given, by slot."""
    keys = np.asarray(table["pair"].combine_chunks(), dtype=np.int64)
    levels, vectors = build(keys)
    hashed = PerfectHash([levels], [vectors])
    slot = hashed.slots(keys)

    def placed(name: str, kind) -> bytes:
        if name not in table.column_names:
            return b""
        out = np.zeros(len(keys), dtype=kind)
        out[slot] = np.asarray(table[name].combine_chunks())
        return out.tobytes()

    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int64()), "levels": [levels.tobytes()],
                     "vectors": [vectors.tobytes()], "keys": [placed("pair", np.int64)],
                     "docs": [placed("docs", np.int64)], "best": [placed("best", np.int8)]})


def perfect_hash(pairs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The hash of ``n`` distinct pairs, a row for each bucket that has keys,
    and the number of buckets."""
    spark = pairs.sparkSession
    buckets = max(1, -(-n // BUCKET_KEYS))
    rows = _bucket_column(spark, pairs, buckets)
    return rows.groupBy("bucket").applyInArrow(_hashed_bucket, _HASH), buckets


def _vector(left: pa.Table, right: pa.Table) -> pa.Table:
    """Dense counts, by slot, of the rows of up to ``FAN`` tasks."""
    if not left.num_rows:
        return pa.table({"bucket": pa.array([], pa.int64()), "node": pa.array([], pa.int32()), "docs": pa.array([], pa.binary())})
    h = right.to_pylist()[0]
    hashed = PerfectHash([np.frombuffer(h["levels"], np.int64)], [np.frombuffer(h["vectors"], np.uint64)])
    keys = np.asarray(left["pair"].combine_chunks(), dtype=np.int64)
    slot = hashed.slots(keys)
    if not np.array_equal(np.frombuffer(h["keys"], np.int64)[slot], keys):
        raise ValueError("a pair is missing from the hash")
    out = np.zeros(hashed.count, dtype=np.int64)
    np.add.at(out, slot, np.asarray(left["docs"].combine_chunks(), dtype=np.int64))
    return pa.table({"bucket": pa.array([h["bucket"]], pa.int64()), "node": pa.array([h["node"]], pa.int32()),
                     "docs": pa.array([out.tobytes()], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v, np.int64) for v in table["docs"].to_pylist())
    return pa.table({"bucket": table["bucket"][:1], "node": table["node"][:1], "docs": pa.array([total.tobytes()], pa.binary())})


def count_vectors(counts: DataFrame, hashes: DataFrame, buckets: int) -> DataFrame:
    """bucket, docs: one dense vector a bucket, summed over all tasks as a tree."""
    spark = counts.sparkSession
    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    nodes = -(-parts // FAN)
    leaves = _bucket_column(spark, counts, buckets).withColumn("node", F.expr(f"int(part div {FAN})"))
    each = hashes.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    out = (leaves.groupBy("bucket", "node").cogroup(each.groupBy("bucket", "node"))
           .applyInArrow(_vector, "bucket long, node int, docs binary"))
    while nodes > 1:
        nodes = -(-nodes // FAN)
        out = (out.withColumn("node", F.expr(f"int(node div {FAN})")).groupBy("bucket", "node")
               .applyInArrow(_summed, "bucket long, node int, docs binary"))
    return out.select("bucket", "docs")


def pair_table(encoded: DataFrame, raws, bits_b: int) -> DataFrame:
    """pair, a, docs, best of every pair linked in the corpus: the documents
    that hold it, and whether no pair of the same A id has more."""
    counts = written(task_counts(encoded, raws), "pair-counts")
    distinct = written(counts.select("pair").distinct(), "pairs")
    made, buckets = perfect_hash(distinct, distinct.count())
    hashes = written(made, "pair-hash").select("bucket", "levels", "vectors", "keys")
    vectors = count_vectors(counts, hashes, buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, docs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                k = np.frombuffer(keys, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(k >> bits_b), pa.array(np.frombuffer(docs, np.int64))],
                                                 names=["pair", "a", "docs"])

    table = written(arrow_map(hashes.join(vectors, "bucket").select("keys", "docs"), rows, "pair long, a long, docs long"),
                    "pair-docs")
    # one row per A id: at most the vocabulary, whose file's size is bounded
    most = F.broadcast(table.groupBy("a").agg(F.max("docs").alias("_most")))
    return written(table.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("_most")).cast("byte").alias("best")),
                   "pair-table")


class Lookup:
    """The resident pairs: documents and best by slot, keys verified."""

    def __init__(self, rows: list[dict]):
        self.hash = PerfectHash([np.frombuffer(r["levels"], np.int64) for r in rows],
                                [np.frombuffer(r["vectors"], np.uint64) for r in rows])
        joined = lambda name, kind: np.frombuffer(b"".join(r[name] for r in rows), kind)
        self.keys, self.docs, self.best = joined("keys", np.int64), joined("docs", np.int64), joined("best", np.int8)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """Slot of each pair, -1 if it is not resident."""
        if not len(self.keys):
            return np.full(len(pairs), -1, dtype=np.int64)
        some, at = np.unique(pairs, return_inverse=True)
        slot = self.hash.slots(some)
        slot[self.keys[slot] != some] = -1
        return slot[at]


def _least_count(pairs: DataFrame, resident_pairs: int) -> int:
    """The least power of two such that no more than ``resident_pairs`` pairs
    are in at least so many documents."""
    bins = pairs.groupBy(F.floor(F.log2(F.col("docs") + F.lit(0.5))).cast("int").alias("b")).count().collect()
    have = {r["b"]: r["count"] for r in bins}  # 63 rows at most
    least, total = 64, 0
    for b in range(63, -1, -1):
        total += have.get(b, 0)
        if total > resident_pairs:
            break
        least = b
    return 1 << min(least, 62)


_OUT = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                  ("groups", pa.string())])
_REST = pa.schema([("row", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          resident_pairs: int = RESIDENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every row.

    ``groups`` is the alignment itself, ``a1,a2|b1;a3|b2,b3`` with the ids in
    order; ``count_sum`` adds, over the links, the number of documents in which
    the pair of ids is linked, and ``n_best`` counts the links whose number is
    the highest of their A id.

    Defined cases: a null or empty text, and one whose A or B tokens do not
    spell a space and the text, has no tokens: zeros and an empty string.
    Every row, repeated ones and null doc_ids included, is a document and gives
    one row; special strings in a text are plain text; a very long text is
    held whole with its ids (about 60 times its bytes in a worker); other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    a, b = broadcast_vocab(spark, path_a), broadcast_vocab(spark, path_b or default_piece_path())
    raws = lambda: (a.value, b.value)
    bits_b = Pair(*raws()).bits_b
    encoded = written(encode(docs, raws), "token-ids")
    pairs = pair_table(encoded, raws, bits_b)
    least = _least_count(pairs, resident_pairs)
    head = pairs.where(F.col("docs") >= least)
    made, buckets = perfect_hash(head, head.count())
    # RESIDENT pairs at most, by the count above
    found = {r["bucket"]: r.asDict() for r in made.collect()}
    empty = {"levels": b"", "vectors": b"", "keys": b"", "docs": b"", "best": b""}
    table = spark.sparkContext.broadcast([{k: bytes(v) for k, v in found.get(i, empty).items() if k in empty}
                                          for i in range(buckets)])
    token = table.id if hasattr(table, "id") else id(table)
    app = spark.sparkContext.applicationId

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        pair, lookup = resident(("aligner", app, token), lambda: (Pair(*raws()), Lookup(table.value)))
        for batch in slices(batches, "ids_a", IDS_BYTES):
            x = Aligned(pair, batch.column(2), batch.column(3))
            yield batch, x, lookup, lookup(x.links)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, lookup, slot in aligned(batches):
            here = slot >= 0
            value = lambda v: np.where(here, v[slot], 0).astype(np.int64) if len(v) else np.zeros(len(slot), np.int64)
            yield emit(_OUT, doc_id=batch.column(0), row=batch.column(1), n_a=np.diff(x.a_off), n_b=np.diff(x.b_off),
                       n_groups=np.diff(x.group_off), n_links=np.diff(x.link_off), n_best=x.sums(value(lookup.best)),
                       count_sum=x.sums(value(lookup.docs)), groups=x.groups())

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x, _, slot in aligned(batches):
            out = np.flatnonzero(slot < 0)
            row = np.asarray(batch.column(1), dtype=np.int64)[x.link_doc[out]]
            order = np.lexsort((x.links[out], row))
            row, link = row[order], x.links[out][order]
            first = np.ones(len(row), dtype=bool)
            first[1:] = (row[1:] != row[:-1]) | (link[1:] != link[:-1])
            at = np.flatnonzero(first)
            yield emit(_REST, row=row[at], pair=link[at], n=np.diff(np.append(at, len(row))))

    columns = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    out = arrow_map(encoded.select("doc_id", "row", "ids_a", "ids_b"), run, columns)
    if least > 1:  # pairs beyond the resident ones
        others = arrow_map(encoded.select("doc_id", "row", "ids_a", "ids_b"), rest, "row long, pair long, n long")
        more = (others.join(pairs.where(F.col("docs") < least), "pair").groupBy("row")
                .agg(F.sum(F.col("n") * F.col("best")).alias("_best"), F.sum(F.col("n") * F.col("docs")).alias("_docs")))
        out = (out.join(more, "row", "left")
               .withColumn("n_best", F.col("n_best") + F.coalesce("_best", F.lit(0)))
               .withColumn("count_sum", F.col("count_sum") + F.coalesce("_docs", F.lit(0))))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
