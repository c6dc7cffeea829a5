"""Near-duplicate vectors by cross-polytope hashing.

1. Each vector is turned by pseudo-random rotations, three rounds of random
   signs and a fast Hadamard transform; the axis nearest to the result, with
   its sign, is one symbol.  ``SYMBOLS`` symbols make a table's bucket key.
2. Multiprobe: in each of the ``TABLES`` tables a vector lies in ``PROBES``
   buckets, those of the nearest axes by total distance to the best.  A pair
   at cosine 0.95 shares a bucket of one table with probability 0.84 (64
   components), and misses all eight tables with about 4e-7.
3. Equal vectors are one class; classes in a bucket are verified by cosine in
   double precision, in blocks (``bucket_links``); links give components.
4. All links lie inside components: each component's vectors are compared in
   blocks, and each vector counts the vectors it links with.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.bucket_links import blocks_of, bucket_components
from cabflow.llm.common import arrow_map, emit, mix64, parallelism, written
from cabflow.llm.signature_tree import Links

TABLES, SYMBOLS, PROBES, CHOICES = 8, 4, 12, 3
#: Classes compared at a time when linking.
BLOCK, ACROSS = 128, 512
#: Counting: a component of up to COUNT_BLOCK classes is one block; a larger one
#: is dealt into COUNT_SPLIT blocks at most, until these would be larger than
#: COUNT_MOST.  So pairs of blocks spread a middling component over tasks, and a
#: class is copied max(COUNT_SPLIT, classes / COUNT_MOST) times.
COUNT_BLOCK, COUNT_SPLIT, COUNT_MOST = 128, 8, 4096
#: Rows of a product of two blocks held at a time.
_STRIP = 512
#: Rows hashed at a time.
_ROWS = 2048

_COMBOS = np.array(list(itertools.product(range(CHOICES), repeat=SYMBOLS)))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of the rows (length a power of 2)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and Hadamard transform."""
    signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def bucket_keys(x: np.ndarray) -> np.ndarray:
    """TABLES * PROBES bucket keys of each unit row."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = x
    m = min(CHOICES, wide)
    out = np.zeros((n, TABLES, PROBES), dtype=np.uint64)
    for table in range(TABLES):
        symbols, gaps = [], []
        for k in range(SYMBOLS):
            r = rotated(padded, 1000 * table + k)
            size = np.abs(r)
            top = np.argsort(-size, axis=1, kind="stable")[:, :m]
            if m < CHOICES:
                top = np.concatenate([top, np.repeat(top[:, -1:], CHOICES - m, axis=1)], axis=1)
            symbols.append(top * 2 + (np.take_along_axis(r, top, 1) < 0))
            best = np.take_along_axis(size, top, 1)
            gaps.append((best[:, :1] - best) ** 2)
        total = sum(g[:, _COMBOS[:, k]] for k, g in enumerate(gaps))
        probes = _COMBOS[np.argsort(total, axis=1, kind="stable")[:, :PROBES]]
        key = np.full((n, PROBES), table + 1, dtype=np.uint64)
        for k, s in enumerate(symbols):
            key = mix64(key * np.uint64(1_000_003) + np.take_along_axis(s, probes[:, :, k], 1).astype(np.uint64))
        out[:, table] = mix64(key + np.uint64(d))  # vectors of other lengths never meet
    return out.reshape(n, -1)


def matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double) of the valid vectors, one entry
    per length.  Null, empty and zero vectors and those with null or non-finite
    components are left out."""
    a = column.cast(pa.large_list(pa.float64()))
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    flat = a.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    size = np.where(np.asarray(a.is_valid()), np.diff(off), 0)
    out = []
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        x = flat[off[rows][:, None] + np.arange(d)]
        top = np.abs(x).max(axis=1)  # scaled first: no overflow in the squares
        ok = np.isfinite(top) & (top > 0)
        x = x[ok] / top[ok][:, None]
        out.append((rows[ok], x / np.sqrt((x * x).sum(axis=1))[:, None]))
    return out


_PRINT = pa.schema([("vec_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in range(0, b.num_rows, _ROWS):
            part = b.slice(s, _ROWS)
            n = part.num_rows
            h1, h2, keys = [None] * n, [None] * n, [[]] * n
            raw = part.column(1).cast(pa.large_list(pa.float64()))
            for rows, x in matrix(part.column(1)):
                made = bucket_keys(x).astype(np.int64)
                for i, k in zip(rows.tolist(), made, strict=True):
                    v = raw[i].values.to_numpy() + 0.0  # -0 is 0
                    digest = np.frombuffer(hashlib.blake2b(v.tobytes(), digest_size=16).digest(), dtype=np.int64)
                    h1[i], h2[i], keys[i] = int(digest[0]), int(digest[1]), np.unique(k)
            yield emit(_PRINT, vec_id=part.column(0), h1=h1, h2=h2, keys=keys)


def _streamed(rows: DataFrame, fn, schema: str, spark_schema: str) -> DataFrame:
    """fn(list of rows of one group (rep, part, probe, count), unit vectors)
    for each group (g1, g2, g3); groups are streamed, one in memory at a time."""
    out = pa.schema(schema)
    dealt = (rows.repartition(parallelism(rows.sparkSession), "g1", "g2", "g3")
             .sortWithinPartitions("g1", "g2", "g3", "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, vectors = None, [], []
        for b in batches:
            cols = [c.to_pylist() for c in b.columns[:7]]
            units = {}
            for at, x in matrix(b.column(7)):
                units.update(zip(at.tolist(), x, strict=True))
            for k, row in enumerate(zip(*cols, strict=True)):
                if row[:3] != group:
                    if len(held) > 1 and (found := fn(held, np.array(vectors))) is not None:
                        yield emit(out, **found)
                    group, held, vectors = row[:3], [], []
                if k not in units or (held and held[-1][0] == row[3] and held[-1][2] == row[5]):
                    continue  # another row of the same vec_id
                held.append(row[3:])
                vectors.append(units[k])
        if len(held) > 1 and (found := fn(held, np.array(vectors))) is not None:
            yield emit(out, **found)

    return arrow_map(dealt, run, spark_schema)


def count_blocks(m: Column) -> Column:
    """Blocks of a component of m classes."""
    return F.least(blocks_of(m, COUNT_BLOCK), F.greatest(F.lit(COUNT_SPLIT).cast("long"), blocks_of(m, COUNT_MOST)))


def _linked_weight(x: np.ndarray, wx: np.ndarray, y: np.ndarray, wy: np.ndarray, least: float):
    """For each row of x the weight of the rows of y it links with, and the
    other way around; strips of x at a time.  A row does not link with itself."""
    nx, ny = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
    for s in range(0, len(x), _STRIP):
        link = x[s:s + _STRIP] @ y.T >= least
        if x is y:
            link[np.arange(len(link)), s + np.arange(len(link))] = False
        nx[s:s + _STRIP] = link @ wy
        ny += link.T @ wx[s:s + _STRIP]
    return nx, ny


def _linker(vectors: DataFrame, least: float):
    def group_links(held, x):
        ids = [r[0] for r in held]
        parts = [r[1] for r in held]
        links = Links(parts)
        probe = held[0][2] is not None
        fore = np.array([k for k, r in enumerate(held) if not probe or r[2]], dtype=np.int64)
        back = np.array([k for k, r in enumerate(held) if not probe or not r[2]], dtype=np.int64)
        a, b = [], []
        if len(fore) and len(back):
            for i in fore.tolist():
                for j in back[(x[back] @ x[i]) >= least].tolist():
                    if links.find(parts[i]) != links.find(parts[j]):
                        links.join(parts[i], parts[j])
                        a.append(ids[i])
                        b.append(ids[j])
        return {"a": a, "b": b} if a else None

    def links(groups: DataFrame) -> DataFrame:
        rows = groups.join(vectors, "rep").select("g1", "g2", "g3", "rep", "part", "probe",
                                                  F.lit(1).cast("long").alias("count"), "vector")
        return _streamed(rows, group_links, [("a", pa.int64()), ("b", pa.int64())], "a long, b long")

    return links


def _link_counts(members: DataFrame, least: float) -> DataFrame:
    """rep, n: vectors of other classes linked, for members (component, rep,
    count, vector): pairs of blocks of each component."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("m")).select(
        "component", count_blocks(F.col("m")).alias("nb"))
    rows = members.join(written(sizes, "sizes"), "component").withColumn(
        "mine", F.pmod(F.xxhash64("rep"), F.col("nb"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    # a pair of blocks is one group; probe tells its two sides apart
    dealt = rows.select(F.col("component").alias("g1"), F.least("mine", "other").alias("g2"),
                        F.greatest("mine", "other").alias("g3"), "rep", F.col("component").alias("part"),
                        F.when(F.col("mine") != F.col("other"), F.col("mine") < F.col("other")).alias("probe"),
                        "count", "vector")

    def counts(held, x):
        ids = np.array([r[0] for r in held])
        weight = np.array([r[3] for r in held])
        if held[0][2] is None:
            n, _ = _linked_weight(x, weight, x, weight, least)
        else:
            side = np.array([bool(r[2]) for r in held])
            n = np.zeros(len(held), dtype=np.int64)
            n[side], n[~side] = _linked_weight(x[side], weight[side], x[~side], weight[~side], least)
        return {"rep": ids[n > 0], "n": n[n > 0]}

    out = _streamed(dealt, counts, [("rep", pa.int64()), ("n", pa.int64())], "rep long, n long")
    return out.groupBy("rep").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, column: str = "embedding", least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row (vec_id, vector).

    Vectors link at a cosine of at least ``least``.  Defined cases: null,
    empty and zero vectors and those with null or non-finite components link
    with nothing; vectors of different lengths never link; equal vectors link,
    repeated rows included; rows with a null vec_id link with nothing and are
    not kept; each row gives one row; other columns are not read; an empty
    table gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    prints = written(arrow_map(rows, _print, "vec_id long, h1 long, h2 long, keys array<long>"), "vec_prints")
    usable = F.col("h1").isNotNull() & F.col("vec_id").isNotNull()
    classes = written(prints.where(usable).groupBy("h1", "h2")
                      .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("count")), "vec_classes")
    reps = classes.select("rep", "count")
    entries = (prints.where(usable).join(reps, F.col("vec_id") == F.col("rep"), "left_semi")
               .select(F.explode("keys").alias("key"), F.col("vec_id").alias("rep")))
    stands = written(rows.select(F.col("vec_id").alias("rep"), "vector").where(F.col("vector").isNotNull())
                     .join(reps.select("rep"), "rep", "left_semi").distinct(), "vec_stands")
    parts = bucket_components(entries, lambda items: _linker(stands, least), BLOCK, ACROSS)
    members = (parts.join(reps, F.col("node") == F.col("rep")).select("component", "rep", "count")
               .join(stands, "rep"))
    counts = written(_link_counts(members, least), "vec_counts")
    labelled = written(
        classes.join(parts, F.col("rep") == F.col("node"), "left").join(counts, "rep", "left")
        .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("count") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "vec_labelled")
    linked = prints.where(usable).select("vec_id", "h1", "h2").join(labelled, ["h1", "h2"]).select(
        "vec_id", "n_links", "component_id")
    rest = prints.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    return linked.unionAll(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
