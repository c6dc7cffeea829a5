"""Approximate nearest neighbours by a hash-prefix forest.

Each of ``TREES`` trees gives a vector one long hash string: ``SYMBOLS``
cross-polytope symbols (the nearest signed axis after a pseudo-random
rotation), written as bits.  A tree is the sorted array of the strings; the
vectors below an inner node of the tree, a prefix, are a range of the array.

A query descends each tree to its longest matching prefix, then all trees
ascend together, one bit at a time, until the ranges hold as many rows in all
as a sample of queries needs to find the share ``TARGET`` of its exact
neighbours (``CANDIDATES`` at least).  The rows in the ranges at that depth are scored exactly.

On Spark the arrays of all trees are one table, range-partitioned and sorted by
(tree, string) and numbered, so a range is an interval of numbers.  First the
strings alone: in blocks of ``BLOCK`` rows, with ``HALO`` rows of the
neighbours, each query finds its ranges at all depths.  The few ranges that
reach a block's edge are found exactly by an aggregate over the prefix.  Then
the vectors: each row lies in one block, each query goes to the blocks its
ranges touch and scores its share of them there.  Memory is bounded by the
block, whatever the number of equal strings, and no range is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, parallelism, ship, written
from cabflow.llm.vector_dedup import rotated

TREES = 44
#: Symbols of a string, and the most bits of a string (fewer symbols beyond).
SYMBOLS, MOST_BITS = 4, 48
#: Rows in the ranges of all trees that end the ascent, at least; more where
#: ``SAMPLE`` queries of a length, searched exactly, have less than the share
#: ``TARGET`` of their neighbours in the ranges.  Lengths beyond the ``LENGTHS``
#: most frequent are searched whole.
CANDIDATES, SAMPLE, TARGET, LENGTHS = 18_000, 128, 0.95, 16
#: Rows of a block, and rows of its neighbours that it sees on either side.
BLOCK, HALO = 8192, 1024
_ROWS = 2048


def valid(column: str):
    """Vectors that take part: not null or empty, finite, not zero."""
    c = F.col(column)
    return F.coalesce(
        (F.size(c) > 0) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(c, lambda x: x != 0), F.lit(False))


def layout(d: int) -> tuple[int, int, int]:
    """Padded width, bits of a symbol (axis and sign, none cut off) and symbols
    of a string for vectors of ``d`` components."""
    wide = 1 << max(1, (d - 1).bit_length())
    bits = (2 * wide - 1).bit_length()
    return wide, bits, min(SYMBOLS, max(1, MOST_BITS // bits))


def strings(x: np.ndarray, tree: int) -> np.ndarray:
    """The tree's hash string of each row (any length; rows of one width)."""
    n, d = x.shape
    wide, bits, symbols = layout(d)
    padded = np.zeros((n, wide))
    padded[:, :d] = x
    out = np.zeros(n, dtype=np.int64)
    for k in range(symbols):
        r = rotated(padded, 7_000_000 + 1000 * tree + k)
        axis = np.abs(r).argmax(axis=1)
        out = (out << bits) | (axis * 2 + (r[np.arange(n), axis] < 0))
    return out


def _stack(column: pa.Array) -> np.ndarray:
    a = column.cast(pa.large_list(pa.float64()))
    return a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1)


_STRING = pa.schema([("tree", pa.int32()), ("code", pa.int64()), ("rep", pa.int64()), ("asks", pa.bool_())])


def _by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return [(at, _stack(column.take(pa.array(at)))) for d in np.unique(size) for at in [np.flatnonzero(size == d)]]


def _forest(classes: DataFrame, trees: int, lengths: dict[int, tuple[int, float, bool]]) -> DataFrame:
    """tree, code, rep, asks: every class's string in every tree, and those of
    the classes that hold a query once more as queries.  Each vector length has
    its own trees.

    ``lengths``: number, longest norm, and whether all norms are equal, of each
    vector length.  If they are not, largest inner product becomes smallest
    angle by one more component: sqrt(longest**2 - |x|**2) for rows, 0 for
    queries; it is added to all vectors of the length or to none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, _ROWS):
                part = b.slice(s, _ROWS)
                for at, x in _by_length(part.column(2)):
                    rep = part.column(0).to_numpy()[at]
                    asks = part.column(1).to_numpy(zero_copy_only=False).astype(bool)[at]
                    number, longest, flat = lengths[x.shape[1]]
                    if flat:
                        data = query = x
                    else:
                        y = x / longest
                        extra = np.sqrt(1 - np.minimum((y * y).sum(axis=1), 1.0))[:, None]
                        data = np.concatenate([y, extra], axis=1)
                        query = np.concatenate([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros_like(extra)], axis=1)
                    for t in range(trees):
                        code = strings(data, t)
                        asked = code[asks] if data is query else strings(query[asks], t)
                        yield emit(_STRING, tree=np.full(len(rep) + len(asked), number * trees + t, np.int32),
                                   code=np.concatenate([code, asked]), rep=np.concatenate([rep, rep[asks]]),
                                   asks=np.concatenate([np.zeros(len(rep), bool), np.ones(len(asked), bool)]))

    return arrow_map(classes.select("rep", "asks", "vector"), run, "tree int, code long, rep long, asks boolean")


def _numbered(forest: DataFrame) -> DataFrame:
    """The forest with pos, each row's place in the order (tree, code, rep)."""
    spark = forest.sparkSession
    base = F.lit(1 << 33)
    forest = written(forest, "strings")  # sampled for the ranges, then dealt
    order = written(forest.repartitionByRange(parallelism(spark), "tree", "code", "rep", "asks")
                    .sortWithinPartitions("tree", "code", "rep", "asks")
                    .withColumn("at", F.monotonically_increasing_id()), "forest")
    # partition number above bit 33, row number in the partition below
    counts = (order.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy("p").collect())  # one row a partition
    first, total = [], 0
    for r in counts:
        first.append((r["p"], total))
        total += r["n"]
    starts = spark.createDataFrame(first or [(0, 0)], "p long, first long")
    return (order.withColumn("p", F.shiftright("at", 33)).join(F.broadcast(starts), "p")
            .select("tree", "code", "rep", "asks", (F.col("first") + F.col("at") % base).alias("pos")))


def _blocked(numbered: DataFrame, block: int, halo: int) -> DataFrame:
    """Rows with their block; data rows near an edge once more for the
    neighbouring block, which sees them."""
    here = F.floor(F.col("pos") / block).cast("long")
    inside = F.col("pos") % block
    near = F.filter(F.array(here,
                            F.when(~F.col("asks") & (inside < halo) & (here > 0), here - 1),
                            F.when(~F.col("asks") & (inside >= block - halo), here + 1)), lambda b: b.isNotNull())
    return numbered.select("tree", "code", "rep", "asks", "pos", F.explode(near).alias("block"))


def _ranges(tree, code, at_tree, at_code, depth: int, bits: int):
    """Range of the sorted (tree, code) rows that share ``depth`` bits with
    each asked (tree, code); trees numbered from 0 in the block."""
    rest = np.uint64(bits - depth)
    key = lambda t, c: ((t.astype(np.uint64) << np.uint64(bits)) | c.astype(np.uint64)) >> rest
    rows, asked = key(tree, code), key(at_tree, at_code)
    return np.searchsorted(rows, asked, "left"), np.searchsorted(rows, asked, "right")


_FOUND = pa.schema([("rep", pa.int64()), ("tree", pa.int32()), ("code", pa.int64()), ("lo", pa.list_(pa.int64())),
                    ("hi", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("open", pa.list_(pa.bool_()))])


def _find_ranges(t: pa.Table, bits: int) -> pa.Table:
    """For each query of a block and each depth: the interval of numbers of the
    rows that share so many bits, their count, and whether the interval reaches
    the edge of what the block sees (then it may go on beyond)."""
    t = t.sort_by("pos")
    asks = t.column("asks").to_numpy()
    tree, code, rep, pos = (t.column(c).to_numpy() for c in ("tree", "code", "rep", "pos"))
    number = np.unique(tree, return_inverse=True)[1]  # a block has few trees: they fit above the string's bits
    at = pos[~asks]
    m = int(asks.sum())
    lo, hi, n = (np.zeros((m, bits + 1), dtype=np.int64) for _ in range(3))
    edge = np.zeros((m, bits + 1), dtype=bool)
    if len(at):
        for depth in range(bits + 1):
            a, b = _ranges(number[~asks], code[~asks], number[asks], code[asks], depth, bits)
            n[:, depth] = b - a
            lo[:, depth] = at[np.minimum(a, len(at) - 1)]
            hi[:, depth] = np.where(b > a, at[np.maximum(b, 1) - 1] + 1, lo[:, depth])
            edge[:, depth] = (a == 0) | (b == len(at))
    else:
        edge[:] = True
    return pa.table({"rep": rep[asks], "tree": tree[asks], "code": code[asks], "lo": list(lo), "hi": list(hi),
                     "n": list(n), "open": list(edge)}, schema=_FOUND)


def _exact_nearest(stands: DataFrame, samples: dict[int, tuple[list[int], np.ndarray]], k: int) -> DataFrame:
    """q, rep: the k classes nearest to each sampled query, all rows compared.

    ``samples``: reps and vectors of the sampled queries of each length."""
    out = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for s in range(0, b.num_rows, _ROWS):
                part = b.slice(s, _ROWS)
                for at, x in _by_length(part.column(1)):
                    if (asked := samples.get(x.shape[1])) is None:
                        continue
                    rep = part.column(0).to_numpy()[at]
                    for q, scores in zip(asked[0], asked[1] @ x.T, strict=True):
                        other = rep != q
                        old = best.get(q, (np.zeros(0), np.zeros(0, np.int64)))
                        score = np.concatenate([old[0], scores[other]])
                        who = np.concatenate([old[1], rep[other]])
                        top = np.argsort(-score, kind="stable")[:k]
                        best[q] = score[top], who[top]
        for q, (score, who) in best.items():
            yield emit(out, q=np.full(len(who), q), rep=who, score=score)

    found = arrow_map(stands.select("rep", "vector"), run, "q long, rep long, score double")
    return found.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "rep"))),
                                          1, k).alias("best")).select("q", F.explode("best.rep").alias("rep"))


def _levels(found: DataFrame, bits: int) -> DataFrame:
    """rep, n: rows in each query's ranges of all trees, by depth."""
    return (found.groupBy("rep").agg(*[F.sum(F.col("n")[d]).alias(f"n{d}") for d in range(bits + 1)])
            .select("rep", F.array(*[f"n{d}" for d in range(bits + 1)]).alias("n")))


def _enough(stands: DataFrame, numbered: DataFrame, levels: DataFrame, lengths: list[int], bits: int, k: int,
            least: int, target: float) -> dict[int, int]:
    """Candidates of each length with which the share ``target`` of the k
    exact neighbours of ``SAMPLE`` queries lies in the ranges, ``least`` at
    least."""
    samples = {}
    for d in lengths:
        asked = (stands.where(F.col("asks") & (F.size("vector") == d)).orderBy(F.xxhash64("rep"), "rep")
                 .select("rep", F.col("vector").cast("array<double>").alias("vector")).limit(SAMPLE).collect())
        if asked:
            samples[d] = [r["rep"] for r in asked], np.array([r["vector"] for r in asked])
    if not samples:
        return {}
    pairs = written(_exact_nearest(stands, samples, k), "ann_sample")
    theirs = (numbered.where(~F.col("asks")).join(F.broadcast(pairs), "rep")
              .select("q", "rep", "tree", F.col("code").alias("their")))
    mine = numbered.where("asks").join(F.broadcast(pairs.select(F.col("q").alias("rep")).distinct()), "rep").select(
        F.col("rep").alias("q"), "tree", "code")
    differ = F.col("code").bitwiseXOR(F.col("their"))
    shared = (theirs.join(mine, ["q", "tree"])
              .withColumn("common", F.when(differ == 0, bits).otherwise(bits - F.length(F.bin(differ))))
              .groupBy("q", "rep").agg(F.max("common").alias("common")))
    # a neighbour is missed where the ascent ends deeper than its common prefix
    needs = (shared.join(levels.withColumnRenamed("rep", "q"), "q")
             .select("q", F.when(F.col("common") == bits, 0).otherwise(F.col("n")[F.col("common") + 1] + 1).alias("need"))
             .collect())  # k rows of each sampled query
    length_of = {q: d for d, (reps, _) in samples.items() for q in reps}
    need: dict[int, list[int]] = {}
    for r in needs:
        need.setdefault(length_of[r["q"]], []).append(r["need"])
    return {d: max(least, sorted(v)[math.ceil(target * len(v)) - 1]) for d, v in need.items()}


def _intervals(found: DataFrame, numbered: DataFrame, levels: DataFrame, candidates, trees: int, bits: int) -> DataFrame:
    """rep, tree, lo, hi: each query's interval in each tree at the depth where
    all trees' intervals together hold its ``candidates`` rows; without such a
    depth one tree whole."""
    levels = levels.join(candidates, "rep")
    deepest = F.coalesce(*[F.when(F.col("n")[d] >= F.col("candidates"), F.lit(d)) for d in range(bits, -1, -1)], F.lit(0))
    depths = written(levels.select("rep", deepest.cast("int").alias("depth")), "ann_depths")
    at = lambda c: F.element_at(c, F.col("depth") + 1)
    picked = written(found.join(depths, "rep").where((F.col("depth") > 0) | (F.col("tree") % trees == 0)).select(
        "rep", "tree", "depth", F.expr(f"shiftright(code, {bits} - depth)").alias("prefix"),
        at("lo").alias("lo"), at("hi").alias("hi"), at("open").alias("open")), "ann_picked")
    # the open ones: first and last number of their prefix, over all rows
    used = sorted(r["depth"] for r in picked.where("open").select("depth").distinct().collect())  # a few depths
    closed = picked.where(~F.col("open")).select("rep", "tree", "lo", "hi")
    if not used:
        return closed
    prefix = ["tree", "depth", "prefix"]
    ends = (numbered.where(~F.col("asks")).withColumn("depth", F.explode(F.array(*[F.lit(d) for d in used])))
            .withColumn("prefix", F.expr(f"shiftright(code, {bits} - depth)"))
            .groupBy(*prefix).agg(F.min("pos").alias("lo"), (F.max("pos") + 1).alias("hi")))
    return closed.unionAll(picked.where("open").select("rep", *prefix).join(written(ends, "ann_ends"), prefix)
                           .select("rep", "tree", "lo", "hi"))


def _scores(best: int):
    out = pa.schema([("rep", pa.int64()), ("found", pa.int64()), ("score", pa.float64())])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("lo")
        asks = t.column("asks").to_numpy()
        rep, lo, hi = (t.column(c).to_numpy() for c in ("rep", "lo", "hi"))
        q, f, s = [], [], []
        if asks.any() and not asks.all():
            for at, x in _by_length(t.column("vector").combine_chunks()):
                ask = asks[at]
                if ask.all() or not ask.any():
                    continue
                ids, rows, pos = rep[at][~ask], x[~ask], lo[at][~ask]
                first, last = np.searchsorted(pos, lo[at][ask]), np.searchsorted(pos, hi[at][ask])
                for r, v, a, b in zip(rep[at][ask].tolist(), x[ask], first.tolist(), last.tolist(), strict=True):
                    if a >= b:
                        continue
                    score, who = rows[a:b] @ v, ids[a:b]
                    if b - a > best:  # keep all ties of the last place
                        k = score >= np.partition(score, b - a - best)[b - a - best]
                        score, who = score[k], who[k]
                    k = np.lexsort((who, -score))[:best]
                    q.append(np.full(len(k), r))
                    f.append(who[k])
                    s.append(score[k])
        return pa.table({"rep": np.concatenate(q) if q else [], "found": np.concatenate(f) if f else [],
                         "score": np.concatenate(s) if s else []}, schema=out)

    return run


def _smallest_ids(members: DataFrame, k: int) -> DataFrame:
    """rep, ids: the k smallest vec_ids of each class.  Ranks are taken over
    ever coarser deals of a class's rows, so that no task holds a class."""
    rows = members.select("rep", "vec_id").distinct()
    for salts in (256, 32, 4):
        w = Window.partitionBy("rep", "salt").orderBy("vec_id")
        rows = (rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(salts)), F.lit(salts)))
                .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k).select("rep", "vec_id"))
    return rows.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k).alias("ids"))


def search(vectors: DataFrame, is_query, column: str = "embedding", k: int = 20, trees: int = TREES,
           candidates: int = CANDIDATES, block: int = BLOCK, halo: int = HALO, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the largest inner product
    found for each row with ``is_query`` (a condition on vec_id), the query's
    own row excepted, nearest first, ties to the smaller vec_id.

    Rows with equal vectors are searched as one and listed each for itself.
    Defined cases: vectors that are null, empty or zero or hold null or
    non-finite components, and null vec_ids, take no part; vectors of different
    lengths never meet; repeated rows (same vec_id and
    vector) are one; fewer than k rows give all of them, one row alone gives
    nothing; other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vector")) \
        .where(F.col("vec_id").isNotNull() & valid("vector"))
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.hash("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    sizes = (rows.groupBy(F.size("vector").alias("d"))
             .agg(F.max(norm).alias("longest"), F.min(norm).alias("shortest")).orderBy("d").collect())  # a row a length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = {r["d"]: (i, r["longest"], r["shortest"] >= r["longest"] * (1 - 1e-6)) for i, r in enumerate(sizes)}
    widths = [layout(d if flat else d + 1) for d, (_, _, flat) in lengths.items()]
    bits = max(b * symbols for _, b, symbols in widths)
    members = written(rows.select("vec_id", "h1", "h2", is_query.alias("asks")), "ann_rows")
    classes = written(members.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.max("asks").alias("asks")),
                      "ann_classes")
    members = written(members.join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("vec_id", "rep", "asks"),
                      "ann_members")
    stands = written(rows.select("vec_id", "h1", "h2", "vector")
                     .join(classes.withColumnRenamed("asks", "any"),
                           (F.col("vec_id") == F.col("rep")) & rows["h1"].eqNullSafe(classes["h1"])
                           & rows["h2"].eqNullSafe(classes["h2"]))
                     .select("rep", F.col("any").alias("asks"), "vector").dropDuplicates(["rep"]), "ann_vectors")
    numbered = written(_numbered(_forest(stands, trees, lengths)), "ann_numbered")
    ship(spark)
    found = written(_blocked(numbered, block, halo).groupBy("block").applyInArrow(
        lambda t: _find_ranges(t, bits), "rep long, tree int, code long, lo array<long>, hi array<long>, n array<long>, open array<boolean>"),
        "ann_ranges")
    levels = written(_levels(found, bits), "ann_levels")
    held = stands.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").collect()
    asked = [r["d"] for r in held if r["n"] * trees > candidates][:LENGTHS]
    enough = _enough(stands, numbered, levels, asked, bits, k, candidates, target)
    wanted = spark.createDataFrame([(d, enough.get(d, 1 << 62)) for d in lengths], "d int, candidates long")
    wanted = stands.where("asks").select("rep", F.size("vector").alias("d")).join(F.broadcast(wanted), "d").drop("d")
    intervals = written(_intervals(found, numbered, levels, wanted, trees, bits).where("hi > lo"), "ann_intervals")
    place = F.floor(F.col("lo") / block).cast("long")
    visits = intervals.select(
        F.explode(F.sequence(place, F.floor((F.col("hi") - 1) / block).cast("long"))).alias("block"),
        "rep", F.lit(True).alias("asks"), "lo", "hi")
    rows = numbered.where(~F.col("asks")).select(F.floor(F.col("pos") / block).cast("long").alias("block"), "rep", "asks",
                                                 F.col("pos").alias("lo"), (F.col("pos") + 1).alias("hi"))
    hits = (rows.unionAll(visits).join(stands.select("rep", "vector"), "rep")
            .groupBy("block").applyInArrow(_scores(k + 1), "rep long, found long, score double"))
    hits = written(hits.groupBy("rep", "found").agg(F.max("score").alias("score")), "ann_hits")
    ids = written(_smallest_ids(members, k + 1), "ann_ids")
    best = (hits.join(ids, hits["found"] == ids["rep"]).select(hits["rep"], "score", F.explode("ids").alias("vec_id"))
            .groupBy("rep").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))),
                                        1, k + 1).alias("best")))
    best = written(best, "ann_best")
    asked = members.where("asks").select(F.col("vec_id").alias("query_id"), "rep").distinct()
    ranked = asked.join(best, "rep").select(
        "query_id", F.posexplode(F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
                         (-F.col("col.minus")).alias("score"))
