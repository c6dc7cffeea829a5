"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad.  The field's node scores are linear in
the features of the line and of its two neighbours; its edge scores couple
neighbouring lines.  Forward-backward gives each line's marginal probability
of being good; their mean, weighted by line length, is the document's score.

The field is fitted by gradient ascent on a bounded sample of labelled
documents, whose lines carry the document's label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import (arrow_map, emit, fresh, hashed_fraction, slices, span_hashes, text_buffer,
                                with_computed, word_bounds, written)

#: Labelled documents learned from, expected number (a hash of doc_id picks them).
SAMPLE_DOCS = 2500
#: Longest text learned from, in characters (longer ones are not picked).
SAMPLE_MAX_CHARS = 200_000
#: Lines learned from, expected number at most (fewer documents, if they hold more).
SAMPLE_LINES = 400_000
#: Bytes of text whose line features are held at a time (a longer line is one
#: piece), and lines of one chain passed at a time.
PIECE_BYTES, SEGMENT = 1 << 20, 256
ROUNDS, RATE, DECAY = 200, 0.1, 1e-5

LINE_FEATURES = ("symbols", "upper", "digits", "repeats", "lone marks", "marked words", "words", "word length",
                 "seen line", "letters", "stops", "short")
_K = len(LINE_FEATURES)
#: Node features: bias, the line's, the one before's, the one after's, and two
#: flags for a missing neighbour.
NODE_FEATURES = 1 + 3 * _K + 2

# byte classes
_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL = range(6)


def _byte_classes() -> np.ndarray:
    lut = np.full(256, _SYMBOL, dtype=np.uint8)
    lut[[9, 11, 12, 13, 32]] = _SPACE
    lut[10] = _SPACE
    lut[ord("a"):ord("z") + 1] = _LOWER
    lut[0x80:] = _LOWER  # letters beyond ASCII
    lut[ord("A"):ord("Z") + 1] = _UPPER
    lut[ord("0"):ord("9") + 1] = _DIGIT
    lut[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
    return lut


_CLASS = _byte_classes()


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all non-blank lines of the texts, on end.

    Returns the feature matrix, the line lengths in bytes without white space,
    and the offsets of each text's lines (a null or blank text has none).
    """
    x, size, offsets, _ = _features(*text_buffer(texts))
    return x, size, offsets


def _features(data: np.ndarray, off: np.ndarray):
    """``line_features`` of a text buffer, and the hashes of the lines."""
    n_docs = len(off) - 1
    cls = _CLASS[data]
    starts, ends = word_bounds(data, off, data == 10)
    blank_run = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(cls == _SPACE, out=blank_run[1:])
    space = blank_run[ends] - blank_run[starts]
    keep = space < ends - starts
    starts, ends, space = starts[keep], ends[keep], space[keep]
    n = len(starts)
    x = np.zeros((n, _K))
    doc = np.searchsorted(off, starts, side="right") - 1
    offsets = np.searchsorted(doc, np.arange(n_docs + 1))
    size = (ends - starts - space).astype(np.float64)
    if not n:
        return x, size, offsets, np.zeros(0, np.uint64)
    count = []
    run = np.zeros(len(data) + 1, dtype=np.int64)
    for c in (_LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL):
        np.cumsum(cls == c, out=run[1:])
        count.append(run[ends] - run[starts])
    lower, upper, digit, stop, symbol = count
    ws, we = word_bounds(data, off, cls == _SPACE)
    line = np.searchsorted(starts, ws, side="right") - 1
    words = np.maximum(np.bincount(line, minlength=n), 1)
    h = span_hashes(data, ws, we)
    again = np.zeros(len(ws), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    last = cls[we - 1] == _SYMBOL
    lone = (we - ws == 1) & last
    of_line = lambda flag: np.bincount(line, weights=flag, minlength=n) / words
    x[:, 0] = symbol / size
    x[:, 1] = upper / np.maximum(lower + upper, 1)
    x[:, 2] = digit / size
    x[:, 3] = of_line(again)
    x[:, 4] = of_line(lone)
    x[:, 5] = of_line(last & ~lone)
    x[:, 6] = np.log1p(words) / 5
    x[:, 7] = np.minimum(size / words, 30) / 10
    whole = span_hashes(data, starts, ends)
    order = np.lexsort((whole, doc))
    same = (whole[order][1:] == whole[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    x[order[1:], 8] = same
    x[:, 9] = (lower + upper) / size
    x[:, 10] = stop / size
    x[:, 11] = words < 4
    return x, size, offsets, whole


def _pieces(data: np.ndarray, off: np.ndarray, piece: int):
    """(start, end) of runs of about ``piece`` bytes that end after a line."""
    breaks = np.flatnonzero(data == 10) + 1
    ends = np.union1d(breaks, off[1:])
    s = 0
    while s < len(data):
        at = np.searchsorted(ends, s + piece)
        e = int(ends[min(at, len(ends) - 1)])
        yield s, e
        s = e


def line_scores(texts: pa.Array, weights: np.ndarray, piece: int = PIECE_BYTES):
    """Node score and length of every line and the offsets of each text's
    lines.  Features are held for one piece of text at a time; of what came
    before, only its lines' hashes (for "seen line") and scores are kept."""
    data, off = text_buffer(texts)
    parts = [weights[1 + k * _K:1 + (k + 1) * _K] for k in range(3)]
    scores, sizes, n_lines = [], [], np.zeros(len(off) - 1, dtype=np.int64)
    open_doc, seen = -1, np.zeros(0, np.uint64)  # the text a piece before ended in, its lines' hashes
    for s, e in _pieces(data, off, piece):
        x, size, at, whole = _features(data[s:e], np.clip(off, s, e) - s)
        if open_doc >= 0:
            lines = slice(at[open_doc], at[open_doc + 1])
            x[lines, 8] = np.maximum(x[lines, 8], np.isin(whole[lines], seen))
        last = int(np.searchsorted(off, e, side="left")) - 1
        if off[last + 1] > e:
            known = seen if last == open_doc else np.zeros(0, np.uint64)
            open_doc, seen = last, np.union1d(known, whole[at[last]:at[last + 1]])
        else:
            open_doc = -1
        scores.append(np.stack([x @ w for w in parts]))
        sizes.append(size)
        n_lines += np.diff(at)
    own, before, after = np.concatenate([np.zeros((3, 0)), *scores], axis=1)
    offsets = np.concatenate([[0], np.cumsum(n_lines)])
    node = weights[0] + own
    full = n_lines > 0
    first, final = np.zeros(len(node), dtype=bool), np.zeros(len(node), dtype=bool)
    first[offsets[:-1][full]] = True
    final[offsets[1:][full] - 1] = True
    node[1:] += np.where(first[1:], 0, before[:-1])
    node[:-1] += np.where(final[:-1], 0, after[1:])
    node += first * weights[-2] + final * weights[-1]
    return node, np.concatenate([np.zeros(0), *sizes]), offsets


def node_features(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bias, own, previous and next line's features, flags for no neighbour."""
    n = len(x)
    out = np.zeros((n, NODE_FEATURES))
    if not n:
        return out
    out[:, 0] = 1
    out[:, 1:1 + _K] = x
    first = np.zeros(n, dtype=bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    final = np.zeros(n, dtype=bool)
    final[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = True
    out[1:, 1 + _K:1 + 2 * _K] = x[:-1]
    out[first, 1 + _K:1 + 2 * _K] = 0
    out[:-1, 1 + 2 * _K:1 + 3 * _K] = x[1:]
    out[final, 1 + 2 * _K:1 + 3 * _K] = 0
    out[:, -2], out[:, -1] = first, final
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    return v / v.sum(axis=1, keepdims=True)


def _carried(emit_: np.ndarray, move: np.ndarray, begin: np.ndarray, size: np.ndarray, nth: np.ndarray):
    """What the chains of several segments carry over their cuts: the forward
    message into and the backward message to the end of every segment.

    A segment passes a message on as one 2 x 2 matrix; the matrices of all
    segments are made side by side, then each chain is passed segment by
    segment.
    """
    a_in, b_out = np.ones((len(begin), 2)), np.ones((len(begin), 2))
    heads = np.flatnonzero(nth == 0)
    count = np.diff(np.append(heads, len(nth)))
    heads, count = heads[count > 1], count[count > 1]
    if not len(heads):
        return a_in, b_out
    order = np.argsort(-count, kind="stable")
    heads, count = heads[order], count[order]
    of_long = np.concatenate([np.arange(h, h + c) for h, c in zip(heads.tolist(), count.tolist(), strict=True)])
    of_long = of_long[np.argsort(-size[of_long], kind="stable")]
    passed = np.tile(np.eye(2), (len(begin), 1, 1))
    for t in range(int(size[of_long[0]])):
        at = of_long[:int(np.searchsorted(-size[of_long], -t, side="left"))]
        m = passed[at]
        step = m @ move if t else np.where((nth[at] > 0)[:, None, None], m @ move, m)
        step = step * emit_[begin[at] + t][:, None, :]
        passed[at] = step / step.sum(axis=(1, 2), keepdims=True)
    alive = [int(np.searchsorted(-count, -k, side="left")) for k in range(int(count[0]))]
    for k in range(1, len(alive)):
        at = heads[:alive[k]] + k
        a_in[at] = _unit(np.einsum("ni,nij->nj", a_in[at - 1], passed[at - 1]))
    for k in range(len(alive) - 1, 0, -1):
        at = heads[:alive[k]] + k
        b_out[at - 1] = _unit(np.einsum("nij,nj->ni", passed[at], b_out[at]))
    return a_in, b_out


def forward_backward(node: np.ndarray, edge: np.ndarray, offsets: np.ndarray, pairs: bool = False,
                     segment: int = SEGMENT):
    """Marginals of all chains at once: chains are cut into segments, what they
    carry over the cuts comes first (exactly), then all segments go side by
    side, one step per line number.

    node: score of "good" per line ("bad": 0); edge: 2 x 2 scores.  Returns
    P(good) per line and, on demand, the summed probabilities of neighbouring
    label pairs.
    """
    n = len(node)
    total = np.zeros((2, 2))
    if not n:
        return np.zeros(0), total
    cuts = -(-np.diff(offsets) // segment)
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(offsets[:-1], cuts) + nth * segment
    lens = np.minimum(segment, np.repeat(offsets[1:], cuts) - begin)
    top = np.maximum(node, 0)
    emit_ = np.stack([np.exp(-top), np.exp(node - top)], axis=1)
    move = np.exp(edge - edge.max())
    a_in, b_out = _carried(emit_, move, begin, lens, nth)
    order = np.argsort(-lens, kind="stable")
    begin, lens, later, a_in, b_out = begin[order], lens[order], nth[order] > 0, a_in[order], b_out[order]
    a, b = np.empty((n, 2)), np.empty((n, 2))
    steps = int(lens[0])
    alive = [int(np.searchsorted(-lens, -t, side="left")) for t in range(steps)]  # segments longer than t
    for t in range(steps):
        at = begin[:alive[t]] + t
        before = a[at - 1] @ move if t else np.where(later[:, None], a_in @ move, 1.0)
        a[at] = _unit(before * emit_[at])
    b[begin + lens - 1] = b_out
    for t in range(steps - 1, 0, -1):
        at = begin[:alive[t]] + t
        right = emit_[at] * b[at]
        if pairs:
            total += _joint(a[at - 1], move, right)
        b[at - 1] = _unit(right @ move.T)
    if pairs:
        at = begin[later]
        total += _joint(a[at - 1], move, emit_[at] * b[at])
    p = a * b
    return p[:, 1] / p.sum(axis=1), total


def _joint(left: np.ndarray, move: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Summed probabilities of the label pairs of neighbouring lines."""
    joint = left[:, :, None] * move[None] * right[:, None, :]
    return (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def train(x: np.ndarray, offsets: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Maximum likelihood (with a small penalty) by Adam over all chains.
    good: one label per chain."""
    z = node_features(x, offsets)
    lens = np.diff(offsets)
    y = np.repeat(good, lens).astype(np.float64)
    inner = np.maximum(lens - 1, 0)
    seen = np.diag([float(inner[good == 0].sum()), float(inner[good == 1].sum())])
    theta = np.zeros(NODE_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = max(1, len(z))
    for i in range(1, rounds + 1):
        edge = theta[NODE_FEATURES:].reshape(2, 2)
        p, pair = forward_backward(z @ theta[:NODE_FEATURES], edge, offsets, pairs=True)
        g = np.concatenate([z.T @ (y - p), (seen - pair).ravel()]) / n - DECAY * theta
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        theta += RATE * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-9)
    prior = (float(good.sum()) + 1) / (len(good) + 2)
    return {"weights": theta[:NODE_FEATURES], "edge": theta[NODE_FEATURES:].reshape(2, 2), "prior": prior}


_SAMPLE = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("n_lines", pa.int64()), ("x", pa.binary())])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        x, _, off = line_features(b.column(2))
        x = x.astype(np.float32)
        yield emit(_SAMPLE, doc_id=b.column(0), quality=b.column(1), n_lines=np.diff(off),
                   x=[x[s:e].tobytes() for s, e in zip(off[:-1], off[1:], strict=True)])


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 2,
        sample_lines: int = SAMPLE_LINES) -> dict:
    """The field of documents (doc_id, text) and labels (doc_id, quality 0/1).

    Learns from about ``sample_docs`` labelled texts, from fewer if they hold
    more than about ``sample_lines`` lines.  Null texts, and
    qualities that are neither 0 nor 1, are left out; several labels of a
    document count as their majority (ties: good).  Without any labelled text
    all weights are 0 and every score is 0.5.
    """
    marked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))
    n = marked.count()
    picked = marked.where(hashed_fraction(F.col("doc_id"), seed) < min(1.0, sample_docs / max(1, n)))
    sample = (docs.where(F.length("text") <= SAMPLE_MAX_CHARS).select("doc_id", "text")
              .join(F.broadcast(picked), "doc_id")  # about sample_docs rows of two numbers
              .select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "text"))
    held = written(arrow_map(sample, _sample_features, "doc_id long, quality int, n_lines long, x binary"), "lines")
    lines = held.agg(F.sum("n_lines")).first()[0] or 0
    if lines > sample_lines:
        held = held.where(hashed_fraction(F.col("doc_id"), seed + 1) < sample_lines / lines)
    rows = held.select("quality", "x").collect()
    rows = sorted(((r["quality"], bytes(r["x"])) for r in rows if r["x"]))  # any order of tasks gives one model
    if not rows:
        return {"weights": np.zeros(NODE_FEATURES), "edge": np.zeros((2, 2)), "prior": 0.5}
    xs = [np.frombuffer(x, dtype=np.float32).reshape(-1, _K) for _, x in rows]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in xs])])
    return train(np.concatenate(xs).astype(np.float64), offsets, np.array([q for q, _ in rows]))


def score_texts(texts: pa.Array, model: dict) -> np.ndarray:
    """Length-weighted mean of the line marginals; the prior without lines."""
    node, size, offsets = line_scores(texts, model["weights"])
    p, _ = forward_backward(node, model["edge"], offsets)
    weight = np.concatenate([[0.0], np.cumsum(size)])
    good = np.concatenate([[0.0], np.cumsum(size * p)])
    w = weight[offsets[1:]] - weight[offsets[:-1]]
    g = good[offsets[1:]] - good[offsets[:-1]]
    # equal texts score alike, whatever shares their batch: the last bits go
    return np.round(np.clip(np.where(w > 0, g / np.maximum(w, 1), model["prior"]), 0.0, 1.0), 9)


def score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """All columns of docs plus the quality score in [0, 1].

    Reads ``text`` alone, whole.  Defined cases: null, empty and blank texts
    get the share of good documents in the sample; a long text is read in
    pieces of ``PIECE_BYTES``, so memory is about 25 times the longest text of
    short lines, and more only for one line beyond a piece; every row gives
    one row, repeated ones alike; an empty table gives an empty result; the new
    column's name must be new.
    """
    return with_computed(docs, lambda texts: (pa.array(score_texts(texts, model)),), [(name, "double")])


def reject(docs: DataFrame, model: dict, least: float = 0.3) -> DataFrame:
    """The documents with a score of at least ``least``; same columns."""
    c = fresh(docs, "quality_score_")
    return score(docs, model, c).where(F.col(c) >= least).drop(c)
