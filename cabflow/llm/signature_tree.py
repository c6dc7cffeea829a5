"""Signature trees over sets of 64-bit hashes and their dual traversal.

A leaf stands for one set: a bitmap of its elements (one bit per element, by
the low bits of the hash) and its size.  An inner node holds the OR of its
children's bitmaps, the range of their sizes, and the most elements that any
set below lost to shared bits.  Two nodes can only hold a similar pair if the
largest overlap their bits and sizes allow is large enough.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: Bitmap words compared at a time in one step of the traversal.
_STEP_WORDS = 1 << 20


def bitmap_width(sets: list[np.ndarray]) -> int:
    """Bits per signature: a power of two of at least twice the largest set."""
    most = max((len(s) for s in sets), default=1)
    return min(1 << 16, max(256, 1 << (2 * most - 1).bit_length()))


class SignatureTree:
    def __init__(self, sets: list[np.ndarray], width: int):
        size = np.array([len(s) for s in sets], dtype=np.int64)
        #: leaf -> index of its set, leaves in the order of size
        self.leaf = np.argsort(size, kind="stable")
        bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
        for row, k in enumerate(self.leaf.tolist()):
            at = np.unique(sets[k] & np.uint64(width - 1))
            np.bitwise_or.at(bits[row], (at >> np.uint64(6)).astype(np.int64),
                             np.uint64(1) << (at & np.uint64(63)))
        size = size[self.leaf]
        lost = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        #: levels from the leaves up: (bitmaps, least size, largest size, most lost)
        self.levels = [(bits, size, size, lost)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, lost = self.levels[-1]
            cut = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, cut, axis=0), np.minimum.reduceat(lo, cut),
                                np.maximum.reduceat(hi, cut), np.maximum.reduceat(lost, cut)))

    def raised(self, height: int) -> list[tuple]:
        """Levels with the root repeated up to ``height`` levels."""
        return self.levels + [self.levels[-1]] * (height - len(self.levels))


def _possible(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs can hold sets with 100 * overlap >= percent * union."""
    (ba, lo_a, hi_a, lost_a), (bb, lo_b, hi_b, lost_b) = a, b
    most = np.minimum(hi_a[i], hi_b[j])
    least = lo_a[i] + lo_b[j]
    ok = (100 + percent) * most >= percent * least
    at = np.flatnonzero(ok)
    step = max(1, _STEP_WORDS // ba.shape[1])
    for s in range(0, len(at), step):
        k = at[s:s + step]
        common = np.bitwise_count(ba[i[k]] & bb[j[k]]).sum(axis=1, dtype=np.int64)
        over = np.minimum(most[k], common + np.minimum(lost_a[i[k]], lost_b[j[k]]))
        ok[k] = (100 + percent) * over >= percent * least[k]
    return ok


def similar_candidates(a: SignatureTree, b: SignatureTree | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual traversal: index pairs of sets that pass every bound on the way
    down.  With b None the tree is joined with itself (each pair once)."""
    alone = b is None
    other = a if alone else b
    height = max(len(a.levels), len(other.levels))
    la, lb = a.raised(height), other.raised(height)
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(height - 1, -1, -1):
        ok = _possible(la[level], lb[level], i, j, percent)
        i, j = i[ok], j[ok]
        if not level:
            break
        i, j = _children(i, j, len(la[level - 1][0]), len(la[level][0]), len(lb[level - 1][0]), len(lb[level][0]))
        if alone:
            i, j = i[i <= j], j[i <= j]
    if alone:
        i, j = i[i < j], j[i < j]
    return a.leaf[i], other.leaf[j]


def _children(i, j, na, pa, nb, pb):
    """All pairs of the children of each pair; a repeated root has itself."""
    ai = i[:, None] * FANOUT + np.arange(FANOUT) if na != pa else i[:, None]
    bj = j[:, None] * FANOUT + np.arange(FANOUT) if nb != pb else j[:, None]
    x = np.repeat(ai, bj.shape[1], axis=1).ravel()
    y = np.tile(bj, (1, ai.shape[1])).ravel()
    ok = (x < na) & (y < nb)
    return x[ok], y[ok]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


class Links:
    """Union-find over the sets of one group: links that join two parts."""

    def __init__(self, part: list):
        self.parent: dict = {p: p for p in part}

    def find(self, x):
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a, b) -> None:
        self.parent[self.find(a)] = self.find(b)


def spanning_links(ids: list[int], sets: list[np.ndarray], percent: int, parts: list | None = None,
                   probe: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links between similar sets, enough to connect all that are linked.

    parts: sets already known to be connected carry the same part; pairs
    within a part are not looked at.  probe: pairs are formed between sets
    that are probes and sets that are not; None: between all.
    """
    parts = list(ids) if parts is None else parts
    links = Links(parts)
    width = bitmap_width(sets)
    if probe is None:
        back = fore = np.arange(len(ids))
        i, j = similar_candidates(SignatureTree(sets, width), None, percent)
    else:
        fore, back = np.flatnonzero(probe), np.flatnonzero(~np.asarray(probe))
        if not len(fore) or not len(back):
            return []
        i, j = similar_candidates(SignatureTree([sets[k] for k in fore], width),
                                  SignatureTree([sets[k] for k in back], width), percent)
    out = []
    for x, y in zip(fore[i].tolist(), back[j].tolist(), strict=True):
        if links.find(parts[x]) == links.find(parts[y]):
            continue
        both = overlap(sets[x], sets[y])
        if both and (100 + percent) * both >= percent * (len(sets[x]) + len(sets[y])):
            links.join(parts[x], parts[y])
            out.append((ids[x], ids[y]))
    return out
