"""Minimal perfect hashing of 64-bit keys, in buckets.

A key belongs to a bucket by the high bits of its hash.  Inside a bucket the
keys go through levels of bit vectors: on each level a key hashes to one bit;
a bit that exactly one key meets is set and settles that key, the others go to
the next level.  The number of set bits before a key's own bit is its slot, so
``n`` keys have the slots ``0 .. n - 1``.  Buckets are built apart from each
other (in Spark: one group each) and laid end to end afterwards.

A key outside the set also gets some slot: callers compare the key stored
there.
"""

from __future__ import annotations

import numpy as np

from cabflow.llm.common import mix64

#: Expected keys of a bucket; its group in Spark holds a few times this many rows at most.
BUCKET_KEYS = 1 << 15
#: Bits of a level for each key that reaches it.
GAMMA = 2
_BUCKET_SEED = 0x51AB_17E5_0D15_EA5E


def _hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix64(keys.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key, from the upper half of a hash that no level uses."""
    h = mix64(keys.astype(np.uint64) ^ np.uint64(_BUCKET_SEED)) >> np.uint64(32)
    return ((h * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes (in 64-bit words) and the bit vectors, end to end, of one
    bucket of distinct keys."""
    sizes, vectors, left, level = [], [], keys.astype(np.int64), 0
    while len(left):
        words = max(1, -(-GAMMA * len(left) // 64))
        at = _hashed(left, level) % np.uint64(64 * words)
        meets = np.bincount(at.astype(np.int64), minlength=64 * words)
        alone = meets == 1
        vectors.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(words)
        left = left[~alone[at.astype(np.int64)]]
        level += 1
        if level > 200:
            raise ValueError("keys are not distinct")
    return np.array(sizes, dtype=np.int64), np.concatenate(vectors) if vectors else np.zeros(0, np.uint64)


class PerfectHash:
    """Buckets 0 .. n-1 laid end to end: vectorised slots of many keys."""

    def __init__(self, levels: list[np.ndarray], vectors: list[np.ndarray]):
        self.buckets = len(levels)
        depth = max([0, *map(len, levels)])
        self.size = np.zeros((depth, self.buckets), dtype=np.int64)
        for i, sizes in enumerate(levels):
            self.size[:len(sizes), i] = sizes
        whole = self.size.sum(axis=0)
        self.base = np.concatenate([[0], np.cumsum(whole)])[:-1] + np.cumsum(self.size, axis=0) - self.size
        self.words = np.concatenate([*vectors, np.zeros(1, np.uint64)])
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.count = int(ones.sum())

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key of the set; a slot or -1 for any other key."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not self.buckets:
            return out
        bucket = bucket_of(keys, self.buckets)
        todo = np.arange(len(keys))
        for level in range(len(self.size)):
            if not len(todo):
                break
            words = self.size[level][bucket[todo]]
            todo = todo[words > 0]
            words = words[words > 0]
            at = (_hashed(keys[todo], level) % (words * 64).astype(np.uint64)).astype(np.int64)
            word = self.base[level][bucket[todo]] + (at >> 6)
            bits = self.words[word]
            bit = (at & 63).astype(np.uint64)
            hit = (bits >> bit) & np.uint64(1) == 1
            below = bits & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        return out
