"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is run through the merges alone; the strings
that come out as one token are *proven*.  A text is cut into pre-tokens; those
that are proven strings count 1 without any merging, and only the rest is
merged (by rank, with a heap, so a pre-token of n bytes costs n log n).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, resident, slices
from cabflow.llm.vocab import Vocab, broadcast_vocab, digest

#: Rest pre-tokens remembered per worker, and the longest one remembered.
CACHE_ENTRIES, CACHE_CHARS = 1_000_000, 64

def merged_length(vocab: Vocab, raw: bytes) -> int:
    """Number of tokens left when the merges are applied by rank, leftmost
    first: a heap of mergeable neighbours over a doubly linked list."""
    ids = [vocab.byte_id[b] for b in raw]
    n = len(ids)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    merge = vocab.merge
    heap = []
    for i in range(n - 1):
        m = merge.get((ids[i], ids[i + 1]))
        if m:
            heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = nxt[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one side has changed since
        ids[i], ids[j] = new, -1
        left -= 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            m = merge.get((new, ids[k]))
            if m:
                heapq.heappush(heap, (m[0], i, new, ids[k], m[1]))
        h = prv[i]
        if h >= 0:
            m = merge.get((ids[h], new))
            if m:
                heapq.heappush(heap, (m[0], h, ids[h], new, m[1]))
    return left


def proven_strings(vocab: Vocab) -> dict[str, int]:
    """Vocabulary strings (as text) that alone encode as one token."""
    out = {}
    for raw in vocab.id_of:
        if merged_length(vocab, raw) == 1:
            try:
                out[raw.decode()] = 1
            except UnicodeDecodeError:
                pass  # part of a character: never a pre-token by itself
    return out


class TokenCounter:
    def __init__(self, vocab: Vocab):
        self.vocab = vocab
        self.whole = proven_strings(vocab)
        self.rest: dict[str, int] = {}

    def _plain(self, text: str) -> int:
        pieces = self.vocab.pretokens(text)
        whole, rest, vocab = self.whole, self.rest, self.vocab
        others = [p for p in pieces if p not in whole]
        n = len(pieces) - len(others)
        for p in others:
            c = rest.get(p)
            if c is None:
                c = merged_length(vocab, p.encode())
                if len(p) <= CACHE_CHARS:
                    if len(rest) >= CACHE_ENTRIES:
                        rest.clear()
                    rest[p] = c
            n += c
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings in it are one token each."""
        special = self.vocab.special
        if not any(s in text for s in special):
            return self._plain(text)
        return sum(1 if part in special else self._plain(part)
                   for part in self.vocab.split_special(text) if part)


def counter_of(raw: bytes) -> TokenCounter:
    return resident(("counter", digest(raw)), lambda: TokenCounter(Vocab(raw)))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, vocab_path: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row's whole text.

    Defined cases: a null or empty text has 0 bytes and 0 tokens; every row,
    repeated ones and null doc_ids included, gives one row; other columns are
    not read; an empty table gives an empty result.
    """
    vocab = broadcast_vocab(docs.sparkSession, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocab.value)
        for b in slices(batches, "text"):
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield emit(_OUT, doc_id=b.column(0), n_bytes=[len(t.encode()) for t in texts],
                       n_tokens=[counter.count(t) for t in texts])

    out = arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                    "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
