"""Byte-pair encoding by backtracking, decoding by an offset table.

Encoding: an Aho-Corasick automaton over the token bytes gives the longest
token from every position of a pre-token.  The encoder takes the longest one
whose pair with the token before it is *compatible* (the two bytes strings,
joined, encode as exactly these two tokens); else the next shorter token, else
it steps back.  A position once found to have no way on is never tried again,
so the work is linear, and the result is the one the merges give.

Decoding: all token bytes lie end to end in one blob; an id gives the offset
and the length of its bytes, and a whole text is one gather.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import arrow_map, emit, resident, slices
from cabflow.llm.vocab import Vocab, broadcast_vocab, digest

#: Pre-tokens remembered per worker (about 350 bytes each), and the longest one remembered.
CACHE_ENTRIES, CACHE_CHARS = 600_000, 64
#: Pairs of neighbouring tokens remembered per worker (about 100 bytes each).
PAIR_ENTRIES = 1_000_000

class Codec:
    def __init__(self, vocab: Vocab):
        self.vocab = vocab
        size = len(vocab.bytes_of)
        #: merge rank of a token (a single byte: -1) and its two parts
        self.rank = [-1] * size
        self.left = list(range(size))
        self.right = list(range(size))
        for (a, b), (r, new) in vocab.merge.items():
            if self.rank[new] < 0 or r < self.rank[new]:
                self.rank[new], self.left[new], self.right[new] = r, a, b
        self.automaton = ahocorasick.Automaton()
        for raw, i in vocab.id_of.items():
            self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        #: the longest proper prefix of a token that is a token (-1: none)
        self.shorter = [-1] * size
        for raw, i in vocab.id_of.items():
            for n in range(len(raw) - 1, 0, -1):
                j = vocab.id_of.get(raw[:n])
                if j is not None:
                    self.shorter[i] = j
                    break
        self.length = [len(b) for b in vocab.bytes_of]
        #: left id * size + right id -> compatible, filled as pairs are met and
        #: emptied at ``PAIR_ENTRIES``
        self.pairs: dict[int, bool] = {}
        self.size = size
        #: whether a token's own bytes encode as itself: tokens by rank, so
        #: that both parts are known before their join
        self.alone = [True] * size
        for tok in sorted(range(size), key=self.rank.__getitem__):
            if self.rank[tok] >= 0:
                self.alone[tok] = self.alone[self.left[tok]] and self.alone[self.right[tok]] and self._seam_holds(
                    self.left[tok], self.right[tok], joined=True)
        # decoder
        self.blob = np.frombuffer(b"".join(vocab.bytes_of), dtype=np.uint8)
        self.lens = np.array(self.length, dtype=np.int64)
        self.offsets = np.cumsum(self.lens) - self.lens
        self.cache: dict[str, tuple[str, bytes]] = {}
        self.special = {s: (str(i), np.int32(i).tobytes()) for s, i in vocab.special.items()}

    # ------------------------------------------------------------- encoding

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b on end encode as [a, b]."""
        key = a * self.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[key] = self._seam_holds(a, b)
        return known

    def _seam_holds(self, a: int, b: int, joined: bool = False) -> bool:
        """Whether no merge across the seam of a and b comes before the merges
        that make the two sides, which are undone here from the latest to the
        earliest.  ``joined``: the merge of a and b themselves is the one meant.
        """
        rank, merge = self.rank, self.vocab.merge
        # A seam merge wins over the next merge of a side if its rank is lower,
        # or equal and further left (only the right side's merge is further right).
        bound, on_tie, first = float("inf"), False, joined
        while True:
            m = merge.get((a, b))
            if not first and m and (m[0] < bound or (on_tie and m[0] == bound)):
                return False
            first = False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            # undo the merge made last; of two equal ones the left was made first
            if ra > rb:
                bound, on_tie, a = ra, False, self.right[a]
            else:
                bound, on_tie, b = rb, True, self.left[b]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Token ids of one pre-token's bytes."""
        n = len(raw)
        longest = [-1] * n
        size = [0] * n
        for end, (k, tok) in self.automaton.iter(raw.decode("latin-1")):
            s = end - k + 1
            if k > size[s]:
                size[s], longest[s] = k, tok
        alone = self.alone
        if n and size[0] == n and alone[longest[0]]:
            return [longest[0]]
        length, shorter, pairs, compatible, width = self.length, self.shorter, self.pairs, self.compatible, self.size
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, last = 0, -1
        tok = longest[0] if n else -1
        while pos < n:
            while tok >= 0:
                if not dead[pos + length[tok]] and alone[tok]:
                    if last < 0:
                        break
                    fits = pairs.get(last * width + tok)
                    if fits or (fits is None and compatible(last, tok)):
                        break
                tok = shorter[tok]
            if tok >= 0:
                out.append(tok)
                pos += length[tok]
                last = tok
                if pos < n:
                    tok = longest[pos]
            else:
                dead[pos] = 1
                gone = out.pop()
                pos -= length[gone]
                last = out[-1] if out else -1
                tok = shorter[gone]
        return out

    def _piece(self, piece: str) -> tuple[str, bytes]:
        ids = self.encode_piece(piece.encode())
        made = (",".join(map(str, ids)), np.array(ids, dtype=np.int32).tobytes())
        if len(piece) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[piece] = made
        return made

    def parts(self, text: str) -> list[tuple[str, bytes]]:
        """Per pre-token: its ids as text joined by commas, and as int32."""
        if any(s in text for s in self.special):
            out = []
            for part in self.vocab.split_special(text):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out += self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[tuple[str, bytes]]:
        get, make = self.cache.get, self._piece
        return [get(p) or make(p) for p in self.vocab.pretokens(text)]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join([p[1] for p in self.parts(text)]), dtype=np.int32)

    # ------------------------------------------------------------- decoding

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        lens = self.lens[ids]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.offsets[ids] - (ends - lens), lens) + np.arange(total)
        return self.blob[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def codec_of(raw: bytes) -> Codec:
    return resident(("codec", digest(raw)), lambda: Codec(Vocab(raw)))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """doc_id, ids array<int> of every row's whole text (null: no ids)."""
    vocab = broadcast_vocab(docs.sparkSession, vocab_path)
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocab.value)
        for b in slices(batches, "text"):
            yield emit(out, doc_id=b.column(0), ids=[codec.encode(t or "") for t in b.column(1).to_pylist()])

    return arrow_map(_texts(docs), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids give a null text, ids
    outside the vocabulary raise."""
    vocab = broadcast_vocab(encoded.sparkSession, vocab_path)
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocab.value)
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                yield emit(out, doc_id=part.column(0),
                           text=[None if x is None else codec.decode(np.asarray(x, dtype=np.int32))
                                 for x in part.column(1).to_pylist()])

    return arrow_map(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), run,
                     "doc_id long, text string")


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def round_trip_digests(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """Encode and decode every whole text; digests of the ids and of the text.

    doc_id, n_tokens, ids_sha256 (decimal ids joined by commas),
    decoded_sha256 (decoded text in UTF-8).  Defined cases: null and empty
    texts have no ids (digests of the empty string); every input row gives one
    row, repeated rows and null doc_ids included; other columns are not read.
    """
    vocab = broadcast_vocab(docs.sparkSession, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocab.value)
        for b in slices(batches, "text"):
            n, shas, back = [], [], []
            for t in b.column(1).to_pylist():
                parts = codec.parts(t or "")
                ids = np.frombuffer(b"".join([p[1] for p in parts]), dtype=np.int32)
                n.append(len(ids))
                shas.append(hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield emit(_DIGEST, doc_id=b.column(0), n_tokens=n, ids_sha256=shas, decoded_sha256=back)

    return arrow_map(_texts(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
