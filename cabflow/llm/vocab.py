"""Byte-level BPE vocabularies: read once on the driver, broadcast as bytes
(a bounded file), parsed in the Python workers."""

from __future__ import annotations

import hashlib
import json

import regex
from pyspark.sql import SparkSession

#: A vocabulary file above this size is refused rather than broadcast.
MAX_VOCAB_BYTES = 64 << 20

#: Fixed value: the byte-level pre-token pattern, with white space by its
#: Unicode property.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_char() -> dict[str, int]:
    """The printable stand-in character of every byte in such files: bytes
    that print keep their character, the others follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    kept = set(keep)
    out = {chr(b): b for b in keep}
    out.update({chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)})
    return out


class Vocab:
    """Token bytes, merges and special strings of a byte-level BPE file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("expected a byte-level BPE without a normalizer")
        chars = byte_of_char()
        as_bytes = lambda s: bytes(chars[c] for c in s)
        self.id_of = {as_bytes(s): i for s, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.id_of.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for b, i in self.id_of.items():
            self.bytes_of[i] = b
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        #: (left id, right id) -> (rank, merged id)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (as_bytes(s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merge[self.id_of[left], self.id_of[right]] = (rank, self.id_of[left + right])
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.pretokens = regex.compile(PRETOKEN).findall
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split \
            if self.special else (lambda text: [text])


def digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def broadcast_vocab(spark: SparkSession, path: str | None):
    with open(path or default_path(), "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError("vocabulary file too large to broadcast")
    return spark.sparkContext.broadcast(raw)
