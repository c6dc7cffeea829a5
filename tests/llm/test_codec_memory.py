"""The codec's memory of pre-tokens holds the words of a worker's texts."""

from cabflow.llm.bpe_codec import CACHE_ENTRIES, Codec
from cabflow.llm.vocab import Vocab, default_path


def _word(i: int) -> str:
    out = ""
    while True:
        i, r = divmod(i, 26)
        out += chr(97 + r)
        if not i:
            return " x" + out


def test_recurring_pretokens_are_encoded_once():
    with open(default_path(), "rb") as f:
        codec = Codec(Vocab(f.read()))
    calls, encode = [0], codec.encode_piece

    def counted(raw):
        calls[0] += 1
        return encode(raw)

    codec.encode_piece = counted
    n = 300_000
    texts = ["".join(_word(i) for i in range(s, s + 1000)) for s in range(0, n, 1000)]
    first = [codec.parts(t) for t in texts]
    assert calls[0] == n
    assert [codec.parts(t) for t in texts] == first
    assert calls[0] == n                                  # nothing was encoded again
    assert len(codec.cache) <= CACHE_ENTRIES
