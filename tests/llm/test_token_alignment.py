import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cabflow.llm.common import table
from cabflow.llm.perfect_hash import PerfectHash, bucket_of, build
from cabflow.llm.q_token_alignment import query
from cabflow.llm.token_alignment import align, default_piece_path
from cabflow.llm.vocab import byte_of_char, default_path
from tests.conftest import SF001
from tests.llm.helpers import clashing, frame


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=default_piece_path())


def brute(texts, libraries):
    """Per text the tuple of the contract's columns, from byte offsets."""
    a_lib, b_lib = libraries
    chars = byte_of_char()
    docs, linked = [], Counter()
    for t in texts:
        ids_a = a_lib.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b_lib.encode(t) if t else []
        raw_a = [bytes(chars[c] for c in a_lib.id_to_token(i)) for i in ids_a]
        raw_b = []
        for i in ids_b:
            p = b_lib.id_to_piece(i)
            raw_b.append(bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode())
        want = b" " + t.encode() if t else b""
        if b"".join(raw_a) != want or b"".join(raw_b) != want:
            ids_a, ids_b, raw_a, raw_b = [], [], [], []
        at_a, at_b = np.cumsum([0, *map(len, raw_a)]).tolist(), np.cumsum([0, *map(len, raw_b)]).tolist()
        links = [(x, y) for i, x in enumerate(ids_a) for j, y in enumerate(ids_b)
                 if max(at_a[i], at_b[j]) < min(at_a[i + 1], at_b[j + 1])]
        groups, ends = [], sorted(set(at_a[1:]) & set(at_b[1:]))
        for lo, hi in zip([0, *ends[:-1]], ends):
            groups.append(",".join(str(x) for i, x in enumerate(ids_a) if lo <= at_a[i] < hi) + "|"
                          + ",".join(str(y) for j, y in enumerate(ids_b) if lo <= at_b[j] < hi))
        docs.append((ids_a, ids_b, groups, links))
        linked.update(set(links))
    most = defaultdict(int)
    for (x, _), n in linked.items():
        most[x] = max(most[x], n)
    return [(len(a), len(b), len(g), len(ln), sum(linked[p] == most[p[0]] for p in ln), sum(linked[p] for p in ln),
             ";".join(g)) for a, b, g, ln in docs]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
TEXTS = ["Plain words, here.", "Plain words, here.", "", "naïve café 日本語 🙂", "a▁b", "tab\tand\nline  two   spaces ",
         " leading", "<|endoftext|> and <s> </s> <0x41>", "x" * 300, " odd spaces​", "1234 5678", "ﬁ ligature"]


def test_equals_brute_force(spark, libraries):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)] + [(50, None, None, None, None)]
    want = dict(enumerate(brute(TEXTS, libraries)))
    want[50] = (0, 0, 0, 0, 0, 0, "")
    for held in (4_000_000, 40, 0):  # all pairs resident, some, none: the rest goes through the join
        got = align(clashing(frame(spark, rows), "row", "pair", "ids_a", "n_a", "bucket"), resident_pairs=held).collect()
        assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want, held
    assert want[4] == want[50] and want[0][0] > 0  # U+2581 in a text: no tokens


def test_query_on_a_table(spark, libraries):
    docs = table(spark, SF001, "documents").collect()
    want = dict(zip([r["doc_id"] for r in docs], brute([(r["text"] or "")[:500] for r in docs], libraries)))
    cut = align(table(spark, SF001, "documents").selectExpr("doc_id", "substring(text, 1, 500) AS text")).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in cut} == want
    got = {r["doc_id"]: r for r in query(spark, SF001).collect()}
    assert len(got) == len(docs)
    short = [r["doc_id"] for r in docs if len(r["text"] or "") <= 500]
    for i in short:
        g = want[i][-1]
        assert got[i]["groups_sha256"] == (hashlib.sha256(g.encode()).hexdigest() if g else "")
        assert (got[i]["n_a"], got[i]["n_b"], got[i]["n_groups"], got[i]["n_links"]) == want[i][:4]


def test_edge_rows(spark):
    rows = [(None, "same text", "en", "a", 1), (None, "same text", "en", "a", 1), (7, "same text", None, None, None),
            (8, "word " * 60_000 + "z" * 50_000, "en", "a", 1)]
    got = align(frame(spark, rows)).collect()
    assert len(got) == 4
    alike = [tuple(r[c] for c in COLUMNS) for r in got if r["doc_id"] != 8]
    assert alike[0] == alike[1] == alike[2] and alike[0][5] >= 3 * alike[0][3]
    assert align(frame(spark, rows).limit(0)).count() == 0


def test_pairs_beyond_the_task_bound(spark, libraries, monkeypatch):
    import cabflow.llm.token_alignment as m
    monkeypatch.setattr(m, "GATHER", 5)
    monkeypatch.setattr(m, "IDS_BYTES", 8)
    monkeypatch.setattr(m, "FAN", 2)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(TEXTS)]
    got = align(frame(spark, rows).repartition(5)).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == dict(enumerate(brute(TEXTS, libraries)))


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(0)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 62, 20_000), np.arange(5000)]))
    buckets = 7
    of = bucket_of(keys, buckets)
    made = [build(keys[of == i]) for i in range(buckets)]
    slots = PerfectHash([m[0] for m in made], [m[1] for m in made]).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert PerfectHash([build(keys[:0])[0]], [build(keys[:0])[1]]).slots(keys[:3]).tolist() == [-1] * 3
    with pytest.raises(ValueError):
        build(np.array([5, 5]))
