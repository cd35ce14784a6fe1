"""Alignment of two tokenizers against token by token work on whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from catalogspark.llm import alignment as A

P = pytest.importorskip("public_tokenizers")
pytest.importorskip("sentencepiece")

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, block string, links int"
ODD = ["", None, " ", "  ", "a  b ", " a", "x▁y", "<|endoftext|> <s> </s> <unk> <0x41>", "a　b  c", "\x00", "\n\n a\r\n", "é" * 60, "\ta", "zażółć gęślą \U0001f600\U0001f600 x", "in in in in the the", "1234567 ,,, --- ...", "ab" * 900]


def whole(text):
    """Numbers, all links and the digest of one text, from its tokens as a whole; None where there are none."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not hasattr(whole, "a"):
        whole.a, whole.b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
        whole.a.encode_special_tokens = True
        points = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [i for i in range(256) if i not in points]
        whole.byte = {chr(i): i for i in points} | {chr(256 + k): i for k, i in enumerate(rest)}
    if not text:
        return None
    ids_a, ids_b = whole.a.encode(" " + text, add_special_tokens=False).ids, whole.b.encode(text)
    bytes_a = [bytes(whole.byte[c] for c in whole.a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(whole.b.id_to_piece(i)[3:5], 16)]) if whole.b.is_byte(i) else whole.b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    at = [[i for i, t in enumerate(tokens) for _ in t] for tokens in (bytes_a, bytes_b)]
    links = sorted(set(zip(*at, strict=True)))
    ends = sorted(set(np.cumsum([len(t) for t in bytes_a]).tolist()) & set(np.cumsum([len(t) for t in bytes_b]).tolist()))
    groups, begin = [], 0
    for end in ends:
        own = [sorted(set(x[begin:end])) for x in at]
        groups.append(",".join(str(ids_a[i]) for i in own[0]) + "|" + ",".join(str(ids_b[i]) for i in own[1]))
        begin = end
    return len(ids_a), len(ids_b), len(ends), [(ids_a[i], ids_b[j]) for i, j in links], hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(rows):
    found = [(i, whole(t)) for i, t in rows]
    count = Counter(x for _, w in found if w for x in w[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    docs = Counter(x for _, w in found if w for x in set(w[3]))
    table = sorted((a, b, docs[a, b], n, n == top[b]) for (a, b), n in count.items())
    return [(i, 0, 0, 0, 0, 0, 0, "") if w is None else (i, *w[:3], len(w[3]), sum(count[x] == top[x[1]] for x in w[3]), sum(count[x] for x in w[3]), w[4]) for i, w in found], table


@pytest.fixture(scope="module")
def samples():
    from tests.llm.conftest import corpus

    return [(i if i % 5 else None, t) for i, t in corpus(9)] + [(5000 + i // 2, t) for i, t in enumerate(ODD + ODD[6:9])]


def test_report(spark, samples, monkeypatch):
    docs = spark.createDataFrame([(*r, "x", 1) for r in samples], SCHEMA).repartition(3)
    assert sorted(map(tuple, A.alignment_report(docs, *PATHS).collect()), key=str) == sorted(expected(samples)[0], key=str)


def test_pair_table(spark, samples):
    docs = spark.createDataFrame([(*r, "x", 1) for r in samples], SCHEMA).repartition(2)
    assert sorted((r.a, r.b, r.docs, r.links, r.best) for r in A.pair_table(docs, *PATHS).collect()) == expected(samples)[1]


def test_empty_table(spark, empty):
    assert A.alignment_report(empty, *PATHS).collect() == [] and A.pair_table(empty, *PATHS).collect() == []


def test_very_long_text(spark):
    """A text larger than a block, and one word without a space."""
    rows = [(1, "the cat sat. " * 400_000), (2, "x" * 50_000), (3, "the cat")]
    found = {r.doc_id: r for r in A.alignment_report(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS).collect()}
    short, once = whole("the cat sat. the cat sat."), whole("x" * 50_000)
    assert found[1].n_a - 1 == 400_000 * (short[0] // 2) and found[2].n_a == once[0] and found[2].groups_sha256 == once[4]


def test_bitmaps_round_trip():
    r = np.random.default_rng(1)
    held = [np.sort(r.choice(500, k, replace=False)) for k in (1, 30, 31, 32, 33, 499, 500)]
    owner, docs = np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate(held)
    data = A.Bitmaps.pack(owner, docs, len(held), 500)
    back = A.Bitmaps.unpack(data, 500)
    assert (back[0] == owner).all() and (back[1] == docs).all() and A.Bitmaps.popcounts(data).tolist() == [len(x) for x in held]
    times = r.integers(1, 70, len(docs))
    total = np.zeros(len(docs), np.int64)
    for j, plane in enumerate(A.planes_of(A.pack_planes(owner, docs, times, len(held), 500))):
        o, d = A.Bitmaps.unpack(plane, 500)
        total[np.searchsorted(owner * 500 + docs, o * 500 + d)] += 1 << j
    assert (total == times).all()
