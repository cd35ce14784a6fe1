"""Periodic runs against a search of all periods and places."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalogspark.llm import runs as R

SCHEMA = "doc_id long, text string, start int, `_other` string"


def brute(words, least=R.MIN_WORDS, periods=R.MIN_PERIODS):
    """All maximal stretches by period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


def report(doc_id, text, rewrite=None):
    words = (text or "").encode().split()
    if rewrite and words and doc_id is not None and (way := rewrite(doc_id, len(words))):
        words = [w if i < way[0] else words[way[0] + (i - way[0]) % way[1]] for i, w in enumerate(words)]
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def texts(seed=3):
    """Texts with runs of many periods, runs inside runs, runs that overlap, and near misses."""
    r = random.Random(seed)
    word = lambda k: "".join(r.choice("abé") for _ in range(k))
    out = [None, "", " \n", "a", "a " * 23, "a " * 24, "a b " * 12, "a b " * 11 + "a", "x " * 24 + "y " * 24, ("a " * 30 + "b ") * 4, "z" * 5000]
    for _ in range(60):
        base = [word(r.randint(1, 3)) for _ in range(r.randint(1, 40))]
        turns = r.choice([2, 3, 5, 9])
        body = base * turns + base[: r.randint(0, len(base))]
        if r.random() < 0.3:
            body[r.randrange(len(body))] = "odd"
        out.append(r.choice([" ", "\n", "\t "]).join([word(2) for _ in range(r.randint(0, 9))] + body + [word(2) for _ in range(r.randint(0, 9))]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=80), min_size=1, max_size=4), st.sampled_from([2, 6, 24]))
def test_any_words(docs, least):
    codes = np.array([x + 7 for d in docs for x in d], np.uint64)
    bounds = np.cumsum([0] + [len(d) for d in docs])
    found = [tuple(x) for x in R.find(codes, bounds, lambda at: codes[at], least).tolist()]
    assert found == [(a + s, a + s + n, q) for a, d in zip(bounds.tolist(), docs, strict=False) for s, n, q in brute(d, least)]


def test_chance_matches_are_found_out():
    """Words of one first fingerprint that differ by the second make the search start anew, not a run."""
    codes = np.array([5] * 40, np.uint64)
    calls = []

    def twins(at):
        calls.append(len(at))
        return at.astype(np.uint64) if len(calls) == 1 else np.zeros(len(at), np.uint64)

    assert len(R.find(codes, np.array([0, 40]), twins)) == 1 and len(calls) == 4  # two a search


@pytest.fixture(scope="module")
def samples():
    return [(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts())] + [(20, texts()[20], 1, "x")] * 2


def test_report(spark, samples):
    docs = spark.createDataFrame(samples, SCHEMA).repartition(3)
    for rewrite in (None, R.planted):
        found = sorted(map(tuple, R.run_report(docs, rewrite).collect()), key=str)
        assert found == sorted((report(i, t, rewrite) for i, t, *_ in samples), key=str)


def test_runs_and_collapsed_texts(spark, samples):
    docs = spark.createDataFrame(samples, SCHEMA).repartition(3)
    found = sorted(map(tuple, R.find_runs(docs).collect()), key=str)
    assert found == sorted(((i, *run) for i, t, *_ in samples for run in brute((t or "").encode().split())), key=str)
    digests = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in R.collapse(docs).collect())
    assert digests == sorted(report(i, t)[-1] for i, t, *_ in samples)


def test_empty_table(spark, empty):
    assert R.run_report(empty).collect() == [] and R.find_runs(empty).collect() == []


def test_very_long_text(spark):
    """300,000 words of one period, and as many of a period of 70,000."""
    r = random.Random(1)
    base = [str(r.randrange(50)) for _ in range(70_000)]
    docs = spark.createDataFrame([(1, "w v " * 150_000), (2, " ".join((base * 5)[:300_000]))], "doc_id long, text string")
    found = {x.doc_id: x for x in R.run_report(docs).collect()}
    assert (found[1].n_runs, found[1].start, found[1].length, found[1].period, found[1].exponent_milli) == (1, 0, 300_000, 2, 150_000_000)
    assert (found[2].start, found[2].length, found[2].period) == (0, 300_000, 70_000)
