"""Katz backoff against a model of plain dictionaries, and against the law that probabilities sum to 1."""

import random
import re
import zlib
from collections import Counter
from math import log10

import pytest

from catalogspark.llm import katz as K

SCHEMA = "doc_id long, text string, score double, block string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "</end>"]


class Plain:
    """The model in dictionaries keyed by tuples of words."""

    def __init__(self, texts, order):
        self.counts = [Counter() for _ in range(order)]
        for t in texts:
            w = ["<begin>"] * (order - 1) + words(t)
            for i in range(order - 1, len(w)):
                for n in range(order):
                    self.counts[n][tuple(w[i - n : i + 1])] += 1
        self.discounts = [K.discounts([sum(v == r for v in c.values()) for r in range(1, K.DISCOUNTED + 2)]) for c in self.counts]
        self.total = sum(self.counts[0].values())
        self.after = [{} for _ in range(order)]
        for n, c in enumerate(self.counts):
            for gram, v in c.items():
                self.after[n].setdefault(gram[:-1], {})[gram[-1]] = v

    def kept(self, n, c):
        return c * self.discounts[n][min(c, K.DISCOUNTED + 1)]

    def probability(self, history, word):
        n = len(history)
        seen = self.after[n].get(history)
        if not seen:
            return self.probability(history[1:], word) if n else 1.0
        total = sum(seen.values())
        freed = total - sum(self.kept(n, c) for c in seen.values())
        freed, total = (freed, total) if freed > 1e-9 else (1.0, total + 1)
        if word in seen:
            return self.kept(n, seen[word]) / total
        if not n:
            return freed / total
        return freed / total * self.probability(history[1:], word) / (1 - sum(self.probability(history[1:], w) for w in seen))

    def score(self, text, order):
        w = ["<begin>"] * (order - 1) + words(text)
        return sum(log10(self.probability(tuple(w[i - order + 1 : i]), w[i])) for i in range(order - 1, len(w)))


def corpus(seed=2, n=220):
    r = random.Random(seed)
    ring = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        at, text = r.randrange(120), []
        for _ in range(r.choice([0, 1, 5, 30])):
            at = (at + r.choice([1, 1, 1, 2, 7, r.randrange(120)])) % 120
            text.append(ring[at] if r.random() < 0.95 else f"New{r.randrange(400)}É")
        out.append((i if i % 17 else None, r.choice([" ", "\n", " \t"]).join(text) if i % 19 else None))
    return [*out, (3, out[5][1]), (3, out[5][1]), (2000, "the the " * 40), (2001, "the the " * 40)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_report(spark, order, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(K, "BUCKET_BYTES", 4096)
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA).repartition(4)
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, _ in rows]
    plain = Plain([t for (_, t), h in zip(rows, held, strict=True) if not h], order)
    n, v, c = plain.total, len(plain.counts[0]), plain.counts[0]
    want = [(i, h, len(words(t)), sum(c[w,] > 0 for w in words(t)), n, round(sum(log10((c[w,] + 1) / (n + v + 1)) for w in words(t)), 6), round(plain.score(t, order), 6)) for (i, t), h in zip(rows, held, strict=True)]
    found = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in K.score_report(docs, order).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert any(held) and not all(held)


def test_probabilities_sum_to_one():
    """Over all known words and the unknown one, after histories seen often, seldom and never."""
    plain = Plain([t for _, t in corpus()], 3)
    known = [g[0] for g in plain.counts[0]]
    for history in [("<begin>", "<begin>"), ("w1", "w2"), ("w5", "w9"), ("w119", "w0"), ("the", "the"), ("no", "w3"), ("no", "no")]:
        assert abs(sum(plain.probability(history, w) for w in [*known, "<unknown>"]) - 1) < 1e-9


def test_tables_sum_to_one(spark):
    """The stored tables themselves: what a history's words and its weight times the rest of the single words add up to."""
    model, _ = K.model_and_scores(spark.createDataFrame([(*r, 0.5, "x") for r in corpus()], SCHEMA), 2)
    one = [r for r in model.counts.collect() if r["order"] == 1]
    mass = sum(float(model.orders[0].kept(K.unpacked(r["counts"]).astype(int)).sum()) for r in one) / model.single[0] + model.single[1]
    assert abs(mass - 1) < 1e-9
    two = sum(int(K.unpacked(r["counts"]).sum()) for r in model.counts.collect() if r["order"] == 2)
    assert two == model.orders[0].total == model.orders[1].total
    assert all((K.doubles(r["weight"]) > 0).all() for r in model.weights.collect())


def test_discounts():
    assert K.discounts([100, 40, 20, 12, 8, 6]).tolist()[-1] == 1 and all(0 < d < 1 for d in K.discounts([100, 40, 20, 12, 8, 6])[1:6])
    assert K.discounts([0] * 6).tolist() == [1, 0.5, 1, 1, 1, 1, 1]
    short = K.discounts([100, 40, 20, 0, 0, 0])
    assert all(0 < d < 1 for d in short[1:3]) and short[3:].tolist() == [1, 1, 1, 1]


def test_nothing_to_learn_from_and_empty_table(spark, empty):
    held = next(i for i in range(100) if K.held_out(i))
    row = K.score_report(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()[0]
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.score) == (True, 3, 0, 0, 0.0)
    assert K.score_report(empty).collect() == []


def test_very_long_text(spark, monkeypatch):
    """A document longer than a block, beside short ones of the same words."""
    monkeypatch.setattr(K, "BLOCK_BYTES", 1 << 16)
    one = next(i for i in range(100, 200) if not K.held_out(i))
    docs = spark.createDataFrame([(one, "a b c d " * 100_000), (5, "a b"), (6, "d a")], "doc_id long, text string")
    found = {r.doc_id: r for r in K.score_report(docs).collect()}
    assert found[one].n_tokens == 400_001 and found[one].n_known == 400_001 and -1000 < found[one].score < 0
