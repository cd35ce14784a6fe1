import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalogspark.llm import embeddings, exchange, licenses, lines, minhash, mixing, packing, quality, shard, substring, suffix
from tests.llm import brute


def got(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def license_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(t))


def license_matches(t, threshold=0.8):
    """Label and containment of every template, over all blocks."""
    w, out = license_words(t), {}
    for label, template in licenses.TEMPLATES.items():
        tokens, stride = set(template.split()), licenses.stride_of(template)
        best = max(len(tokens & set(w[i : i + 2 * stride])) for i in range(0, max(len(w), 1), stride))
        short = len(template.split()) <= 12
        if f" {template} " in f" {' '.join(w)} " if short else best >= threshold * len(tokens):
            out[label] = best / len(tokens)
    return out


LICENSED = [
    "Some words first. " + licenses.TEMPLATES["mit-grant"],
    "x " * 300 + licenses.TEMPLATES["mit-grant"].replace("permission", "Permission").replace("sublicense", "lease") + " y" * 90,
    "a " * 17 + licenses.TEMPLATES["gpl-notice"].upper() + " General Public License",
    licenses.TEMPLATES["bsd"][: len(licenses.TEMPLATES["bsd"]) // 2],
    "Licensed under the Apache License, Version 2.0 (the 'License')",
    None,
]


#: Prose that holds most words of a short notice, or all of them in another order.
UNLICENSED = [
    "The album was released in May; under the new license the band may tour.",
    "released under the terms of the gpl license",
    "licensed under the mozilla license version 2",
    "The MIT band released the single under license, under the label.",
    "Apache version 2 was licensed under the license of the maker",
    "this creative commons work is licensed under an attribution license by a court",
    "version 3 of this work is licensed under the public gnu general license",
    "this unencumbered software is free and was released into the public domain is said",
    "released under the M\u0130T license, wor\u212a of Apache",
]


def test_prose_has_no_license(spark):
    rows = list(enumerate(UNLICENSED))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.labels, r.score) for r in found} == {("", 0.0)} and len(found) == len(rows)
    short = [(i, f"See: {t.upper()}.") for i, t in enumerate(licenses.TEMPLATES.values()) if len(t.split()) <= 12]
    assert all(r.labels and r.score == 1.0 for r in licenses.scan(spark.createDataFrame(short, "doc_id long, text string")).collect())


def test_license_scan(spark, docs, rows, empty):
    out = licenses.scan(docs)
    found = got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(found, key=str) == brute.op1(rows)
    assert licenses.scan(empty).count() == 0
    extra = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    data = [*rows, *enumerate(LICENSED)]
    base = {str((d, t)): x[5] for d, t in data for x in brute.op1([(d, t)])}
    want = []
    for d, t in data:
        labels, hit = base[str((d, t))], license_matches(t)
        every = sorted({*hit, *filter(None, labels.split(","))})
        want.append((d, ",".join(every), round(1.0 if labels else max(hit.values(), default=0.0), 9)))
    found = [(r.doc_id, r.labels, round(r.score, 9)) for r in licenses.scan(docs.select("doc_id", "text").unionByName(extra)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert {"mit-grant", "gpl-notice", "apache-short"} <= {x for _, labels, _ in want for x in labels.split(",")}


def test_suffix_dedup(docs, rows, empty):
    assert sorted(got(suffix.dedup_bytes(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == brute.op2(rows)
    assert suffix.dedup_bytes(empty).count() == 0


def test_suffix_dedup_splits_frequent_anchors(docs, rows):
    """Windows dealt out one by one give what contexts give."""
    assert sorted(got(suffix.dedup_bytes(docs, hot=2), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == brute.op2(rows)


def test_column_wise_build():
    """Order, common prefixes and transform of each round, against sorted suffixes."""
    r = np.random.default_rng(1)
    matrix = r.integers(97, 99, (12, 9), dtype=np.uint8)
    for j, (transform, order, common) in zip(range(11, -1, -1), suffix.build_columns(iter(matrix[::-1]), 9), strict=True):
        tails = [bytes(matrix[j:, i]) for i in range(9)]
        assert [tails[i] for i in order] == sorted(tails)
        ranked = sorted(range(9), key=lambda i: tails[i][1:])
        assert sorted(transform.tolist()) == sorted(matrix[j].tolist()) and len(ranked) == 9
        for a, b, n in zip(order[:-1], order[1:], common[1:], strict=True):
            assert n == next((k for k in range(12 - j) if tails[a][k] != tails[b][k]), 12 - j)


def test_substring_dedup(docs, rows, empty):
    assert sorted(got(substring.dedup_substrings(docs), "doc_id", "n_words", "n_removed", "kept_sha256")) == brute.op6(rows)
    assert substring.dedup_substrings(empty).count() == 0


def test_cover_covers():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def test_null_ids(spark):
    data = spark.createDataFrame([(None, "a b c " * 30), (5, "a b c " * 30), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_removed) for r in substring.dedup_substrings(data).collect()) == [(False, 0), (True, 0), (True, 90)]
    assert sorted((r.doc_id is None, r.n_removed) for r in suffix.dedup_bytes(data).collect()) == [(False, 0), (True, 0), (True, 180)]
    assert {r.doc_id for r in minhash.near_duplicates(data).collect()} == {None, 5}
    assert lines.line_report(data).where("not kept").collect()[0].kept_doc_id == 5
    assert shard.shard_documents(data).count() == 3 and quality.ledger(data).count() == 3


def test_line_dedup(docs, rows, empty):
    unique = {(d, t) for d, t in rows}
    out = sorted(set(got(lines.line_report(docs), "doc_id", "line", "kept_doc_id", "kept_line", "kept")))
    assert out == brute.op3(sorted(unique, key=lambda x: (x[0], x[1] or "")))
    assert lines.line_report(empty).count() == 0


def test_line_dedup_rewrites_texts(docs, rows):
    lost = {(d, i) for d, i, *_, kept in brute.op3(sorted(set(rows), key=lambda x: (x[0], x[1] or ""))) if not kept}
    out = lines.drop_repeats(docs)
    assert out.columns == docs.columns
    want = sorted((d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in lost)) for d, t in rows if t is not None)
    assert sorted(r for r in got(out, "doc_id", "text") if r[1] is not None) == want


def test_line_broadcast_counts_line_numbers(spark, monkeypatch):
    """One document with 3,000 wanted lines is more than one small row."""
    asked = []
    monkeypatch.setattr(lines, "small_side", lambda df, n: asked.append(n) or df)
    text = "\n".join(f"line {i}" for i in range(3000))
    docs = spark.createDataFrame([(1, text), (2, "other")], "doc_id long, text string")
    found = lines.line_texts(docs, spark.range(3000).selectExpr("1L as doc_id", "id as line"))
    assert asked == [401] and found.count() == 3000


def test_embedding_near_dedup(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 16))
    vectors = [centres[i % 6] + r.normal(size=16) * (0.05 if i % 3 else 0.3) for i in range(300)]
    data = [(i * 3, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    data += [(2000 + i, data[5][1]) for i in range(40)] + [(1, None), (2, [0.0] * 16), (4, [float("nan")] * 16), (5, []), (7, [1.0, None])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    good = [(i, np.array(v) / np.linalg.norm(v)) for i, v in data if v and None not in v and np.isfinite(v).all() and any(v)]
    matrix = np.array([v for _, v in good])
    links = [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(np.triu(matrix @ matrix.T >= 0.95, 1)))]
    count = Counter(x for pair in links for x in pair)
    part = brute.components([i for i, _ in data], links)
    want = sorted((i, count[i], part[i], part[i] == i) for i, _ in data)
    assert sorted(got(embeddings.near_duplicates(df, tile=32), "vec_id", "n_links", "component_id", "kept")) == want
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_embeddings_keep_double_precision(spark):
    """A pair that is under the threshold in doubles and not in floats; values beyond the range of floats."""
    a = np.zeros(3)
    a[0] = 1.0
    angle = np.arccos(0.95) + 1e-9
    b = [float(np.cos(angle)), float(np.sin(angle)), 0.0]
    data = [(1, a.tolist()), (2, b), (3, [1e300, 0.0, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.0, 2.0])]
    out = embeddings.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, tile int"))
    assert sorted(got(out, "vec_id", "n_links", "component_id", "kept"), key=str) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False), (None, 1, None, True), (None, 1, None, True)]


def test_mixing(docs, rows, empty):
    out = mixing.mix(docs)
    assert set(docs.columns) <= set(out.columns)
    report = mixing.mix_report(docs).collect()
    copies = Counter(r.doc_id for r in report)
    assert all(r.n_copies * sum(d == r.doc_id for d, _ in rows) == copies[r.doc_id] for r in report)
    assert [r.shuffle_key for r in report] == sorted(r.shuffle_key for r in report)
    assert mixing.mix_report(empty).count() == 0
    clash = docs.withColumn("rate", F.lit("r")).withColumn("_source", F.lit("s"))
    kept = mixing.mix(clash)
    assert set(clash.columns) <= set(kept.columns) and kept.where("rate = 'r' and _source = 's'").count() == len(report)


def test_mixing_meets_targets(spark):
    big = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source")
    total = dict(mixing.mix_report(big, targets={"hot": 1, "s0": 3}).groupBy("source").count().collect())
    assert set(total) == {"hot", "s0"}
    assert abs(total["s0"] / sum(total.values()) - 0.75) < 0.03
    assert abs(sum(total.values()) / 20_000 - 1) < 0.05


def test_mixing_at_any_rate(spark):
    """A source of one row among 20,000 repeats some 10,000 times, the rare rows of another some 400 times."""
    df = spark.range(20_000).selectExpr("id as doc_id", "case id when 7 then 'one' when 8 then null else if(id % 800 = 1, 'few', 'many') end as source")
    report = mixing.mix_report(df, targets={"one": 10, "few": 10, "many": 1}).collect()
    copies = defaultdict(list)
    for r in report:
        copies[(r.source, r.doc_id, r.n_copies)].append(r.copy)
    assert all(sorted(c) == list(range(n)) for (_, _, n), c in copies.items())
    mean = {"one": 200_000 / 21, "few": 200_000 / 21 / 25}
    for source, rate in mean.items():
        counts = [n for s, _, n in copies if s == source]
        assert len(counts) == (1 if source == "one" else 25)
        assert abs(sum(counts) / len(counts) - rate) < 5 * (rate / len(counts)) ** 0.5
        assert max(abs(n - rate) for n in counts) < 5 * rate**0.5 and (len(counts) == 1 or len(set(counts)) > 5)
    assert [r.shuffle_key for r in report] == sorted(r.shuffle_key for r in report)
    assert len({r.shuffle_key for r in report}) == len(report)


def test_quality(docs, rows, empty):
    stored = quality.ledger(docs)
    col = lambda c: F.col(f"{quality.LEDGER}.{c}")
    base = col("failed_bits").bitwiseAND(F.lit(quality.BASE).cast("long")) != 0
    found = got(stored.select("doc_id", *[col(m).alias(m) for m in quality.MEASURES[:5]], base.alias("b")), "*")
    assert sorted(found) == brute.op7(rows)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == stored.where(quality.verdict()).count()
    costs = {r.rule: (r.n_failed, r.n_only) for r in quality.ablations(stored).collect()}
    assert costs["few_words"][0] == stored.where(col("n_words") < 20).count()
    assert stored.where(~quality.verdict("v1")).count() <= stored.where(~quality.verdict("v2")).count()
    assert quality.ledger(empty).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json")


def test_packing(docs, rows, empty, tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    ids = {(d, len(x)): x for d, x in ((d, [*t.encode(text or "", add_special_tokens=False).ids, 0]) for d, text in rows)}
    pieces = packing.pack(docs, tokenizer).collect()
    tokens = Counter()
    for p in pieces:
        whole = ids[(p.doc_id, p.doc_tokens)]
        assert brute.crc(whole[p.start : p.start + p.length]) == p.ids_crc32
        tokens[(p.doc_id, p.doc_tokens)] += p.length
    times = Counter((d, len([*t.encode(text or "", add_special_tokens=False).ids, 0])) for d, text in rows)
    assert tokens == {k: n * k[1] for k, n in times.items()}
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    assert packing.pack(empty, tokenizer).count() == 0
    # Padding: all but one sequence a group end at a power of two.
    total = {k: sum(n for _, n in parts) for k, parts in by.items()}
    odd = [k for k, n in total.items() if n & (n - 1)]
    assert len(odd) <= len({k >> 32 for k in by})
    tier = {p.sequence_id: p.tier for p in pieces}
    assert all(n <= tier[k] for k, n in total.items()) and all(total[k] == tier[k] for k in by if k not in odd)
    assert len(set(tier.values())) > 1
    # Steps: each has one sequence of a tier for each step group, but a tier's last.
    steps = defaultdict(set)
    for p in pieces:
        steps[(p.tier, p.step)].add((p.step_group, p.sequence_id))
    for (t, step), members in steps.items():
        assert sorted(g for g, _ in members) == list(range(len(members)))
        assert len(members) == packing.STEP_GROUPS or step == max(k for x, k in steps if x == t)


def test_tiers_are_packed_longest_first():
    r = random.Random(2)
    lengths = [r.randint(1, 1023) for _ in range(500)]
    windows = packing.fill_windows(lengths)
    used = defaultdict(list)
    for window in windows:
        for piece, first, n in window:
            used[piece].append((first, n))
    for i, n in enumerate(lengths):  # every token once
        at = 0
        for first, m in sorted(used[i]):
            assert first == at
            at += m
        assert at == n
    sizes = [sum(x[2] for x in w) for w in windows]
    assert all(n in packing.TIERS for n in sizes[:-1]) and sizes[:-1] == sorted(sizes[:-1], reverse=True)
    # A window is opened by a piece of its own tier, and shorter tiers fill it.
    for window, size in zip(windows[:-1], sizes[:-1], strict=True):
        assert packing.tier_of(window[0][2]) == size and window[0][2] == max(x[2] for x in window)
    assert sum(len(x) for x in used.values()) <= 1.6 * len(lengths)


@pytest.mark.parametrize("seed", range(3))
def test_segments_encode_like_whole_texts(tokenizer, seed):
    r = random.Random(seed)
    alphabet = ["a", "B", "1", " ", " ", "\n", "\t", "'s", ".", "é", "ß", " ", "　", " ", "日", "😀", "\x1c", "<|endoftext|>", "\r\n", "  ", "'"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(400)]
    cache = packing.SegmentCache(tokenizer)
    data = [x.encode() for x in texts]
    buf = np.frombuffer(b"".join(data), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    starts = packing.segment_starts(buf, off)
    ids, lengths = cache.encode(buf, starts, off)
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, off)]
    for i, x in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == cache.tokenizer.encode(x, add_special_tokens=False).ids, repr(x)


def test_sharding(docs, rows, empty):
    out = shard.shard_documents(docs).collect()
    assert len(out) == len(rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    assert all((r.size, r.text_crc32) in texts[r.doc_id] for r in out)
    assert shard.shard_documents(empty).count() == 0
    for r in out:
        assert (r.shard, r.grown_shard) == (rendezvous(r.doc_id, [1.0] * 24), rendezvous(r.doc_id, [1.0] * 25))


def rendezvous(key, weights):
    """The shard with the best score, from plain Python."""
    scores = []
    for i, w in enumerate(weights):
        digest = hashlib.md5(f"rendezvous:{'' if key is None else key}:{i}".encode()).hexdigest()
        scores.append(w / -math.log((int(digest[:13], 16) + 0.5) / 2**52))
    return scores.index(max(scores))


def test_weighted_growth_moves_rows_only_into_the_new_shard(spark):
    rows = spark.range(2000).withColumnRenamed("id", "doc_id")
    for r in shard.assign(rows, "doc_id", [1.0, 2.5, 0.5], grown_weight=2.0).collect():
        assert r.shard == rendezvous(r.doc_id, [1.0, 2.5, 0.5])
        assert r.grown_shard == rendezvous(r.doc_id, [1.0, 2.5, 0.5, 2.0]) and r.grown_shard in (r.shard, 3)


def test_shard_weights(spark):
    counts = dict(shard.assign(spark.range(6000).withColumnRenamed("id", "doc_id"), "doc_id", [1.0, 2.0, 3.0]).groupBy("shard").count().collect())
    assert abs(counts[0] - 1000) < 150 and abs(counts[2] - 3000) < 200


def test_minhash(docs, rows, empty):
    found = sorted(got(minhash.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept"))
    assert found == brute.op10(rows)
    assert minhash.near_duplicates(empty).count() == 0


def test_minhash_chains(spark):
    """A chain of near copies, each near the next alone, is one component."""
    w = [f"w{i}" for i in range(300)]
    texts = [" ".join([*(f"v{k}x{i}" for i in range(8 * k)), *w[8 * k :]]) for k in range(12)] + [" ".join(f"u{k}{i}" for i in range(40)) for k in range(5)]
    r = random.Random(1)
    rows = list(enumerate(texts))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(got(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")) == brute.op10(rows)


def test_minhash_shared_ids(spark):
    """Rows of one id with different texts: each text's links count, and the id joins them; rows without an id are judged by their own texts."""
    prose = lambda k: [f"{k}{i}" for i in range(80)]
    text = lambda k, *more: " ".join([*prose(k), *more])
    for first, rest in ((1, (3, 4)), (5, (1, 4)), (5, (4, 1)), (9, (7, 8))):
        rows = [(first, text("a")), (first, text("b")), (rest[0], text("a", "x")), (rest[1], text("b", "x")), (20, text("c"))]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = sorted(got(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept"))
        assert found == brute.op10(rows) and len({c for _, _, c, _ in found}) == 2
    rows = [(None, text("a")), (None, text("b")), (3, text("a", "x")), (None, text("b", "x")), (None, None), (6, "")]
    found = got(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found, key=str) == sorted([(None, 76, 3, False), (None, 76, None, True), (3, 77, 3, True), (None, 77, None, True), (None, 0, None, True), (6, 0, 6, True)], key=str)


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t, t.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_repetitive_texts_do_not_collide(spark, tokenizer, n):
    """Thue-Morse words, lines and segments: polynomial hashes modulo a power of two cannot tell them apart."""
    a, b = thue_morse(n)
    tail = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, f"{a}\n{tail} x"), (4, f"{b}\n{tail} y"), (5, f"{a} {b} " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(got(substring.dedup_substrings(df), "doc_id", "n_words", "n_removed", "kept_sha256")) == brute.op6(rows)
    assert sorted(got(minhash.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")) == brute.op10(rows)
    assert sorted(got(lines.line_report(df), "doc_id", "line", "kept_doc_id", "kept_line", "kept")) == brute.op3(rows)
    stored = quality.ledger(df).select("doc_id", *[F.col(f"{quality.LEDGER}.{m}").alias(m) for m in quality.MEASURES[:5]])
    assert sorted(got(stored, "*")) == [x[:-1] for x in brute.op7(rows)]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    for p in packing.pack(df, tokenizer).collect():
        ids = [*t.encode(dict(rows)[p.doc_id], add_special_tokens=False).ids, 0]
        assert brute.crc(ids[p.start : p.start + p.length]) == p.ids_crc32


def family(r, size, edits, vocabulary, words=60):
    base = [r.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        out.append(" ".join(w))
    return out


def test_large_families_of_lines(spark):
    """Families whose members partly link, more than a block's sets each: components as brute force has them."""
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 9))) for _ in range(300)]
    texts = [*family(r, 320, 12, vocabulary), *family(r, 60, 5, vocabulary)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(got(lines.line_report(df), "doc_id", "line", "kept_doc_id", "kept_line", "kept")) == brute.op3(rows)


def test_measured_recall(spark):
    """Of pairs at or over the threshold in an exhaustive comparison, bands and inverted lists find 99 in 100 at least."""
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 9))) for _ in range(500)]
    texts = [x for _ in range(60) for x in family(r, 3, 4, vocabulary, 160)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for found, want in ((got(lines.line_report(df), "doc_id", "kept_doc_id"), [(x[0], x[2]) for x in brute.op3(rows)]), (got(minhash.near_duplicates(df), "doc_id", "component_id"), [(x[0], x[2]) for x in brute.op10(rows)])):
        linked = {x for x in want if x[0] != x[1]}
        assert len(linked) > 20 and len(linked & set(found)) >= 0.99 * len(linked)


def test_one_very_long_text(spark, tokenizer):
    """Three megabytes in one document, with a passage that another one has."""
    r = random.Random(5)
    words = [f"{r.randrange(10**6)}" for _ in range(400_000)]
    passage = " ".join(words[200_000:200_060])
    rows = [(1, passage), (2, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: x.n_removed for x in substring.dedup_substrings(df).collect()} == {1: 0, 2: 60}
    assert {x.doc_id: x.n_removed for x in suffix.dedup_bytes(df).collect()} == {1: 0, 2: len(passage)}
    assert packing.pack(df, tokenizer).agg(F.countDistinct("doc_id")).first()[0] == 2
    assert lines.line_report(df).where("kept").count() == 2 and minhash.near_duplicates(df).where("kept").count() == 2


def test_null_ids_in_packing_mixing_and_licenses(spark, tokenizer):
    rows = [(None, "Released under the MIT License.", None), (None, None, "a"), (None, "", "a"), (4, "Released under the MIT License.", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(df, tokenizer).collect()
    assert sorted(str(p.doc_id) for p in pieces if p.start == 0) == ["4", "None", "None", "None"] and sum(p.doc_tokens == 1 for p in pieces) == 2
    found = sorted((str(r.doc_id), r.labels) for r in licenses.scan(df).collect())
    assert found == [("4", "mit"), ("None", ""), ("None", ""), ("None", "mit")]
    report = mixing.mix_report(df).collect()
    assert all(0 <= r.copy < r.n_copies and len(r.text_md5) == 32 for r in report)
    assert shard.shard_documents(df).where("shard is null").count() == 0


SPECIAL = ["hello <|endoftext|> x", "<|endoftext|>", "a <|endoftext|><|endoftext|>b  <|endoftext|> \n c", " <|endoftext|>", "x<|endoftext|> y " * 700]


@pytest.mark.parametrize("as_text", [False, True])
def test_packing_reads_special_tokens_as_the_file_does(spark, tokenizer, as_text):
    import zlib

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = as_text
    found = {}
    for p in packing.pack(spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string"), tokenizer, special_as_text=as_text).collect():
        found.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for i, text in enumerate(SPECIAL):
        ids = [*t.encode(text, add_special_tokens=False).ids, 0]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert sorted(found[i]) == [(a, n, zlib.crc32(raw[4 * a : 4 * (a + n)]), len(ids)) for a, n, *_ in sorted(found[i])]
        assert sum(n for _, n, *_ in found[i]) == len(ids)
    assert (50256 in t.encode(SPECIAL[0], add_special_tokens=False).ids) != as_text


def test_merger_against_plain_grouping():
    """Whatever the table's size, the rows of a key give its first place, whether it has others, and its bands."""
    rng = np.random.default_rng(5)
    for rows in (1, 7, 40, 10_000):
        merger, sent, want, seen = lines.Merger(2, rows), [], {}, set()
        for block in range(60):
            keys = np.unique(np.append(rng.integers(0, 200, 9), 7)).astype(np.uint64)
            ids, number, again = rng.integers(0, 50, len(keys)), rng.integers(0, 9, len(keys)), rng.random(len(keys)) < 0.1
            fresh = np.array([k not in seen for k in keys.tolist()])
            seen.update(keys.tolist())
            bands = np.stack([keys[fresh], keys[fresh]], axis=1).astype(np.uint8)
            sent += merger.add(keys, keys + np.uint64(1), ids, number, again, fresh, bands)
            for k, i, n, a in zip(keys.tolist(), ids.tolist(), number.tolist(), again.tolist(), strict=True):
                want.setdefault(k, []).append((i, n, a))
        sent.append(merger.send())
        found = pa.Table.from_batches(sent).to_pylist()
        for k, places in want.items():
            own = [r for r in found if r["key"] == k]
            assert {r["twin"] for r in own} == {k + 1}
            assert min((r["doc_id"], r["line"]) for r in own) == min((i, n) for i, n, _ in places)
            assert (len(own) > 1 or own[0]["again"]) == (len(places) > 1 or places[0][2])
            assert [r["bands"] for r in own if r["bands"]] == [bytes([k, k])]
        if rows >= 40:
            assert sum(r["key"] == 7 for r in found) == 1  # stands in every block
        assert merger.held == 0


def test_a_line_of_all_documents_is_a_row_a_task(spark):
    """One line stands in every block of every task; its group is as long as there are tasks, not blocks."""
    docs = spark.range(0, 400, 1, 4).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("one line for all\n"), F.repeat(F.concat(F.lit("x"), F.col("id").cast("string"), F.lit(" ")), 4000)).alias("text"))
    signed = lines.signed_lines(docs, 5).groupBy("key").count().agg(F.max("count").alias("most"), F.count("*").alias("n")).first()
    assert (signed.most, signed.n) == (4, 401)


def test_rows_without_ids_fill_all_chunks(spark):
    """Half the rows have no id: no chunk gets many of them, and they lose only what rows with ids have."""
    docs = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 500).cast("string")).alias("text"))
    rows, chunks = exchange.chunked(docs, chunk_bytes=300)
    most = rows.groupBy("chunk").count().agg(F.max("count")).first()[0]
    assert chunks > 40 and most < 150
    shared = " ".join(f"w{i}" for i in range(60))
    data = [(None, f"{shared} n{i}") for i in range(40)] + [(3, shared), (4, "another"), (None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = substring.dedup_substrings(df).where("doc_id is null and n_words > 0").select("n_words", "n_removed").distinct().collect()
    assert [tuple(r) for r in out] == [(61, 60)]
    cut = suffix.dedup_bytes(df).where("doc_id is null and n_bytes > 0").agg(F.min(F.col("n_bytes") - F.col("n_removed")), F.max(F.col("n_bytes") - F.col("n_removed"))).first()
    assert tuple(cut) == (3, 4)
    alone = substring.dedup_substrings(df.where("doc_id is null"))
    assert alone.agg(F.sum("n_removed")).first()[0] == 0 and alone.count() == 41
