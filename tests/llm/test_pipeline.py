import random
from collections import Counter

import pytest

from catalogspark.llm import lines
from tests.llm import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_against_brute_force(spark, docs, rows):
    state, want = docs, list(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, "").cache()
        if name != "pack_sequences":
            assert out.columns == docs.columns
        found = sorted(((r.doc_id, r.text or "") for r in out.select("doc_id", "text").collect()), key=str) if name != "pack_sequences" else None
        if name == "quality_rules":
            want = [(d, t) for d, t in want if brute.keeps(t)]
        elif name == "line_dedup":
            lost = {(d, i) for d, i, *_, kept in brute.op3(sorted(set(want), key=str)) if not kept}
            want = [(d, "\n".join(x for i, x in enumerate((t or "").split("\n")) if (d, i) not in lost)) for d, t in want]
        elif name == "near_dedup":
            kept = {d for d, _, _, k in brute.op10(want, corpus_pipeline.NEAR_PERCENT) if k}
            want = [(d, t) for d, t in want if d in kept]
        elif name == "mix_sources":
            sources = {(r.doc_id, r.text or ""): r.source for r in state.collect()}
            n = brute.copies([(d, sources[(d, t or "")]) for d, t in want])
            want = [row for row, k in zip(want, n, strict=True) for _ in range(k)]
        if found is not None:
            assert found == sorted(((d, t or "") for d, t in want), key=str), name
        else:
            whole = Counter(d for d, _ in want)
            pieces = out.collect()
            assert Counter(p.doc_id for p in pieces if p.start == 0) == whole
        state = out


def test_run(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_near_dedup_takes_pairs_from_80_percent(spark):
    """116 shingles each; two words changed leave 106 of 126 in common (0.84), three leave 101 of 131 (0.77)."""
    w = [f"w{i}" for i in range(120)]
    changed = lambda *at: " ".join(f"v{i}" if i in at else x for i, x in enumerate(w))
    df = spark.createDataFrame([(1, changed()), (2, changed(20, 60)), (3, changed(20, 60, 80, 100)), (4, changed(10, 30, 50, 70, 90))], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [1, 4]


def test_rows_without_an_id_of_their_own(spark):
    """Rows that share an id or have none are judged by their own texts; of equal rows without an id one keeps its lines."""
    r = random.Random(4)
    prose = lambda n: " ".join("".join(r.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))
    a, b, c, d, e, f, g = (prose(40) for _ in range(7))
    rows = [(5, a), (None, a), (None, f"{b}\n{a}"), (None, c), (None, c), (7, d), (7, a), (7, e), (None, ""), (None, None), (8, f), (8, g), (None, g), (None, f + " tail")]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").repartition(3)
    found = [tuple(x) for x in corpus_pipeline.line_dedup(spark, df, "").collect()]
    want = [(5, a), (None, ""), (None, b), (None, c), (None, ""), (7, d), (7, ""), (7, e), (None, ""), (None, None), (8, f), (8, g), (None, ""), (None, "")]
    assert sorted(found, key=str) == sorted([(i, t, "s") for i, t in want], key=str)
    found = [tuple(x) for x in corpus_pipeline.near_dedup(spark, df, "").collect()]
    want = [(5, a), (None, f"{b}\n{a}"), (None, c), (7, d), (7, e), (None, ""), (None, None), (8, f), (8, g)]
    assert sorted(found, key=str) == sorted([(i, t, "s") for i, t in want], key=str)


def test_tied_first_lines_of_rows_that_share_an_id(spark):
    """Equal first lines in different rows of one id, or of none: one row keeps the line."""
    common = "the same opening line of some length stands here"
    rows = [(i, f"{common}\nbody {i} {k} {chr(97 + k) * 40}") for i in (None, 3) for k in range(4)]
    out = lines.drop_repeats(spark.createDataFrame([r for r in rows if r[0] is None], "doc_id long, text string")).collect()
    assert sorted(common in r.text for r in out) == [False] * 3 + [True] and all("body" in r.text for r in out)
    out = lines.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in out if common in r.text] == [3] and len(out) == 8
