"""Comparisons of two runs: the driver gets no side of a join, and a row is listed by its label."""

from catalogspark.operators import compare, records

A = [(1, "A Film", "2001"), (2, "A Film", "1999"), (3, "Red Sea", "2000"), (4, "Nothing", "2000"), (5, "", "2000")]
B = [(1, "a film!", "2001"), (2, "Red Sky", "2000"), (3, "Red Sky", "2000")]


def side(spark, rows):
    return spark.createDataFrame([(*r, "http://x.example", "q", "t") for r in rows], records.CANDIDATES)


def test_no_join_is_broadcast(spark, monkeypatch):
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(compare, "stored", lambda df, f=compare.stored: (plans.append(plan(df)), f(df))[1])
    rows, listings, summary = records.comparison_outputs(side(spark, A), side(spark, B))
    plans += [plan(df) for df in (rows, listings, summary)]
    assert len(plans) > 8 and not any("Broadcast" in p for p in plans)
    got = {(r.side, r.seq): (r.label, r.match_percent) for r in rows.collect()}
    assert got == {
        ("a", 1): ("A Film (2001)", 100), ("a", 2): ("A Film (1999)", 100), ("a", 3): ("Red Sea (2000)", 50), ("a", 4): ("Nothing (2000)", 0), ("a", 5): (" (2000)", 0),
        ("b", 1): ("a film! (2001)", 100), ("b", 2): ("Red Sky (2000)", 50), ("b", 3): ("Red Sky (2000)", 50),
    }
    assert summary.first().asDict() == {"n_a": 5, "n_b": 2, "n_both": 1, "only_a": 4, "only_b": 1}
    assert sorted(r.listing for r in listings.collect()) == ["a_found"] * 5 + ["a_only"] * 3 + ["b_found"] * 3 + ["b_only"] * 2 + ["overlap"] * 2
