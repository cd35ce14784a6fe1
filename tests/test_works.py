"""Folding rows of one work, evidence and season rules, publishing: small cases."""

import pytest
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import evidence, reconcile, works
from catalogspark.sources import lists
from catalogspark.streaming import refresh
from tests.test_reconcile import frame


def folded(spark, rows, safe=False):
    out = works.dedupe_by_work(frame(spark, [dict(r, seq=i) for i, r in enumerate(rows)]), safe=safe)
    return sorted((r.movie_title, tuple(r.sources)) for r in out.select("movie_title", "sources").collect())


def row(title, url="", year="2001", tmdb="7", **more):
    return dict(movie_title=title, bluray_url=url, release_date=year, tmdb_id=tmdb, imdb_id="tt7", **more)


def test_rows_of_a_work(spark):
    a, b = "http://d.example/a", "http://d.example/b/"
    assert folded(spark, [row("One", a), row("Uno", b), row("Lone", tmdb="")]) == [("Lone", (2,)), ("One", (0, 1))]
    # An edition keeps its page's row apart; a row without a page goes to the one with its title.
    assert folded(spark, [row("One", a), row("One Extended Cut", b), row("one!")]) == [("One", (0, 2)), ("One Extended Cut", (1,))]
    # Two pages of one title and year are one row; without pages a work is one row.
    assert folded(spark, [row("One", a), row("one", b), row("One", "http://d.example/c")]) == [("One", (0, 1, 2))]
    assert folded(spark, [row("One"), row("Other", year="1999")]) == [("One", (0, 1))]
    # No title, but one year fits; the earlier row gives the title.
    assert folded(spark, [row("Third", year="1990"), row("One Extended", a, year="1990"), row("Two Extended", b, year="1995")]) == [("Third", (0, 1)), ("Two Extended", (2,))]


def test_only_proven_works_are_folded_safely(spark):
    assert folded(spark, [row("One"), row("Other")], safe=True) == [("One", (0,)), ("Other", (1,))]
    assert folded(spark, [row("One"), row("Other", quote="Seen. 3 One AKA Other 2001; more")], safe=True) == [("One", (0, 1))]
    assert folded(spark, [row("One"), row("Other", year="2002", quote="One AKA Other")], safe=True) == [("One", (0,)), ("Other", (1,))]


def test_reconcile_folds_proven_works(spark):
    old = frame(spark, [dict(row("One"), seq=0)])
    new = frame(spark, [dict(row("Other Name", quote="One AKA Other Name"), seq=100)])
    catalog, _ = reconcile.reconcile(old, new)
    assert [(r.movie_title, r.is_addition) for r in catalog.collect()] == [("One", False)]


SAID = {
    "is confirmed as Profile 7 FEL": (True, False, False),
    "has Dolby Vision P7 FEL with TrueHD Atmos": (True, False, False),
    "P7 FEL, DTS:X track": (True, False, False),
    "P7 FEL via MediaInfo": (True, False, False),
    "P7 FEL - no": (False, True, False),
    "does not include the P7 FEL": (False, True, False),
    "was never verified as Dolby Vision FEL": (False, True, False),
    "is not only P7 FEL": (True, False, False),
    "P7 FEL, MEL: not present": (True, False, False),
    "P7 FEL and MEL": (False, False, True),
    "P7, FEL": (False, False, False),
    "P7 FEL released in 2019": (True, False, False),
    "P7 FEL Released in 2019": (False, False, False),
    "Casablanca is P7 FEL": (False, False, False),
}


@pytest.mark.parametrize("said", SAID)
def test_evidence_rules(spark, said):
    got = spark.createDataFrame([(said,)], "c string").select(evidence.direct(F.col("c"), F.lit("")), evidence.denied(F.col("c")), evidence.unnegated_rival(F.col("c"))).first()
    assert tuple(got) == SAID[said]


def test_time_stamps_are_no_titles(spark):
    rows = spark.createDataFrame([("Mon Jan 5, 2024 10:30 am",), ("Monday",), ("Sun of May",)], "c string")
    assert [r[0] for r in rows.select(evidence.looks_like_title(F.col("c"))).collect()] == [False, True, True]


SERIES = {
    "Show: Season 2": "Show", "Show - The Complete First Season": "Show", "Show The Complete Series": "Show", "Show Seasons 1-3": "Show", "Show S02": "Show",
    "Season of the Witch": "", "Season 2": "", "Preseason 2": "", "Film": "", "": "",
}


def test_series_titles(spark):
    rows = spark.createDataFrame([(t,) for t in SERIES], "t string")
    assert [r[0] for r in rows.select(X.series_title(F.col("t"))).collect()] == list(SERIES.values())


def test_sheets_may_have_many_columns(spark):
    wide = ",".join(f"h{i}" for i in range(20))
    rows = spark.createDataFrame([("s", 0, f"{wide},Title,Layer"), ("s", 1, ",".join(["x"] * 20) + ',"A, B (2001)",FEL')], "sheet string, row_no long, line string")
    assert [(r.title, r.year) for r in lists.sheet_rows(rows).collect()] == [("A, B", "2001")]


def test_stream_reconciles_once(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = frame(spark, [dict(seq=i, movie_title=f"Film {i % 2}", release_date="2000") for i in range(4)])
    rows.write.parquet(source)
    fold = lambda known, batch: reconcile.reconcile((rows.limit(0) if known is None else known).select(*reconcile.COLUMNS), batch)[0].select(*reconcile.COLUMNS)
    first = refresh.stream_reconcile(spark, source, rows.schema, str(tmp_path / "out"), fold)
    assert first == refresh.stream_reconcile(spark, source, rows.schema, str(tmp_path / "out"), fold)
    assert sorted(r.movie_title for r in spark.read.parquet(first).collect()) == ["Film 0", "Film 1"]
