"""Folding works: what is heavy a title is done once, and no step starts Python for each work."""

from catalogspark.operators import works
from tests.test_works import folded, frame, row


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def named(spark, rows):
    return frame(spark, [dict(r, seq=i) for i, r in enumerate(rows)])


def test_titles_meet_once(spark, monkeypatch):
    """The edges are stored before components read them, so spellings are compared once for all that reads them."""
    seen = []
    monkeypatch.setattr(works, "connected", lambda members, f=works.connected: (seen.append(plan(members)), f(members))[1])
    rows = [row("The Colours"), row("The Colors"), row("Third"), row("One", tmdb="8"), row("Other", tmdb="8", quote="One AKA Other"), row("A", tmdb="9"), row("A!", tmdb="9"), row("B", tmdb="10")]
    got = works.alias_groups(named(spark, rows)).collect()
    assert sorted((r.identity, r.n_rows, r.n_titles, r.one_work) for r in got) == [("movie/10", 1, 1, False), ("movie/7", 3, 3, False), ("movie/8", 2, 2, True), ("movie/9", 2, 1, True)]
    assert len(seen) == 1 and "levenshtein" not in seen[0] and "translate" not in seen[0] and "Join" not in seen[0]


def test_targets_of_many_works_come_from_one_batch(spark, monkeypatch):
    """Python starts for a batch of works, not for each work."""
    from pyspark.sql import GroupedData

    def refused(*_):
        raise AssertionError("a group of its own for each work")

    monkeypatch.setattr(GroupedData, "applyInPandas", refused)
    page = "http://d.example/"
    rows = [r for w in "123456" for r in (row("One", page + "a", tmdb=w), row("One Extended Cut", page + "b", tmdb=w), row("one!", tmdb=w), row("Third", year="", tmdb=w))]
    # The titles name two rows each by year, so the third finds none and stands alone.
    assert folded(spark, rows) == sorted(x for i in range(0, 24, 4) for x in [("One", (i, i + 2)), ("One Extended Cut", (i + 1,)), ("Third", (i + 3,))])


def test_a_work_is_judged_by_the_rows_it_has_so_far():
    fact = lambda title, year, at, full, paged: dict(title=title, year=year, at=at, full=full, paged=paged)
    got = works._targets([fact("third", "1990", 0, False, False), fact("two", "1995", 5, False, True), fact("one", "1990", 2, False, True), fact("third", "", 7, False, False), fact("four", "1980", 8, True, False), fact("four", "", 9, False, False)])
    assert list(got) == [("third", "1990", 2), ("third", "", 2), ("four", "1980", 8), ("four", "", 8)]
