"""Publishing by versions, its audit and its races; files there and back; a user's extractor; sync safety."""

import pytest

from catalogspark.operators import compare, publish, records
from catalogspark.sources import custom, routes
from tests.test_reconcile import frame


def film(seq, title, **more):
    return dict(seq=seq, movie_title=title, release_date="2001", **more)


@pytest.fixture
def review(spark):
    return spark.createDataFrame([], "seq long, reason string, candidate string, implicated string")


def titles(spark, folder):
    return sorted(r.movie_title for r in publish.current(spark, folder).collect())


def test_nothing_published(spark, tmp_path):
    assert publish.current(spark, str(tmp_path)) is None and publish.versions(spark, str(tmp_path)) == []


def test_failed_audit_keeps_the_old_version(spark, tmp_path, review):
    folder = str(tmp_path)
    assert publish.publish(frame(spark, [film(0, "One")]), review, folder) == 1
    with pytest.raises(publish.NotPublishable, match="one release: Two"):
        publish.publish(frame(spark, [film(0, "Two"), film(1, "two!")]), review, folder)
    assert titles(spark, folder) == ["One"]
    assert publish.publish(frame(spark, [film(0, "Three"), film(1, "Four", evidence_type="ai-extracted")]), review, folder) == 2
    assert titles(spark, folder) == ["Four", "Three"]
    assert {r.movie_title: r.source_label for r in publish.current(spark, folder).collect()} == {"Four": "codex-ai", "Three": "Unknown"}
    assert publish.current(spark, folder, "counts").first().asDict() == {"n_rows": 2, "n_additions": 0, "n_review": 0, "version": 2}


def test_a_rival_commit_is_refused(spark, tmp_path, review, monkeypatch):
    """Two writers that both read version 1 as current: the second to commit fails, and the first one's rows stay."""
    folder = str(tmp_path)
    publish.publish(frame(spark, [film(0, "One")]), review, folder)
    real, calls = publish.audit, []

    def slow(catalog, counts):
        if not calls:
            calls.append(1)
            publish.publish(frame(spark, [film(0, "Rival")]), review, folder)
        return real(catalog, counts)

    monkeypatch.setattr(publish, "audit", slow)
    with pytest.raises(publish.NotPublishable, match="someone else"):
        publish.publish(frame(spark, [film(0, "Late")]), review, folder)
    assert titles(spark, folder) == ["Rival"]


def test_lost_rows_and_labels_fail_the_audit(spark):
    rows = frame(spark, [film(0, "One", evidence_type="ai-extracted")]).selectExpr("*", "'page' as source_label")
    assert publish.audit(rows, {"releases": 2}) == ["2 rows were written, 1 are there", "1 model-made rows lack their label"]


def test_candidate_csv(spark, tmp_path):
    rows = [(1, 'A, "B"', "2001", "http://x/", 'say "no"\nand, go', "m"), (2, " edge ", "Unknown", "", "", "")]
    records.write_candidates(spark.createDataFrame(rows, records.CANDIDATES), str(tmp_path / "c"))
    assert sorted(map(tuple, records.read_candidates(spark, str(tmp_path / "c")).collect())) == rows
    (tmp_path / "other.csv").write_text('Title,year,seq\n"One, Two",1999,7\n')
    assert list(map(tuple, records.read_candidates(spark, str(tmp_path / "other.csv")).collect())) == [(7, "One, Two", "1999", "", "", "")]


def test_compare_runs_writes_what_it_returns(spark, tmp_path):
    make = lambda rows, name: records.write_candidates(spark.createDataFrame([(i, t, y, "http://x/", "e", "m") for i, (t, y) in enumerate(rows)], records.CANDIDATES), str(tmp_path / name))
    make([("One Film", "2001"), ("Two Film", "2002")], "a")
    make([("One Film", "2001"), ("Other", "1990")], "b")
    rows, listings, summary = records.compare_runs(str(tmp_path / "a"), str(tmp_path / "b"), spark, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "found")).count() == rows.count() == 4
    assert {r.listing for r in spark.read.text(str(tmp_path / "out" / "listings")).collect()} == {r.listing for r in listings.collect()}
    assert spark.read.json(str(tmp_path / "out" / "summary")).first().n_both == summary.first().n_both == 1


def test_custom_extractor(spark):
    pages = spark.createDataFrame([(1, "https://own.example/1", "<p>A :: 2001</p><p>B ::</p>"), (2, "https://own.example/2", "nothing"), (3, "https://own.example/3", None)], "page_id long, url string, html string")
    registry = pages.selectExpr("url", "'' as strictness")
    found, errors = routes.route_sources(pages, registry, {"evidence": custom.as_extractor(custom.colon_lines, "own kind")})
    assert sorted((r.page_id, r.title, r.year, r.evidence_type) for r in found.collect()) == [(1, "A", "2001", "own kind"), (1, "B", "Unknown", "own kind")]
    assert [r.page_id for r in errors.collect()] == [3]


def test_sync_refuses_to_empty_the_list(spark):
    rows = frame(spark, [film(0, "A", imdb_id="bad"), film(1, "B", imdb_id="tt1", media_type="tv")])
    there = spark.createDataFrame([("tt9",)], "imdb_id string")
    with pytest.raises(ValueError):
        compare.sync_diff(rows, there)
    assert [tuple(r) for r in compare.sync_diff(rows, there, allow_empty=True).collect()] == [("tt9", "remove", 0)]
    assert sorted(r.movie_title for r in compare.sync_skipped(rows).collect()) == ["A", "B"]
