"""Decisions of reconciliation on small cases, and its invariants."""

import pytest

from catalogspark.operators import merge, reconcile
from catalogspark.streaming import refresh

SCHEMA = "seq long, movie_title string, release_date string, studio string, tmdb_id string, media_type string, imdb_id string, bluray_url string, evidence_type string, quote string"


def frame(spark, rows):
    base = {"release_date": "Unknown", "studio": "Unknown", "tmdb_id": "", "media_type": "movie", "imdb_id": "", "bluray_url": "", "evidence_type": "table-row", "quote": "q"}
    return spark.createDataFrame([tuple({**base, **r}[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)


CASES = {
    "unique merge": ([dict(movie_title="Red Rain", release_date="1989", tmdb_id="5")], [dict(movie_title="Red Rain")], {"merged": 1, "catalog": 1, "additions": 0}),
    "punctuation": ([dict(movie_title="Tower: Chapter 2", release_date="2019")], [dict(movie_title="Tower Chapter 2")], {"merged": 1, "catalog": 1, "additions": 0}),
    "apostrophe": ([dict(movie_title="Sorcerer's Lamp", release_date="2001")], [dict(movie_title="Sorcerers Lamp!")], {"merged": 1, "catalog": 1, "additions": 0}),
    "remake": ([dict(movie_title="Scream On", release_date="1996"), dict(movie_title="Scream On", release_date="2022")], [dict(movie_title="Scream On")], {"ambiguous-yearless-title": 1, "catalog": 2, "additions": 0}),
    "unmatched": ([], [dict(movie_title="Nowhere")], {"missing-year-no-match": 1, "catalog": 0, "additions": 0}),
    "fresh": ([], [dict(movie_title="New One", release_date="2020")], {"catalog": 1, "additions": 1}),
    "two namespaces": ([dict(movie_title="Heat Wave", release_date="1995", tmdb_id="9", media_type="movie")], [dict(movie_title="Heat Wave", release_date="1995", tmdb_id="9", media_type="tv")], {"identity-conflict": 1, "catalog": 1, "additions": 0}),
    "second season": (
        [dict(movie_title="Show: Season 1", release_date="2010", tmdb_id="7", media_type="tv")],
        [dict(movie_title="Show: Season 2", release_date="2011", tmdb_id="7", media_type="tv")],
        {"catalog": 2, "additions": 1},
    ),
    "one season twice": (
        [dict(movie_title="Show: The Complete First Season", release_date="2010", tmdb_id="7", media_type="tv")],
        [dict(movie_title="Show Season 1", release_date="2010", tmdb_id="7", media_type="tv")],
        {"merged": 1, "catalog": 1, "additions": 0},
    ),
    "chain in one block": ([], [dict(movie_title="Echo", release_date="2000"), dict(movie_title="Echo!", release_date="2000"), dict(movie_title="ECHO", release_date="2000-05-01")], {"merged": 2, "catalog": 1, "additions": 1}),
}


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    old, new, want = CASES[name]
    number = lambda rows, start: [dict(r, seq=start + i) for i, r in enumerate(rows)]
    catalog, decisions = reconcile.reconcile(frame(spark, number(old, 0)), frame(spark, number(new, 100)))
    assert {r.outcome: r.n for r in reconcile.counts(catalog, decisions).collect()} == want


def test_replay_adds_nothing(spark):
    rows = frame(spark, [dict(seq=i, movie_title=f"Film {i % 4}", release_date=str(2000 + i % 4), tmdb_id=str(i % 4)) for i in range(4)])
    catalog, _ = reconcile.reconcile(rows.limit(0), rows)
    again, decisions = reconcile.reconcile(catalog.select(*reconcile.COLUMNS), rows.withColumn("seq", rows.seq + 50))
    assert again.where("is_addition").count() == 0 and again.count() == 4
    assert merge.duplicate_identity(again).count() == 0


def test_stream_folds_once(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = frame(spark, [dict(seq=i, movie_title=f"Film {i}", release_date="2000") for i in range(3)])
    rows.write.parquet(source)
    fold = lambda known, batch: batch if known is None else known.unionByName(batch)
    first = refresh.stream_reconcile(spark, source, rows.schema, str(tmp_path / "out"), fold)
    again = refresh.stream_reconcile(spark, source, rows.schema, str(tmp_path / "out"), fold)
    assert first == again and spark.read.parquet(again).count() == 3
