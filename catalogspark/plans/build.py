"""The whole build: pages to candidates, candidates to catalog rows, catalog rows to a reconciled catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import enrich as N
from catalogspark.operators import merge, publish, reconcile
from catalogspark.session import checkpoint as settle
from catalogspark.sources import lists, routes


def rows_of(candidates: DataFrame) -> DataFrame:
    """Candidates (page_id, place, title, year, quote, evidence_type) as catalog rows, numbered by page and place over all of them; of each title and year the first leads."""
    order = [F.col("place"), *[F.col(c) for c in ("title", "year", "quote", "evidence_type")]]
    numbered = merge.with_rank(candidates.select("page_id", "place", "title", "year", "quote", "evidence_type"), order, F.col("page_id"), "seq")
    named = numbered.select(F.col("seq").cast("long").alias("seq"), F.col("title").alias("movie_title"), F.col("year").alias("release_date"), F.lit(X.UNKNOWN).alias("studio"), "quote", "evidence_type", F.lit("").alias("tmdb_id"), F.lit("movie").alias("media_type"), F.lit("").alias("imdb_id"), F.lit("").alias("bluray_url"), F.lit(True).alias("fel_confirmed"))
    keyed = merge.drop_stale(named).withColumns({"title_key": X.title_key(F.col("movie_title")), "_year": X.year_of(F.col("release_date"))})
    return merge.dedupe_merge(keyed, ["title_key", "_year"]).drop("title_key", "_year")


def build_catalog(pages: DataFrame, registry: DataFrame, existing: DataFrame, works: DataFrame, alternatives: DataFrame, series: DataFrame, discs: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(catalog with is_addition, decisions, page errors)."""
    found, errors = routes.route_sources(pages, registry)
    rows = settle(rows_of(settle(found)))
    rich = N.enrich(rows, works, alternatives, series, discs, aliases)
    catalog, decisions = reconcile.reconcile(existing, rich)
    return catalog, decisions, errors


def bootstrap_catalog(title_lines: DataFrame, bitrate_lines: DataFrame, works: DataFrame, alternatives: DataFrame, series: DataFrame, discs: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalog, counts) of a first load: title and bitrate lists, merged and enriched; counts of rows read, kept and resolved."""
    read = lists.title_csv(title_lines).select("seq", "title", "year", "quote", "evidence_type")
    rated = lists.bitrate_lines(bitrate_lines).select("seq", "title", "year", F.concat("title", F.lit(" ("), "year", F.lit(")")).alias("quote"), "evidence_type")
    both = settle(read.withColumn("page_id", F.col("seq")).unionByName(rated.withColumn("page_id", F.col("seq"))).drop("seq").withColumn("place", F.array(F.lit(0).cast("long"))))
    catalog = settle(N.enrich(settle(rows_of(both)), works, alternatives, series, discs, aliases))
    counts = both.agg(F.count(F.lit(1)).alias("ingested")).crossJoin(catalog.agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.col("tmdb_id") != "").alias("resolved")))  # one row each
    return catalog, counts


def publish_build(catalog: DataFrame, decisions: DataFrame, candidates: DataFrame, folder: str) -> int:
    """Exact repeats of title and disc page collapsed, then labels, audit and switch to the new version."""
    once = merge.dedupe_title_url(catalog.drop("sources", "url_key", "year", "title_key"))
    return publish.publish(once, publish.review_report(decisions, candidates), folder)
