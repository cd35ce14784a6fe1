"""Queries of reconciliation and of the catalog's way out."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import merge, publish, reconcile as R
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query


def _split(spark, sf_dir):
    rows = view(spark, sf_dir, "v_rel").withColumn("movie_title", F.trim("movie_title"))
    return rows.where("seq % 3 <> 0"), rows.where("seq % 3 = 0")


@query()
def reconcile(spark, sf_dir):
    catalog, decisions = R.reconcile(*_split(spark, sf_dir))
    return R.counts(catalog, decisions)


@query()
def reconcile_review(spark, sf_dir):
    old, new = _split(spark, sf_dir)
    _, decisions = R.reconcile(old, new)
    return publish.review_report(decisions, old.unionByName(new))


@query(
    """
SELECT outcome, n FROM (VALUES
  ('catalog', (SELECT count(*) FROM part WHERE p_partkey % 4 <> 3)), ('additions', (SELECT count(*) FROM part WHERE p_partkey % 4 = 2)),
  ('merged', (SELECT count(*) FROM part a WHERE p_partkey % 4 = 3 AND EXISTS (SELECT 1 FROM part b WHERE b.p_partkey = a.p_partkey - 3)))) v(outcome, n)"""
)
def catalog_delta(spark, sf_dir):
    """Rows 0 and 1 of four are the catalog, 2 is new, 3 names the work of 0 again with another spelling and no year."""
    part = read(spark, sf_dir, "part")
    rows = part.selectExpr(
        "p_partkey AS seq", "CASE WHEN p_partkey % 4 = 3 THEN 'The, Film No ' || (p_partkey - 3) || '!' ELSE 'the film no ' || p_partkey END AS movie_title",
        "CASE WHEN p_partkey % 4 = 3 THEN 'Unknown' ELSE '2001' END AS release_date", "p_brand AS studio", "'' AS tmdb_id", "'movie' AS media_type", "'' AS imdb_id", "'' AS bluray_url", "'table-row' AS evidence_type", "p_name AS quote",
    )
    present = rows.where("seq % 4 = 3").select((F.col("seq") - 3).alias("seq")).join(rows.select("seq"), "seq", "left_semi").select((F.col("seq") + 3).alias("seq"))
    rows = rows.where("seq % 4 <> 3").unionByName(rows.join(present, "seq", "left_semi"))
    catalog, decisions = R.reconcile(rows.where("seq % 4 in (0, 1)"), rows.where("seq % 4 in (2, 3)"))
    return R.counts(catalog, decisions)


@query("SELECT 'AI' AS kind, count(*) AS n FROM v_rel WHERE seq % 3 = 0 UNION ALL SELECT 'own', count(*) FROM v_rel WHERE seq % 3 <> 0")
def enforced_labels(spark, sf_dir):
    rows = view(spark, sf_dir, "v_rel").withColumn("source_label", F.lit("page"))
    return publish.enforce_labels(rows).groupBy(F.when(F.col("source_label") == "codex-ai", "AI").otherwise("own").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query()
def publish_catalog(spark, sf_dir):
    """Stale rows out, titles cleaned, reconciled, exact repeats collapsed, newest first."""
    from catalogspark.functions import text as X

    old, new = _split(spark, sf_dir)
    clean = lambda df: merge.drop_stale(df).withColumn("movie_title", X.clean_title(F.col("movie_title")))
    catalog, _ = R.reconcile(clean(old), clean(new))
    once = merge.dedupe_title_url(catalog)
    padded = X.pad_date(F.col("release_date"))
    by = F.when(F.col("release_date") == X.UNKNOWN, F.lit(1)).otherwise(-F.substring(padded, 1, 4).try_cast("int"))
    return merge.with_rank(once, [padded.desc(), F.col("seq")], by).select("rank", "seq", "movie_title", "release_date", "studio", "tmdb_id", "imdb_id", "is_addition")
