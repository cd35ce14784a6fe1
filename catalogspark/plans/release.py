"""Queries of publishing, streaming, lineage, files and custom extractors, over candidates made of `part`."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalogspark.operators import compare, publish, reconcile as R, records
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query
from catalogspark.session import shared_folder, spread
from catalogspark.sources import custom, lists, routes
from catalogspark.streaming import refresh


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}"


def _films(spark, sf_dir):
    """Rows 0 and 1 of four are known, 2 is new, 3 names the film of 0 again with another spelling, an outside id and a full date."""
    part = spread(read(spark, sf_dir, "part"))
    rows = part.selectExpr(
        "p_partkey AS seq", "CASE WHEN p_partkey % 4 = 3 THEN 'The, Film No ' || (p_partkey - 3) || '!' ELSE 'the film no ' || p_partkey END AS movie_title",
        "CASE WHEN p_partkey % 4 = 3 THEN '2001-02-03' ELSE '2001' END AS release_date", "p_brand AS studio", "'' AS tmdb_id", "'movie' AS media_type", "CASE WHEN p_partkey % 4 = 3 THEN 'tt' || p_partkey ELSE '' END AS imdb_id", "'' AS bluray_url",
        "CASE WHEN p_partkey % 8 = 2 THEN 'ai-extracted' ELSE 'table-row' END AS evidence_type", "p_name AS quote",
    )
    return rows.where("seq >= 4")


#: The same rows, and for each film the row that names it again.
FILMS = "f AS (SELECT p_partkey AS k, p_partkey % 4 AS m, p_brand FROM part WHERE p_partkey >= 4), p AS (SELECT a.k, a.m, a.p_brand, b.k AS again FROM f a LEFT JOIN f b ON b.k = a.k + 3 AND a.m = 0 WHERE a.m <> 3)"


@query(f"WITH {FILMS} SELECT k AS seq, CASE WHEN again IS NULL THEN CAST(k AS STRING) ELSE k || ',' || again END AS sources, m = 2 AS is_addition, CASE WHEN again IS NULL THEN '' ELSE 'tt' || again END AS imdb_id, CASE WHEN again IS NULL THEN '2001' ELSE '2001-02-03' END AS release_date FROM p")
def catalog_lineage(spark, sf_dir):
    """Every row of the reconciled catalog with the rows that went into it."""
    rows = _films(spark, sf_dir)
    catalog, _ = R.reconcile(rows.where("seq % 4 < 2"), rows.where("seq % 4 > 1"))
    return catalog.select("seq", F.array_join(F.transform("sources", lambda x: x.cast("string")), ",").alias("sources"), "is_addition", "imdb_id", "release_date")


@query("SELECT (SELECT count(*) FROM part WHERE p_partkey >= 4 AND p_partkey % 4 IN (1, 2)) AS pending, (SELECT count(*) FROM part WHERE p_partkey >= 4 AND p_partkey % 4 = 2) AS new, EXISTS (SELECT 1 FROM part WHERE p_partkey >= 4 AND p_partkey % 4 = 2) AS has_new")
def delta_summary(spark, sf_dir):
    rows = _films(spark, sf_dir).where("seq % 4 < 3")
    return R.delta_summary(rows.where("seq % 4 = 0"), rows.where("seq % 4 < 2"), rows)


@query(f"WITH {FILMS} SELECT k AS seq, CASE WHEN k % 8 = 2 THEN 'codex-ai' ELSE 'Unknown' END AS source_label, m = 2 AS is_addition, CASE WHEN again IS NULL THEN '' ELSE 'tt' || again END AS imdb_id, 2 AS version, (SELECT count(*) FROM p) AS n_rows, (SELECT count(*) FROM p WHERE m = 2) AS n_additions FROM p")
def published_catalog(spark, sf_dir):
    """A first version, a batch that becomes the second, and one that fails its audit; read back through the current version."""
    rows, folder = _films(spark, sf_dir), _folder(spark)
    nothing = spark.createDataFrame([], "seq long, reason string, candidate string, implicated string")
    publish.publish(rows.where("seq % 4 < 2"), nothing, folder)
    publish.publish_batch(rows.where("seq % 4 > 1"), folder)
    twice = rows.where("seq % 4 = 0")
    try:
        publish.publish(twice.unionByName(twice.withColumn("seq", -F.col("seq"))), nothing, folder)
    except publish.NotPublishable:
        pass
    head = publish.current(spark, folder, "counts")
    return publish.current(spark, folder).select("seq", "source_label", "is_addition", "imdb_id").crossJoin(head.select("version", "n_rows", "n_additions"))  # one row of counts


@query(f"WITH {FILMS} SELECT 2 AS n_versions, count(*) AS n_rows, count(again) AS n_merged, count(*) FILTER (m = 2) AS n_second FROM p")
def stream_reconcile(spark, sf_dir):
    """A stream of two candidate files folded into catalog versions, and the same files once more with the checkpoint lost."""
    rows, folder = _films(spark, sf_dir), _folder(spark)
    for name, part in (("1", rows.where("seq % 4 < 2")), ("2", rows.where("seq % 4 > 1"))):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")  # one file a batch

    def fold(known, batch):
        old = batch.limit(0) if known is None else known
        return R.reconcile(old.select(*R.COLUMNS), batch.select(*R.COLUMNS))[0].select(*R.COLUMNS, "is_addition")

    first = refresh.stream_reconcile(spark, f"{folder}/in", rows.schema, folder, fold, files=1)
    newest = refresh.stream_reconcile(spark, f"{folder}/in", rows.schema, folder, fold, files=1, checkpoint="checkpoint-lost")
    assert first == newest
    out = spark.read.parquet(newest)
    n = int(newest.rsplit("-", 1)[1]) + 1
    return out.agg(F.lit(n).alias("n_versions"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("imdb_id") != "").alias("n_merged"), F.count_if(F.col("seq") % 4 == 2).alias("n_second"))


@query("SELECT p_partkey AS page_id, 'own' AS evidence_type, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN 'Unknown' ELSE CAST(1970 + p_size AS STRING) END AS year FROM part UNION ALL SELECT p_partkey, 'own', p_brand || ' again', '1999' FROM part WHERE p_partkey % 5 = 0")
def custom_extractor(spark, sf_dir):
    """Pages of a form that no built-in route reads, by a user's table function in the place of one."""
    pages = spread(read(spark, sf_dir, "part")).selectExpr("p_partkey AS page_id", "'https://own.example/' || p_partkey AS url", "'<p>' || p_name || ' ::' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || (1970 + p_size) END || '</p><p>no mark</p>' || CASE WHEN p_partkey % 5 = 0 THEN '<b>' || p_brand || ' again :: 1999</b>' ELSE '' END AS html")
    found, _ = routes.route_sources(pages, pages.select("url", F.lit("").alias("strictness")), {"evidence": custom.as_extractor(custom.colon_lines, "own")})
    return found.select("page_id", "evidence_type", "title", "year")


@query("SELECT count(*) AS releases, count(*) FILTER (tmdb_id <> '') AS resolved, count(*) FILTER (tmdb_id = '') AS unresolved, count(*) FILTER (release_date = 'Unknown') AS yearless FROM v_rel")
def observed_metrics(spark, sf_dir):
    """The counters of a build, taken while its rows are written."""
    rows, seen = publish.observed(view(spark, sf_dir, "v_rel"))
    rows.write.parquet(f"{_folder(spark)}/rows")
    got = seen.get
    return spark.createDataFrame([tuple(got[k] for k in ("releases", "resolved", "unresolved", "yearless"))], "releases long, resolved long, unresolved long, yearless long")


_SAID = "'line one of ' || movie_title || ', \"quoted\"' || chr(10) || 'line two'"


@query(f"SELECT 'candidates' AS file, seq, title AS name, {_SAID.replace('movie_title', 'title')} AS body FROM v_cand UNION ALL SELECT 'catalog', CAST(substr(quote, strpos(quote, ' quote ') + 7) AS BIGINT), movie_title, coalesce(nullif(tmdb_id, ''), '-') || media_type FROM v_rel")
def file_round_trips(spark, sf_dir):
    """Candidates through CSV, with commas, quotes and line ends in fields, and the catalog through JSON; both read back."""
    folder = _folder(spark)
    cand = view(spark, sf_dir, "v_cand").withColumn("evidence", F.expr(_SAID.replace("movie_title", "title")))
    records.write_candidates(cand, f"{folder}/candidates")
    lists.write_catalog(view(spark, sf_dir, "v_rel"), f"{folder}/catalog")
    a = records.read_candidates(spark, f"{folder}/candidates").select(F.lit("candidates").alias("file"), "seq", F.col("title").alias("name"), F.col("evidence").alias("body"))
    b = lists.read_catalog(spark, f"{folder}/catalog", lines=True)
    number = F.element_at(F.split("fel_evidence.quote", " quote "), -1).cast("long")
    return a.unionByName(b.select(F.lit("catalog").alias("file"), number.alias("seq"), F.col("movie_title").alias("name"), F.concat(F.coalesce(F.nullif("tmdb_id", F.lit("")), F.lit("-")), "media_type").alias("body")))


@query("SELECT seq, movie_title FROM v_rel WHERE media_type = 'tv' OR imdb_id = ''")
def sync_skipped(spark, sf_dir):
    return compare.sync_skipped(view(spark, sf_dir, "v_rel"))
