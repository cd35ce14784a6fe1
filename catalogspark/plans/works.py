"""Queries of works, discovery, earlier runs, routing and the whole build."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import discovery, evidence, lookup, markup, reconcile, records
from catalogspark.operators import enrich as N
from catalogspark.operators import works as W
from catalogspark.plans import build
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query
from catalogspark.session import spread
from catalogspark.sources import lists, routes

G = "CAST(floor(p_partkey / 4) AS BIGINT)"
I = "p_partkey % 4"  # noqa: E741
# Four rows a work id; the work's number modulo 6 says what joins their titles.
_WORKS = f"""
SELECT p_partkey AS seq, {G} AS g, {I} AS i,
  CASE {G} % 6
    WHEN 0 THEN CASE {I} WHEN 0 THEN 'The Colour of ' || p_brand ELSE 'The Color of it' END
    WHEN 1 THEN CASE {I} WHEN 0 THEN 'Native Name' WHEN 1 THEN 'English Title' WHEN 2 THEN 'native name!' ELSE 'English  Title' END
    WHEN 2 THEN CASE WHEN {I} < 2 THEN 'Original Words' ELSE 'Other Words' END
    WHEN 3 THEN CASE WHEN {I} < 2 THEN 'The Colours' ELSE 'The Colors' END
    WHEN 4 THEN CASE {I} WHEN 0 THEN 'A Film Extended Cut' ELSE 'A Film' END
    ELSE CASE WHEN {I} < 2 THEN 'Harbour Lights' ELSE 'Harbuor Lights' END END AS movie_title,
  CASE WHEN {G} % 12 = 5 AND {I} = 3 THEN '1999' ELSE '2001' END AS release_date,
  'w' || CAST({G} AS STRING) AS tmdb_id, 'movie' AS media_type, 'tt1' AS imdb_id,
  CASE {I} WHEN 1 THEN 'http://d.example/a/' WHEN 2 THEN 'http://d.example/b' ELSE '' END AS bluray_url,
  CASE WHEN {G} % 6 = 1 AND {I} = 3 THEN 'Seen. 12 Native Name AKA English Title 2001. More' ELSE 'q' || CAST(p_partkey AS STRING) END AS quote,
  CASE WHEN {G} % 6 = 2 AND {I} = 0 THEN 'Other Words' ELSE '' END AS tmdb_title, CASE WHEN {G} % 6 = 2 AND {I} = 0 THEN 'Original words' ELSE '' END AS tmdb_original_title,
  'table-row' AS evidence_type, 'Unknown' AS studio
FROM part"""


def _sql_rows(spark, sf_dir, sql):
    return spark.sql(sql.replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))


@query(
    f"""
SELECT 'movie/w' || CAST(g AS STRING) AS identity, n AS n_rows, 2 AS n_titles, CASE g % 6 WHEN 0 THEN false WHEN 4 THEN false WHEN 5 THEN g % 12 <> 5 ELSE true END AS one_work
FROM (SELECT {G} AS g, count(*) AS n FROM part GROUP BY 1)"""
)
def alias_groups(spark, sf_dir):
    """Works 1 (AKA), 2 (recorded titles), 3 (spelling) and half of 5 (a swap, but one year) are proven; 0 and 4 are not."""
    return W.alias_groups(_sql_rows(spark, sf_dir, _WORKS))


@query(
    f"""
SELECT CAST(unnest(CASE WHEN g % 6 IN (1, 2, 3) OR g % 12 = 11 THEN [first] ELSE [first, first + 1, first + 2, first + 3] END) AS BIGINT) AS seq,
  CASE WHEN g % 6 IN (1, 2, 3) OR g % 12 = 11 THEN 4 ELSE 1 END AS n_sources
FROM (SELECT {G} AS g, min(p_partkey) AS first FROM part GROUP BY 1)"""
)
def dedupe_by_work(spark, sf_dir):
    """Proven works become one row; the others stay as they are."""
    out = W.dedupe_by_work(_sql_rows(spark, sf_dir, _WORKS).drop("g", "i"), safe=True)
    return out.select("seq", F.size("sources").alias("n_sources"))


@query(
    f"""
SELECT p_partkey AS seq, CAST(p_partkey AS BIGINT) AS tmdb_id, 'tv' AS media_type FROM part WHERE p_partkey % 4 < 3"""
)
def series_lookup(spark, sf_dir):
    """Season discs of series with a name of their own; a film's title is never looked up among series."""
    name = "md5(CAST(p_partkey AS STRING)) || ' ' || p_name"
    rows = _sql_rows(spark, sf_dir, f"SELECT p_partkey AS seq, CASE p_partkey % 4 WHEN 0 THEN {name} || ': Season 2' WHEN 1 THEN {name} || ' - The Complete First Season' WHEN 2 THEN {name} || ' The Complete Series' ELSE {name} END AS title, CAST(1990 + p_size AS STRING) AS year FROM part")
    series = _sql_rows(spark, sf_dir, f"SELECT p_partkey AS tmdb_id, {name} AS title, '' AS original_title, CAST(1990 + p_size AS STRING) || '-01-01' AS release_date, 100 AS vote_count, 1.0D AS popularity, '/p.jpg' AS poster_path FROM part")
    return lookup.series_lookup(rows, series).select("seq", "tmdb_id", "media_type")


@query("SELECT page_id AS seq, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN url || ' http://b.example/' || CAST(page_id AS STRING) ELSE 'http://b.example/' || CAST(page_id AS STRING) END AS urls FROM pages")
def evidence_urls(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    other = F.concat(F.lit("http://b.example/"), F.col("page_id").cast("string"))
    first = F.when(F.col("page_id") % 3 == 2, F.lit("a file (curated)")).otherwise(F.col("url"))
    more = F.when(F.col("page_id") % 3 == 0, F.array("url")).when(F.col("page_id") % 3 == 1, F.array("url", other, other)).otherwise(F.array(F.lit("x"), other))
    return pages.select(F.col("page_id").alias("seq"), F.array_join(records.evidence_urls(first, more), " ").alias("urls"))


@query(
    r"""
SELECT DISTINCT page_id, lower(root) || '/' || h AS url FROM (SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) AS root, unnest(regexp_extract_all(html, '<a href="/([^"]*)"', 1)) AS h FROM pages)
WHERE contains(lower(h), 'e') AND NOT contains(lower(h), 'ie')"""
)
def candidate_links(spark, sf_dir):
    """Anchors of the real pages, by a wanted and a blocked letter pair in label and path."""
    return markup.extract_links(read(spark, sf_dir, "pages"), "e", "ie")


@query(
    """
SELECT min(page_id) AS seq, u AS url, bool_or(c) AS candidate FROM (
  SELECT page_id, 'https://' || CASE page_id % 5 WHEN 0 THEN 'forum' WHEN 1 THEN 'shop' WHEN 2 THEN 'trakt.tv' WHEN 3 THEN 'wiki' ELSE 'shop' END || CASE page_id % 5 WHEN 2 THEN '' ELSE '.example.com' END || CASE page_id % 5 WHEN 4 THEN '/list/' ELSE '/p/' END || CAST(page_id AS STRING) AS u,
    page_id % 5 IN (0, 4) AS c FROM pages) GROUP BY u"""
)
def classify_sources(spark, sf_dir):
    """Forums and lists that speak of the claim; a shop, a blocked host and a wiki with a blocked word are none."""
    rows = read(spark, sf_dir, "pages").selectExpr(
        "page_id AS seq",
        "'HTTPS://' || CASE page_id % 5 WHEN 0 THEN 'Forum' WHEN 1 THEN 'shop' WHEN 2 THEN 'trakt.tv' WHEN 3 THEN 'wiki' ELSE 'shop' END || CASE page_id % 5 WHEN 2 THEN '' ELSE '.example.com' END || CASE page_id % 5 WHEN 4 THEN '/list/' ELSE '/p/' END || page_id || '/#top' AS url",
        "CASE page_id % 5 WHEN 4 THEN 'Dolby Vision on UHD' ELSE 'Profile-7 FEL' END AS title", "CASE page_id % 5 WHEN 3 THEN 'torrent' ELSE 'notes' END AS description",
    )
    return discovery.classify_sources(rows)


@query("SELECT p_partkey AS row_no, p_name AS title, CAST(1970 + p_size AS STRING) AS year, p_name || ' (' || CAST(1970 + p_size AS STRING) || ') | ' || CASE WHEN p_partkey % 2 = 0 THEN 'Film' ELSE 'a, \"b\"' END || ' | c3 | c4 | c5 | c6 | c7 | c8 | c9 | c10 | c11 | c12 | c13 | c14' AS quote FROM part WHERE p_partkey > 0")
def ingest_trusted_sheet(spark, sf_dir):
    """Fourteen columns, commas and quotes inside cells; the second header row is a row like others."""
    rows = read(spark, sf_dir, "part").selectExpr(
        "'s' AS sheet", "p_partkey AS row_no",
        "CASE WHEN p_partkey = 0 THEN 'Film,Notes' ELSE p_name || ' (' || (1970 + p_size) || '),' || CASE WHEN p_partkey % 2 = 0 THEN 'Film' ELSE '\"a, \"\"b\"\"\"' END || ',c3,c4,c5,c6,c7,c8,c9,c10,c11,c12,c13,c14' END AS line",
    )
    return lists.sheet_rows(rows, trusted=True).select("row_no", "title", "year", "quote")


@query(
    """
SELECT listing, count(*) AS n FROM (SELECT p_partkey % 3 AS k, p_partkey AS id FROM part) p, LATERAL (SELECT unnest(CASE k WHEN 0 THEN ['a_found', 'overlap', 'b_found'] WHEN 1 THEN ['a_found', 'a_only'] ELSE ['b_found', 'b_only'] END) AS listing) GROUP BY listing"""
)
def comparison_outputs(spark, sf_dir):
    """A third of the titles on both sides, a third on each alone."""
    rows = spread(read(spark, sf_dir, "part")).selectExpr("p_partkey AS seq", "md5(CAST(p_partkey AS STRING)) AS title", "'2001' AS year", "'http://x.example' AS source_url", "'q' AS evidence", "'t' AS extraction_method")
    _, listings, _ = records.comparison_outputs(rows.where("seq % 3 in (0, 1)"), rows.where("seq % 3 in (0, 2)"))
    return listings.groupBy("listing").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
SELECT p_partkey AS seq, 'Film no ' || CAST(p_partkey AS STRING) AS title, '2001' AS year, CASE WHEN p_partkey % 4 = 0 THEN 'unknown' ELSE 'http://p.example/' || CAST(p_partkey AS STRING) END AS source_url,
  CASE WHEN p_partkey % 4 = 0 THEN 'Film no ' ELSE 'FILM NO ' END || CAST(p_partkey AS STRING) || ' (2001)' AS evidence FROM part"""
)
def attach_legacy_sources(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    lines = part.selectExpr("p_partkey AS seq", "'Film no ' || p_partkey || ' (2001) | match=100% | source=x' AS line")
    pages = part.where("p_partkey % 4 <> 0").selectExpr("p_partkey AS page_id", "'http://p.example/' || p_partkey AS url", "'see [FILM NO ' || p_partkey || ' (2001)] and [Other  Thing (1999)]' AS text")
    return records.attach_legacy_sources(lines, pages).drop("extraction_method")


@query("SELECT p_partkey % 3 AS kind, count(*) AS n, count(*) FILTER (p_partkey % 3 <> 1) AS passed FROM part GROUP BY 1")
def evaluate_golden(spark, sf_dir):
    """Golden pages: a table row that counts, one whose evidence names another title, a sentence."""
    part = spread(read(spark, sf_dir, "part"))
    title = "upper(substr(p_name, 1, 1)) || substr(p_name, 2)"
    pages = part.selectExpr(
        "p_partkey AS page_id",
        f"""CASE p_partkey % 3 WHEN 0 THEN '<table><tr><th>Title</th><th>Layer</th></tr><tr><td>' || {title} || '</td><td>Profile 7 FEL</td></tr></table>'
        WHEN 1 THEN '<table><tr><th>Title</th><th>Layer</th></tr><tr><td>' || {title} || '</td><td>Another Film is P7 FEL</td></tr></table>' ELSE '<p>' || {title} || ' is Profile 7 FEL.</p>' END AS html""",
    )
    found = evidence.table_evidence(markup.table_rows(pages)).select("page_id", "title").unionByName(evidence.sentence_evidence(markup.text_records(pages)).select("page_id", "title"))
    cases = part.select(F.col("p_partkey").alias("name"), F.array(F.expr(title)).alias("expected"))
    result = records.evaluate_golden(cases, found.select(F.col("page_id").alias("name"), F.lit(0).alias("pos"), "title"))
    return result.groupBy((F.col("name") % 3).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_if("passed").alias("passed"))


_ROUTED = """
SELECT p_partkey AS page_id, CASE p_partkey % 7 WHEN 0 THEN 'https://docs.google.com/spreadsheets/d/' || CAST(p_partkey AS STRING) WHEN 1 THEN 'https://docs.google.com/spreadsheets/t/' || CAST(p_partkey AS STRING)
    WHEN 2 THEN 'https://www.reddit.com/r/x/comments/k' || CAST(p_partkey AS STRING) || '/t' WHEN 3 THEN 'https://github.com/a/' || CAST(p_partkey AS STRING) WHEN 4 THEN 'https://web.archive.org/w/' || CAST(p_partkey AS STRING)
    WHEN 5 THEN 'https://letterboxd.com/l/' || CAST(p_partkey AS STRING) ELSE 'https://forum.example.com/' || CAST(p_partkey AS STRING) END AS url,
  CASE WHEN p_partkey % 7 IN (1, 3, 4, 5) THEN 'always-fel' ELSE 'needs-evidence' END AS strictness,
  CASE p_partkey % 7 WHEN 0 THEN concat('Title,Layer', chr(10), p_name, ' 2001,FEL', chr(10), p_name, ' 2002,MEL') WHEN 1 THEN concat('Film', chr(10), p_name, ' 2001')
    WHEN 2 THEN '<div class="usertext-body"><p>You forgot ' || p_name || ' [2001], Other (1999)</p><p>Are you sure about ' || p_name || ' (2001)</p></div>' WHEN 3 THEN concat('1. ', p_name, ' [2001]', chr(10), 'prose')
    WHEN 4 THEN '<ol><li>' || p_name || ' (2001)</li><li>x MEL (2001)</li></ol>' WHEN 5 THEN '<i data-item-full-display-name="' || p_name || ' (2001)"></i>' ELSE '<p>Film ' || p_name || ' is P7 FEL.</p><p>It is not P7 FEL.</p>' END AS html
FROM part"""


@query(
    """
SELECT route, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT p_partkey AS page_id, unnest(CASE p_partkey % 7 WHEN 0 THEN ['sheet'] WHEN 1 THEN ['trusted-sheet'] WHEN 2 THEN ['comments', 'comments'] WHEN 3 THEN ['markdown'] WHEN 4 THEN ['archive'] WHEN 5 THEN ['items'] ELSE ['evidence'] END) AS route, p_name FROM part) r
WHERE route NOT IN ('markdown', 'archive') GROUP BY route
UNION ALL SELECT CASE p_partkey % 7 WHEN 3 THEN 'markdown' ELSE 'archive' END, count(DISTINCT p_name), count(DISTINCT p_name) FROM part WHERE p_partkey % 7 IN (3, 4) GROUP BY 1"""
)
def route_sources(spark, sf_dir):
    rows = _sql_rows(spark, sf_dir, _ROUTED)
    found, _ = routes.route_sources(rows.drop("strictness"), rows.select("url", "strictness"))
    return found.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


@query(
    """
SELECT outcome, n FROM (SELECT 'rows' AS outcome, count(DISTINCT p_name) AS n FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'negated-fel', count(*) FROM part WHERE p_partkey % 3 = 1 HAVING count(*) > 0 UNION ALL SELECT 'evidence-not-found', count(*) FROM part WHERE p_partkey % 3 = 2 HAVING count(*) > 0)"""
)
def extract_batch(spark, sf_dir):
    rows = _sql_rows(
        spark, sf_dir,
        "SELECT p_partkey AS resp_id, p_name, 'http://x.example/' || CAST(p_partkey AS STRING) AS source_url, p_name || CASE p_partkey % 3 WHEN 1 THEN ' is not P7 FEL' ELSE ' is P7 FEL' END AS claim FROM part",
    )
    pages = rows.select(F.col("source_url").alias("url"), F.concat(F.lit("<p>"), "claim", F.lit("</p>")).alias("text"))
    item = F.struct(F.col("p_name").alias("title"), F.when(F.col("resp_id") % 3 == 2, F.lit("never said")).otherwise(F.col("claim")).alias("evidence"))
    responses = rows.select("resp_id", "source_url", F.to_json(F.struct(F.array(item).alias("items"))).alias("payload"))
    found, rejected = records.extract_batch(responses, pages, F.lit("2020-01-01"))
    return found.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("outcome"), "n").unionByName(rejected.withColumnRenamed("reason", "outcome"))


def _tables(spark, sf_dir, name):
    """Reference tables whose works have names of their own."""
    works = _sql_rows(spark, sf_dir, f"SELECT p_partkey AS tmdb_id, {name} AS title, CASE WHEN p_partkey % 6 = 5 THEN 'Titre ' || p_brand ELSE '' END AS original_title, CAST(1970 + p_size AS STRING) || '-03-01' AS release_date, 100 AS vote_count, 1.0D AS popularity, '/p.jpg' AS poster_path, 'tt' || CAST(p_partkey AS STRING) AS imdb_id, p_brand AS studio FROM part")
    alternatives = _sql_rows(spark, sf_dir, f"SELECT p_partkey AS tmdb_id, 0 AS pos, 'alt ' || {name} AS alt_title FROM part WHERE p_partkey % 6 = 3")
    discs = _sql_rows(spark, sf_dir, f"SELECT p_partkey AS pos, 'https://www.disc.example/movies/' || replace({name}, ' ', '-') || '/' || CAST(p_partkey AS STRING) || '/' AS url, 1970 + p_size AS year, '2020-01-01' AS bluray_release_date, array('HDR10') AS hdr_formats, array('TrueHD') AS audio_formats, array('English') AS audio_languages FROM part WHERE p_partkey % 2 = 0")
    aliases = _sql_rows(spark, sf_dir, f"SELECT 'pinned ' || CAST(p_partkey AS STRING) AS title_key, CAST(1970 + p_size AS STRING) AS year, {name} AS lookup_title, CAST(1970 + p_size AS STRING) AS lookup_year, {name} AS canonical_title FROM part WHERE p_partkey % 6 = 1")
    return works, alternatives, works.where("false"), discs, aliases


_NAME = "substr(md5(CAST(p_partkey AS STRING)), 1, 12)"
_RAW = f"""
SELECT p_partkey AS seq, CASE p_partkey % 6 WHEN 0 THEN {_NAME} WHEN 1 THEN 'Pinned ' || CAST(p_partkey AS STRING) WHEN 2 THEN 'q' || substr(md5('x' || CAST(p_partkey AS STRING)), 1, 12) WHEN 3 THEN 'Alt ' || {_NAME} WHEN 4 THEN {_NAME} ELSE {_NAME} END AS movie_title,
  CASE p_partkey % 6 WHEN 4 THEN 'Unknown' ELSE CAST(1970 + p_size AS STRING) END AS release_date, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE 'Unknown' END AS studio, '' AS bluray_url, 'table-row' AS evidence_type,
  CASE p_partkey % 6 WHEN 2 THEN 'This AKA ' || {_NAME} || ' [2001]' ELSE 'q' || CAST(p_partkey AS STRING) END AS quote, true AS fel_confirmed
FROM part"""


@query(
    f"""
SELECT p_partkey AS seq, {_NAME} AS movie_title, CASE WHEN p_partkey % 6 = 4 THEN '' ELSE CAST(p_partkey AS STRING) END AS tmdb_id, CASE WHEN p_partkey % 6 = 4 THEN '' ELSE 'tt' || CAST(p_partkey AS STRING) END AS imdb_id,
  CASE WHEN p_partkey % 6 = 4 THEN '' ELSE 'https://www.themoviedb.org/movie/' || CAST(p_partkey AS STRING) END AS release_url, CASE WHEN p_partkey % 6 = 4 THEN 'Unknown' ELSE CAST(1970 + p_size AS STRING) || '-03-01' END AS release_date,
  CASE WHEN p_partkey % 5 = 0 THEN p_type WHEN p_partkey % 6 = 4 THEN 'Unknown' ELSE p_brand END AS studio, CASE WHEN p_partkey % 6 = 5 THEN 'Titre ' || p_brand END AS tmdb_original_title,
  CASE WHEN p_partkey % 2 = 0 AND p_partkey % 6 <> 4 THEN 'Dolby Vision HDR10' ELSE '' END AS hdr, CASE WHEN p_partkey % 2 = 0 AND p_partkey % 6 <> 4 THEN 'Yes' ELSE 'Unknown' END AS english_audio
FROM part"""
)
def enrich(spark, sf_dir):
    """By kind: exact, alias, AKA in the quote, alternative title, no year (left alone), exact with an original title."""
    works, alternatives, series, discs, aliases = _tables(spark, sf_dir, _NAME)
    out = N.enrich(_sql_rows(spark, sf_dir, _RAW), works, alternatives, series, discs, aliases)
    return out.select("seq", "movie_title", "tmdb_id", "imdb_id", "release_url", "release_date", "studio", "tmdb_original_title", F.array_join("hdr_formats", " ").alias("hdr"), "english_audio")


def _no_rows(spark):
    return spark.createDataFrame([], "seq long, movie_title string, release_date string, studio string, tmdb_id string, media_type string, imdb_id string, bluray_url string, evidence_type string, quote string")


def _named_works(spark, sf_dir):
    works = _sql_rows(spark, sf_dir, "SELECT min(p_partkey) AS tmdb_id, p_name AS title, '' AS original_title, '2001-05-05' AS release_date, 100 AS vote_count, 1.0D AS popularity, '' AS poster_path, '' AS imdb_id, min(p_brand) AS studio FROM part GROUP BY p_name")
    alternatives = spark.createDataFrame([], "tmdb_id long, pos int, alt_title string")
    discs = spark.createDataFrame([], "pos long, url string, year int, bluray_release_date string, hdr_formats array<string>, audio_formats array<string>, audio_languages array<string>")
    aliases = spark.createDataFrame([], "title_key string, year string, lookup_title string, lookup_year string")
    return works, alternatives, works.where("false"), discs, aliases


@query(
    """
SELECT outcome, n FROM (
  SELECT 'catalog' AS outcome, count(DISTINCT p_name) + 1 AS n FROM part WHERE p_partkey % 7 < 6 UNION ALL SELECT 'additions', count(DISTINCT p_name) + 1 FROM part WHERE p_partkey % 7 < 6
  UNION ALL SELECT 'missing-year-no-match', count(DISTINCT p_name) FROM part WHERE p_partkey % 7 = 6 HAVING count(*) > 0)"""
)
def build_catalog(spark, sf_dir):
    """Pages of all seven routes, works for the listed titles, and an empty catalog to begin with."""
    rows = _sql_rows(spark, sf_dir, _ROUTED)
    catalog, decisions, _ = build.build_catalog(rows.drop("strictness"), rows.select("url", "strictness"), _no_rows(spark), *_named_works(spark, sf_dir))
    return reconcile.counts(catalog, decisions)


@query(
    """
SELECT (SELECT count(*) FROM part WHERE p_partkey % 6 IN (0, 1, 5)) + (SELECT count(*) FROM part WHERE p_partkey % 4 IN (0, 1)) AS ingested, count(*) AS kept, count(*) FILTER (r) AS resolved FROM (
  SELECT k, y, bool_or(p OR y = '2001') AS r FROM (SELECT CASE WHEN p_partkey % 6 = 5 THEN p_name || ' ' || p_brand ELSE p_name END AS k, CAST(1970 + p_size AS STRING) AS y, p_partkey % 6 <> 5 AS p FROM part WHERE p_partkey % 6 IN (0, 1, 5)
    UNION ALL SELECT p_name, CAST(1970 + p_size AS STRING), true FROM part WHERE p_partkey % 4 IN (0, 1)) GROUP BY k, y)"""
)
def bootstrap_catalog(spark, sf_dir):
    _, counts = build.bootstrap_catalog(view(spark, sf_dir, "v_csv"), view(spark, sf_dir, "v_bitrate"), *_named_works(spark, sf_dir))
    return counts
