"""Queries of sources and markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.operators import markup
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query
from catalogspark.session import spread
from catalogspark.sources import lists


def _part(spark, sf_dir, sql):
    return spark.sql(sql.replace("FROM part", "FROM {part}"), part=spread(read(spark, sf_dir, "part")))


@query("SELECT page_id AS line_no, url, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS source_key FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') ORDER BY page_id) AS rn FROM pages WHERE page_id % 10 <> 3) WHERE rn = 1")
def source_registry(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select(F.col("page_id").alias("line_no"), F.when(F.col("page_id") % 10 == 3, F.concat(F.lit(" # "), "url")).otherwise(F.concat(F.lit("  "), "url")).alias("line"))
    return lists.registry(rows)


@query("SELECT p_name AS movie_title, p_name || ' q' AS quote, 'Unknown' AS location, 'Unknown' AS studio, '' AS tmdb_id, CASE WHEN p_partkey % 3 = 0 THEN 'tv' ELSE 'movie' END AS media_type, true AS fel_confirmed, 0 AS n_audio, p_partkey AS seq FROM part")
def catalog_roundtrip(spark, sf_dir):
    raw = read(spark, sf_dir, "part").select("p_partkey", F.to_json(F.struct(F.col("p_name").alias("movie_title"), F.struct(F.concat("p_name", F.lit(" q")).alias("quote")).alias("fel_evidence"), F.when(F.col("p_partkey") % 3 == 0, F.lit("tv")).when(F.col("p_partkey") % 3 == 1, F.lit("")).alias("media_type"))).alias("j"))
    rows = lists.with_defaults(raw.select("p_partkey", F.from_json("j", lists.CATALOG).alias("r")).select("p_partkey", "r.*"))
    return rows.select("movie_title", "fel_evidence.quote", "fel_evidence.location", "studio", "tmdb_id", "media_type", "fel_confirmed", F.size("audio_formats").alias("n_audio"), F.col("p_partkey").alias("seq"))


@query(
    """
SELECT p_partkey AS seq, CASE WHEN p_partkey % 6 = 5 THEN p_name || ', ' || p_brand ELSE p_name END AS title, CAST(1970 + p_size AS STRING) AS year,
       CASE WHEN p_partkey % 6 = 0 THEN 'http://a.example/' || CAST(p_partkey AS STRING) || ' http://b.example/x' ELSE '' END AS urls, 'fel-list' AS evidence_type
FROM part WHERE p_partkey % 6 IN (0, 1, 5)"""
)
def ingest_title_csv(spark, sf_dir):
    return lists.title_csv(view(spark, sf_dir, "v_csv")).select("seq", "title", "year", F.array_join("source_urls", " ").alias("urls"), "evidence_type")


@query("SELECT p_partkey AS seq, p_name AS title, CAST(1970 + p_size AS STRING) AS year, CASE p_partkey % 4 WHEN 0 THEN p_size + 0.5 ELSE CAST(p_size AS DOUBLE) END AS bitrate, 'fel-bitrate-list' AS evidence_type FROM part WHERE p_partkey % 4 IN (0, 1)")
def ingest_bitrate_lines(spark, sf_dir):
    return lists.bitrate_lines(view(spark, sf_dir, "v_bitrate"))


_SHEET = """
SELECT * FROM (WITH r AS (SELECT *, p_partkey % 50 < 7 AS head, 'sheet-' || CAST(p_partkey % 7 AS STRING) AS sheet FROM part),
h AS (SELECT *, max(CASE WHEN head THEN p_partkey END) OVER (PARTITION BY sheet ORDER BY p_partkey) AS hp, min(CASE WHEN head THEN p_partkey END) OVER (PARTITION BY sheet ORDER BY p_partkey) AS h1 FROM r)
{0})"""


@query(
    _SHEET.format(
        """SELECT sheet, p_partkey AS row_no, CASE WHEN p_partkey % 3 = 2 THEN 'FEL' ELSE p_name END AS title, CASE WHEN p_partkey % 3 = 2 THEN 'Unknown' ELSE CAST(1970 + p_size AS STRING) END AS year,
 CASE WHEN p_partkey % 3 = 0 THEN '7 | ' || p_name || ' ' || CAST(1970 + p_size AS STRING) || ' | FEL | ' || p_brand WHEN p_partkey % 3 = 2 THEN p_name || ' Trilogy | FEL | FEL' ELSE p_name || '.' || CAST(1970 + p_size AS STRING) || ' | has FEL layer | ' || p_brand END AS quote
FROM h WHERE NOT head AND p_partkey % 50 >= 10 AND hp IS NOT NULL AND ((hp % 2 = 0 AND p_partkey % 3 IN (0, 2)) OR (hp % 2 = 1 AND p_partkey % 3 = 1))"""
    )
)
def ingest_sheet_blocks(spark, sf_dir):
    return lists.sheet_rows(view(spark, sf_dir, "v_sheet")).drop("evidence_type")


@query("SELECT p_partkey AS seq, p_name AS title, CAST(1970 + p_size AS STRING) AS year FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_size ORDER BY p_partkey) AS rn FROM part WHERE p_partkey % 5 IN (0, 1)) WHERE rn = 1")
def ingest_list_lines(spark, sf_dir):
    return lists.list_lines(view(spark, sf_dir, "v_lines"), "github").select("seq", "title", "year")


_ITEMS = """
SELECT p_partkey AS page_id, '<ul><li data-item-full-display-name="' || p_name || ' (' || CAST(1970 + p_size AS STRING) || ')"></li><li data-item-full-display-name="' || upper(p_name) || ' (' || CAST(1970 + p_size AS STRING) || ')">'
  || '<li data-item-full-display-name="' || p_brand || ' &amp; co"></li></ul><a href="/list/x/page/' || CAST(p_size AS STRING) || '/">n</a><a href="/list/x/page/3/">3</a>' AS html FROM part"""


@query("SELECT p_partkey AS page_id, 0 AS pos, p_name AS title, CAST(1970 + p_size AS STRING) AS year FROM part UNION ALL SELECT p_partkey, 2, p_brand || ' & co', 'Unknown' FROM part")
def ingest_item_attributes(spark, sf_dir):
    return lists.item_attributes(_part(spark, sf_dir, _ITEMS))


@query("SELECT p_partkey AS page_id, greatest(p_size, 3) AS n FROM part")
def page_count(spark, sf_dir):
    return _part(spark, sf_dir, _ITEMS).select("page_id", lists.page_count(F.col("html")).alias("n"))


_COMMENTS = """
SELECT p_partkey AS page_id, '<p>' || p_name || ' (1999)</p><div class="md usertext-body x"><p>You forgot ' || p_name || ' (' || CAST(1970 + p_size AS STRING) || '), ' || p_brand || ' (2001)</p><p>I like ' || p_name || ' (1999) a lot</p>'
  || p_name || ' MEL (1998)<br>Is ' || p_name || ' (1997) there? (1996)<br/>' || p_brand || ' (2001)<br>Are you sure about ' || p_name || ' [2004]<br>Odd, Name [2003]</div>' AS html FROM part"""


@query("SELECT p_partkey AS page_id, 0 AS line_no, 0 AS pos, p_name AS title, CAST(1970 + p_size AS STRING) AS year FROM part UNION ALL SELECT p_partkey, 0, 1, p_brand, '2001' FROM part UNION ALL SELECT p_partkey, 3, 0, 'Is ' || p_name || ' (1997) there?', '1996' FROM part UNION ALL SELECT p_partkey, 6, 0, 'Odd, Name', '2003' FROM part")
def ingest_comment_lists(spark, sf_dir):
    return lists.comment_lists(_part(spark, sf_dir, _COMMENTS))


@query("SELECT count(DISTINCT url) AS requested, count(DISTINCT CASE WHEN page_id % 3 = 0 THEN url END) AS found FROM pages")
def page_store_hits(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return lists.page_store_hits(pages, pages.where("page_id % 3 = 0"))


_TABLES = """
SELECT p_partkey AS page_id, '<html><head><title>x</title></head><body><h1>' || p_brand || '</h1><table><tr><th>Title</th><th>Layer</th></tr><tr><td>' || p_name || '</td><td><b>P7</b> FEL</td></tr><tr><td>alone</td></tr>'
  || '<tr><td>a &amp; b</td><td>' || p_type || '</td></tr></table><p>See   <i>' || p_name || '</i>.<br>Next</p><script>var x = "<p>no</p>"</script><!-- <p>gone</p> --><ul><li>one</li><li>two <b>' || p_brand || '</b></li></ul></body></html>' AS html FROM part"""


@query("SELECT p_partkey AS page_id, 0 AS table_no, 1 AS row_no, p_name || '|P7 FEL' AS cells, 'Title|Layer' AS headers FROM part UNION ALL SELECT p_partkey, 0, 3, 'a & b|' || p_type, 'Title|Layer' FROM part")
def table_rows(spark, sf_dir):
    return markup.table_rows(_part(spark, sf_dir, _TABLES)).select("page_id", "table_no", "row_no", F.array_join("cells", "|").alias("cells"), F.array_join("headers", "|").alias("headers"))


#: A table in a cell of another, a list in an item of another, and text of a block beside a block in it.
_NESTED = """
SELECT p_partkey AS page_id, '<table><tr><th>Title</th><th>Layer</th></tr><tr><td>' || p_name || '</td><td>x<table><tr><td>' || p_type || '</td><td>in</td></tr></table>y</td></tr><tr><td>' || p_brand || '</td><td>z</td></tr></table>'
  || '<div>own ' || p_name || '<p>inner</p></div><ul><li>a ' || p_brand || '<ol><li>b<li>c</ol></li><li>d</li></ul>' AS html FROM part"""


@query(
    """
SELECT p_partkey AS page_id, unnest([0, 0, 0, 1]) AS table_no, unnest([1, 2, 3, 0]) AS row_no, unnest([p_name || '|x ' || p_type || ' in y|' || p_type || '|in', p_type || '|in', p_brand || '|z', p_type || '|in']) AS cells,
       unnest(['Title|Layer', 'Title|Layer', 'Title|Layer', NULL]) AS headers FROM part"""
)
def nested_tables(spark, sf_dir):
    return markup.table_rows(_part(spark, sf_dir, _NESTED)).select("page_id", "table_no", "row_no", F.array_join("cells", "|").alias("cells"), F.array_join("headers", "|").alias("headers"))


@query("SELECT p_partkey AS page_id, 'item' AS kind, unnest([0, 1, 2, 3]) AS pos, unnest(['a ' || p_brand || ' b c', 'b', 'c', 'd']) AS text FROM part UNION ALL SELECT p_partkey, 'text', unnest(range(6)), unnest(['own ' || p_name, 'inner', 'a ' || p_brand, 'b', 'c', 'd']) FROM part UNION ALL SELECT p_partkey, 'record', unnest(range(14)), unnest(['Title Layer', 'Title', 'Layer', p_name || ' x ' || p_type || ' in y', p_name, p_type || ' in', p_type, 'in', p_brand || ' z', p_brand, 'z', 'inner', 'b', 'c']) FROM part UNION ALL SELECT p_partkey, 'record', 14, 'd' FROM part")
def nested_records(spark, sf_dir):
    """Items, text records and units of pages with nested elements: only units without units in them count, but for rows."""
    pages = _part(spark, sf_dir, _NESTED)
    kinds = {"item": markup.list_items(pages), "text": markup.text_records(pages), "record": markup.source_records(pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))).toDF("page_id", "pos", "text")}
    parts = [df.select("page_id", F.lit(kind).alias("kind"), "pos", "text") for kind, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
SELECT p_partkey AS page_id, unnest([0, 1, 2, 3, 4]) AS pos, unnest([p_brand, 'See ' || p_name || '.', 'Next', 'one', 'two ' || p_brand]) AS text FROM part"""
)
def page_text_records(spark, sf_dir):
    return markup.text_records(_part(spark, sf_dir, _TABLES))


@query(
    """
SELECT p_partkey AS doc_id, unnest(range(15)) AS pos, unnest([p_brand, 'Title Layer', 'Title', 'Layer', p_name || ' P7 FEL', p_name, 'P7 FEL', 'alone', 'a & b ' || p_type, 'a & b', p_type, 'See ' || p_name || ' .', 'Next', 'one', 'two ' || p_brand]) AS record FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT p_partkey, unnest([0, 1]), unnest([p_name || ' x', p_brand]) FROM part WHERE p_partkey % 2 = 1"""
)
def grounding_records(spark, sf_dir):
    pages = _part(spark, sf_dir, _TABLES).where("page_id % 2 = 0").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    plain = read(spark, sf_dir, "part").where("p_partkey % 2 = 1").selectExpr("p_partkey AS doc_id", "'  ' || p_name || '   x\\n\\n' || p_brand || '\\n' AS text")
    return markup.source_records(pages.unionByName(plain))


@query(
    """
SELECT page_id, pos, trim(regexp_replace(regexp_replace(item, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM (
  SELECT page_id, generate_subscripts(items, 1) - 1 AS pos, unnest(items) AS item FROM (SELECT page_id, regexp_extract_all(html, '<li>((?:[^<]|<a[^>]*>|</a>|<b>|</b>|<br>|<i>|</i>)*)', 1) AS items FROM pages))"""
)
def list_items(spark, sf_dir):
    return markup.list_items(read(spark, sf_dir, "pages"))


@query(
    """
SELECT doc_id, sentence_no, md5(sentence) AS sentence_md5 FROM (SELECT doc_id, generate_subscripts(s, 1) - 1 AS sentence_no, unnest(s) AS sentence FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r\\f\\v]+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM documents)) WHERE length(sentence) <= 16384"""
)
def sentences(spark, sf_dir):
    return markup.sentences(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "sentence_no", F.md5("sentence").alias("sentence_md5"))
