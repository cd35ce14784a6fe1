"""Queries of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.functions import urls as U
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query

KEY_SQL = "trim(regexp_replace(regexp_replace(replace(lower(strip_accents({0})), '&', ' and '), '[''`’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT seq, {KEY_SQL.format('movie_title')} AS title_key, regexp_extract(release_date, '(19|20)[0-9][0-9]') AS year FROM v_rel")
def title_keys(spark, sf_dir):
    return view(spark, sf_dir, "v_rel").select("seq", X.title_key(F.col("movie_title")).alias("title_key"), X.year_of(F.col("release_date")).alias("year"))


@query(
    f"""
SELECT seq, array_to_string(list_transform(string_split({KEY_SQL.format("title || ' Four Colours two'")}, ' '),
  lambda x: CASE x WHEN 'colour' THEN 'color' WHEN 'colours' THEN 'colors' WHEN 'one' THEN '1' WHEN 'two' THEN '2' WHEN 'three' THEN '3' WHEN 'four' THEN '4' WHEN 'five' THEN '5'
                 WHEN 'six' THEN '6' WHEN 'seven' THEN '7' WHEN 'eight' THEN '8' WHEN 'nine' THEN '9' WHEN 'ten' THEN '10' ELSE x END), ' ') AS orthographic_key
FROM v_seasons"""
)
def orthographic_keys(spark, sf_dir):
    return view(spark, sf_dir, "v_seasons").select("seq", X.orthographic_key(F.concat("title", F.lit(" Four Colours two"))).alias("orthographic_key"))


@query(
    """
SELECT p_partkey AS seq,
       CASE p_partkey % 10 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name WHEN 3 THEN p_name || ' & ' || p_brand WHEN 4 THEN upper(p_name)
                           WHEN 5 THEN '101 Dalmatians ' || p_name WHEN 6 THEN p_name WHEN 7 THEN p_name || ' été' WHEN 8 THEN p_name || ' (No Way Out)' ELSE 'Café ' || p_name || ' d''Or' END AS title
FROM part"""
)
def clean_titles(spark, sf_dir):
    return view(spark, sf_dir, "v_titles").select("seq", X.clean_title(F.col("title")).alias("title"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]') THEN 'https://' || lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) || rtrim(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/') ELSE '' END AS url_key FROM pages")
def url_keys(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.url_key(F.col("url")).alias("url_key"))


_SOURCES = """
SELECT p_partkey AS seq,
       CASE p_partkey % 8 WHEN 0 THEN 'https://old.reddit.com/r/x/comments/AB' || CAST(p_partkey AS STRING) || '/some_title/?sort=new'
                          WHEN 1 THEN 'https://www.avsforum.com/threads/a-b.' || CAST(p_partkey AS STRING) || '/'
                          WHEN 2 THEN 'http://forum.makemkv.com/forum/viewtopic.php?t=' || CAST(p_partkey AS STRING) || '&f=12&p=1'
                          WHEN 3 THEN 'https://docs.google.com/spreadsheets/d/S' || CAST(p_partkey AS STRING) || '/edit#gid=007'
                          WHEN 4 THEN 'https://Example.com:8443/a/?b=2&a=1' WHEN 5 THEN 'HTTPS://example.com:443/A/' || CAST(p_partkey AS STRING) || '#x'
                          WHEN 6 THEN 'https://www.reddit.com/r/lists/' ELSE '  http://example.org/' || CAST(p_partkey AS STRING) || '?z&y=  ' END AS url
FROM part"""


@query(
    """
SELECT p_partkey AS seq,
       CASE p_partkey % 8 WHEN 0 THEN 'reddit:ab' || CAST(p_partkey AS STRING) WHEN 1 THEN 'avsforum:' || CAST(p_partkey AS STRING)
                          WHEN 2 THEN 'http://forum.makemkv.com/forum/viewtopic.php?p=1&t=' || CAST(p_partkey AS STRING) WHEN 3 THEN 'https://docs.google.com/spreadsheets/d/S' || CAST(p_partkey AS STRING) || '/edit#gid=7'
                          WHEN 4 THEN 'https://example.com:8443/a?a=1&b=2' WHEN 5 THEN 'https://example.com/A/' || CAST(p_partkey AS STRING)
                          WHEN 6 THEN 'https://reddit.com/r/lists' ELSE 'http://example.org/' || CAST(p_partkey AS STRING) || '?y=&z=' END AS source_key
FROM part"""
)
def source_keys(spark, sf_dir):
    rows = spark.sql(_SOURCES.replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))
    return rows.select("seq", U.source_key(F.col("url")).alias("source_key"))


@query("SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '([^/:])/+$', '\\1') AS search_url FROM pages")
def search_urls(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.search_url(F.col("url")).alias("search_url"))


_UNSAFE = """
SELECT p_partkey AS seq,
       CASE p_partkey % 10 WHEN 0 THEN 'https://Example.com:443/a#b' WHEN 1 THEN 'ftp://example.com/' WHEN 2 THEN 'http://u:p@example.com/' WHEN 3 THEN 'http://localhost/x' WHEN 4 THEN 'http://10.1.2.3/'
                           WHEN 5 THEN 'http://example.com/%zz' WHEN 6 THEN 'http://exa mple.com/' WHEN 7 THEN 'http://example.com:0/' WHEN 8 THEN 'http://-bad-/' ELSE 'http://example.org:8080/p?q=' || CAST(p_partkey AS STRING) END AS url
FROM part"""


@query(
    """
SELECT p_partkey AS seq,
       CASE p_partkey % 10 WHEN 0 THEN 'https://example.com/a' WHEN 9 THEN 'http://example.org:8080/p?q=' || CAST(p_partkey AS STRING) END AS safe_url,
       CASE p_partkey % 10 WHEN 1 THEN 'bad-scheme' WHEN 2 THEN 'user-info' WHEN 3 THEN 'local-host' WHEN 4 THEN 'private-address' WHEN 5 THEN 'bad-escape' WHEN 6 THEN 'bad-character' WHEN 7 THEN 'bad-port' WHEN 8 THEN 'bad-host' END AS reject_reason
FROM part"""
)
def safe_urls(spark, sf_dir):
    rows = spark.sql(_UNSAFE.replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))
    return rows.select("seq", U.safe_url(F.col("url")).alias("safe_url"), U.reject_reason(F.col("url")).alias("reject_reason"))


@query(
    """
SELECT p_partkey AS seq, (p_partkey % 10) IN (0, 1, 3, 4, 5, 6, 7, 8) AS edition, (p_partkey % 10) IN (0, 1, 2, 3, 4, 6, 7) AS season,
       CASE p_partkey % 10 WHEN 0 THEN p_size WHEN 1 THEN 3 WHEN 4 THEN 1 + p_size % 9 WHEN 6 THEN 2 END AS season_number,
       CASE p_partkey % 10 WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN '3' WHEN 3 THEN 'series' WHEN 4 THEN CAST(1 + p_size % 9 AS STRING) WHEN 6 THEN '2' END AS season_identity
FROM part"""
)
def season_labels(spark, sf_dir):
    t = F.col("title")
    return view(spark, sf_dir, "v_seasons").select("seq", X.has_edition(t).alias("edition"), X.has_season(t).alias("season"), X.season_number(t).alias("season_number"), X.season_identity(t).alias("season_identity"))


@query(
    """
SELECT p_partkey AS seq, CASE p_partkey % 9 WHEN 0 THEN 'TrueHD Atmos' WHEN 1 THEN 'DD+ Atmos' WHEN 2 THEN 'DTS:X|DTS-HD MA' WHEN 3 THEN 'English Stereo' WHEN 5 THEN 'TrueHD' WHEN 8 THEN 'DD+' ELSE '' END AS audio
FROM part"""
)
def audio_tokens(spark, sf_dir):
    return view(spark, sf_dir, "v_audio").select("seq", F.array_join(X.audio_tokens(F.col("audio")), "|").alias("audio"))


@query(
    """
SELECT p_partkey AS seq, CASE p_partkey % 5 WHEN 0 THEN CAST(1970 + p_size AS STRING) || '-06-05' WHEN 3 THEN '2019-12-31' ELSE '' END AS iso,
       CASE p_partkey % 4 WHEN 0 THEN CAST(1970 + p_size AS STRING) || '-00-00' WHEN 1 THEN CAST(1970 + p_size AS STRING) || '-07-00' WHEN 2 THEN CAST(1970 + p_size AS STRING) || '-07-09' ELSE 'Unknown' END AS padded
FROM part"""
)
def date_forms(spark, sf_dir):
    return view(spark, sf_dir, "v_dates").select("seq", X.long_date(F.col("spoken")).alias("iso"), X.pad_date(F.col("written")).alias("padded"))


_CELLS = """
SELECT p_partkey AS seq, p_name, p_size,
       CASE p_partkey % 6 WHEN 0 THEN replace(p_name, ' ', '.') || '.' || CAST(1970 + p_size AS STRING) WHEN 1 THEN p_name || ' (' || CAST(1970 + p_size AS STRING) || ') UK' WHEN 2 THEN p_name
                          WHEN 3 THEN p_name || ' 2.0 - ' || CAST(1970 + p_size AS STRING) WHEN 4 THEN p_name || '_' || CAST(1970 + p_size AS STRING) || '_' ELSE p_name || ' ' || CAST(1970 + p_size AS STRING) || ' extra' END AS cell
FROM part"""


@query(
    """
SELECT p_partkey AS seq, CASE p_partkey % 6 WHEN 3 THEN p_name || ' 2.0' WHEN 5 THEN p_name || ' ' || CAST(1970 + p_size AS STRING) || ' extra' ELSE p_name END AS title,
       CASE WHEN p_partkey % 6 IN (2, 5) THEN 'Unknown' ELSE CAST(1970 + p_size AS STRING) END AS year
FROM part"""
)
def split_title_year(spark, sf_dir):
    rows = spark.sql(_CELLS.replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))
    return rows.select("seq", X.split_title_year(F.col("cell")).alias("s")).select("seq", "s.title", "s.year")


@query("SELECT p_partkey AS seq, p_brand || '|' || p_type AS aka FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, '' FROM part WHERE p_partkey % 2 = 1")
def aka_titles(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey AS seq", "CASE WHEN p_partkey % 2 = 0 THEN p_name || ' AKA ' || p_brand || ' (1999) and more aka ' || p_type || ', in a list AKA ' || p_brand ELSE p_name || ' akamai' END AS quote")
    return rows.select("seq", F.array_join(X.aka_titles(F.col("quote")), "|").alias("aka"))


_VARIANTS = """
SELECT p_partkey AS seq, p_name AS a,
       CASE p_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN substr(p_name, 1, 2) || substr(p_name, 4) WHEN 2 THEN substr(p_name, 1, 1) || substr(p_name, 3, 1) || substr(p_name, 2, 1) || substr(p_name, 4)
                          WHEN 3 THEN p_name || ' 2' WHEN 4 THEN replace(p_name, ' ', '') WHEN 5 THEN p_name || ' x' ELSE 'q' || substr(p_name, 2) END AS b
FROM part"""


@query(
    f"""
WITH t AS ({_VARIANTS}), k AS (SELECT seq, {KEY_SQL.format("a")} AS x, {KEY_SQL.format("b")} AS y FROM t)
SELECT seq, x = y OR (regexp_extract_all(x, '[0-9]+') = regexp_extract_all(y, '[0-9]+') AND (replace(x, ' ', '') = replace(y, ' ', '')
  OR (len(string_split(x, ' ')) = len(string_split(y, ' ')) AND least(length(replace(x, ' ', '')), length(replace(y, ' ', ''))) >= 5 AND damerau_levenshtein(replace(x, ' ', ''), replace(y, ' ', '')) = 1))) AS variants
FROM k"""
)
def spelling_variants(spark, sf_dir):
    rows = spark.sql(_VARIANTS.replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))
    return rows.select("seq", X.spelling_variants(F.col("a"), F.col("b")).alias("variants"))


@query("SELECT p_partkey AS seq, CASE p_partkey % 3 WHEN 0 THEN 'https://docs.google.com/spreadsheets/d/S' || CAST(p_partkey AS STRING) || '/gviz/tq?tqx=out:csv&gid=12' WHEN 1 THEN 'https://docs.google.com/spreadsheets/d/S' || CAST(p_partkey AS STRING) || '/gviz/tq?tqx=out:csv&gid=0' END AS fetch_url FROM part")
def rewrite_urls(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey AS seq", "CASE p_partkey % 3 WHEN 0 THEN 'https://docs.google.com/spreadsheets/d/S' || p_partkey || '/edit#gid=12' WHEN 1 THEN 'https://docs.google.com/spreadsheets/d/S' || p_partkey || '/edit' ELSE 'https://example.com/x/' || p_partkey END AS url")
    return rows.select("seq", U.sheet_export(F.col("url")).alias("fetch_url"))
