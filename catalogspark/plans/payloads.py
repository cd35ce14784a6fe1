"""Queries of model responses, product pages and cached lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import media
from catalogspark.operators import payload
from catalogspark.plans.adapters import read
from catalogspark.plans.registry import query
from catalogspark.streaming import refresh


def _part(spark, sf_dir, sql):
    # Braces of JSON texts are doubled, since the one table is put in by name.
    return spark.sql(sql.replace("{", "{{").replace("}", "}}").replace("FROM part", "FROM {part}"), part=read(spark, sf_dir, "part"))


_PAYLOADS = r"""
SELECT p_partkey AS resp_id, 'http://x.example/' || p_partkey AS source_url,
       CASE p_partkey % 7 WHEN 0 THEN '[{"title":" ' || p_name || ' ","year":' || (1970 + p_size) || ',"evidence":"e"},{"title":5},"x",{"title":"' || p_brand || '"}]'
                          WHEN 1 THEN '{"items":[{"title":"' || p_name || '","year":"2001","evidence":"' || p_type || '"}],"status":"completed"}'
                          WHEN 2 THEN '{"items":[{"title":"a"}],"status":"failed"}' WHEN 3 THEN 'not json' WHEN 4 THEN '{"items":[]}' WHEN 5 THEN '[{"title":"b","year":true}]' ELSE '{"items":[{"title":"a"}],"error":{"code":1}}' END AS payload
FROM part"""


@query(
    """
SELECT p_partkey AS resp_id, 0 AS pos, p_name AS title, CASE p_partkey % 7 WHEN 0 THEN CAST(1970 + p_size AS STRING) ELSE '2001' END AS year, CASE p_partkey % 7 WHEN 0 THEN 'e' ELSE p_type END AS evidence FROM part WHERE p_partkey % 7 IN (0, 1)
UNION ALL SELECT p_partkey, 3, p_brand, 'Unknown', '' FROM part WHERE p_partkey % 7 = 0"""
)
def candidate_payloads(spark, sf_dir):
    return payload.candidates(_part(spark, sf_dir, _PAYLOADS))[0].drop("source_url")


@query("SELECT p_partkey AS resp_id, p_partkey % 7 IN (0, 1, 4) AS valid FROM part")
def payload_validity(spark, sf_dir):
    return payload.candidates(_part(spark, sf_dir, _PAYLOADS))[1]


@query(
    """
SELECT p_partkey AS resp_id, 0 AS pos, 'http://a.example/' || CAST(p_partkey AS STRING) AS url FROM part WHERE p_partkey % 4 IN (0, 1)
UNION ALL SELECT p_partkey, 2, 'http://b.example' FROM part WHERE p_partkey % 4 = 0"""
)
def url_payloads(spark, sf_dir):
    sql = r"""SELECT p_partkey AS resp_id, CASE p_partkey % 4 WHEN 0 THEN '```json' || char(10) || '["http://a.example/' || p_partkey || '", 3, " http://b.example "]' || char(10) || '```'
        WHEN 1 THEN '{"urls":["http://a.example/' || p_partkey || '"]}' WHEN 2 THEN '{"other":[]}' ELSE '{"urls":["http://c.example"],"status":"failed"}' END AS payload FROM part"""
    return payload.links(_part(spark, sf_dir, sql))


@query("SELECT p_partkey AS resp_id, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name || p_brand WHEN 2 THEN '' END AS text FROM part")
def response_text(spark, sf_dir):
    sql = r"""SELECT p_partkey AS resp_id, CASE p_partkey % 5 WHEN 0 THEN '{"output_text":"' || p_name || '"}'
        WHEN 1 THEN '{"status":"completed","output":[{"type":"reasoning"},{"type":"message","status":"completed","content":[{"type":"output_text","text":"' || p_name || '"},{"type":"refusal","text":"no"},{"type":"output_text","text":"' || p_brand || '"}]}]}'
        WHEN 2 THEN '{"output":[]}' WHEN 3 THEN '{"output":[{"status":"failed","content":[{"text":"x"}]}]}' ELSE '{"status":"failed","output_text":"x"}' END AS payload FROM part"""
    return payload.response_text(_part(spark, sf_dir, sql))


@query(
    """
SELECT p_partkey AS page_id, CASE WHEN p_partkey % 3 < 2 THEN '2020-06-05' ELSE '' END AS release_date, CASE WHEN p_partkey % 3 < 2 THEN 'Dolby Vision|HDR10' ELSE '' END AS hdr, CASE p_partkey % 3 WHEN 0 THEN 'English|French' WHEN 1 THEN 'English' ELSE '' END AS languages,
       p_partkey % 3 = 2 AS blocked FROM part"""
)
def product_pages(spark, sf_dir):
    sql = """SELECT p_partkey AS page_id, CASE p_partkey % 3 WHEN 2 THEN ' error' || p_size || ' ' ELSE '<b>HDR: Dolby Vision, HDR10, SDR</b><div id="longaudio" class="a">English: Dolby Atmos<br>English: Dolby TrueHD 7.1 (48kHz)<br/>'
        || CASE p_partkey % 3 WHEN 0 THEN 'French: DTS 5.1<br>' ELSE 'German: MP3<br>' END || 'Note: Dolby Atmos is ' || p_name || '</div> Release Date June 5, 2020' END AS html FROM part"""
    out = media.product_pages(_part(spark, sf_dir, sql))
    return out.select("page_id", "release_date", F.array_join("hdr", "|").alias("hdr"), F.array_join("languages", "|").alias("languages"), "blocked")


@query("SELECT p_partkey AS disc, CASE p_partkey % 4 WHEN 0 THEN 'Dolby TrueHD/Atmos 7.1|DD 5.1' WHEN 1 THEN 'DTS:X 7.1|DD+ 5.1' WHEN 2 THEN 'LPCM 2.0|Dolby Atmos' ELSE 'DTS-HD HRA 5.1' END AS formats FROM part")
def merge_tracks(spark, sf_dir):
    sql = """SELECT p_partkey AS disc, explode(CASE p_partkey % 4
        WHEN 0 THEN array(named_struct('pos', 0, 'language', 'English', 'format', 'Dolby Atmos'), named_struct('pos', 1, 'language', 'English', 'format', 'Dolby TrueHD 7.1 (48kHz, 24-bit)'), named_struct('pos', 2, 'language', 'French', 'format', 'Dolby Digital 5.1'), named_struct('pos', 3, 'language', 'German', 'format', 'Dolby Digital 5.1'))
        WHEN 1 THEN array(named_struct('pos', 0, 'language', 'English', 'format', 'DTS:X'), named_struct('pos', 1, 'language', 'English', 'format', 'DTS-HD Master Audio 7.1'), named_struct('pos', 2, 'language', 'Thai', 'format', 'Dolby Digital Plus 5.1'))
        WHEN 2 THEN array(named_struct('pos', 0, 'language', 'English', 'format', 'LPCM 2.0'), named_struct('pos', 1, 'language', 'English', 'format', 'Dolby Atmos'))
        ELSE array(named_struct('pos', 0, 'language', 'English', 'format', 'DTS-HD High-Resolution Audio 5.1')) END) AS t FROM part"""
    tracks = _part(spark, sf_dir, sql).select("disc", "t.pos", "t.language", "t.format")
    return media.merge_tracks(tracks).select("disc", F.array_join("formats", "|").alias("formats"))


@query(
    """
SELECT key, CASE WHEN event_type = 'purchase' THEN 'hit' WHEN epoch_ms(ts) > epoch_ms(TIMESTAMP '2024-01-08 00:00:00') - 7 * 86400000 THEN 'fresh-miss' ELSE 'fetch' END AS state FROM (
  SELECT user_id AS key, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00') WHERE rn = 1
UNION ALL SELECT o_custkey, 'fetch' FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00')"""
)
def cache_refresh(spark, sf_dir):
    log = read(spark, sf_dir, "events").where("ts < timestamp'2024-01-08 00:00:00'").select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("at"), F.col("ts").cast("timestamp").alias("stamp"), (F.col("event_type") == "purchase").alias("hit"), F.lit("v2").alias("version"))
    requests = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")).distinct()
    return refresh.cache_state(log, requests, now="2024-01-08 00:00:00", version="v2")
