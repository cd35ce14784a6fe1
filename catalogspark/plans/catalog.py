"""Queries of deduplication, matching, lookup and comparison over the adapter views."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import compare, lookup, match, merge
from catalogspark.plans.adapters import read, view
from catalogspark.plans.registry import query
from catalogspark.plans.scalars import KEY_SQL


def _rel(spark, sf_dir, which=""):
    rows = view(spark, sf_dir, "v_rel")
    return rows.where({"old": "seq % 3 <> 0", "new": "seq % 3 = 0", "": "true"}[which])


_URL_SQL = "CASE WHEN bluray_url = '' THEN '' ELSE 'https://' || lower(regexp_extract(bluray_url, '^[A-Za-z]+://([^/]+)', 1)) || rtrim(regexp_extract(bluray_url, '^[A-Za-z]+://[^/]+([^?]*)', 1), '/') END"
KEYED = f"k AS (SELECT *, {KEY_SQL.format('movie_title')} AS title_key, regexp_extract(release_date, '(19|20)[0-9][0-9]') AS year, {_URL_SQL} AS url_key FROM v_rel)"
_WEAK = "CASE WHEN evidence_type LIKE '%-list' THEN 1 ELSE 0 END, CASE WHEN evidence_type = 'ai-extracted' THEN 1 ELSE 0 END, seq"
SURVIVE = f"""min(seq) AS seq,
  first(movie_title ORDER BY length(movie_title) - length(replace(movie_title, '.', '')), -length(movie_title), seq) AS movie_title,
  first(evidence_type ORDER BY {_WEAK}) AS evidence_type, first(quote ORDER BY {_WEAK}) AS quote,
  first(release_date ORDER BY CASE WHEN length(release_date) = 10 THEN 0 ELSE 1 END, CASE WHEN release_date IN ('', 'Unknown') THEN 1 ELSE 0 END, seq) AS release_date,
  first(studio ORDER BY CASE WHEN studio IN ('', 'Unknown') THEN 1 ELSE 0 END, seq) AS studio,
  first(imdb_id ORDER BY CASE WHEN imdb_id = '' THEN 1 ELSE 0 END, seq) AS imdb_id, first(bluray_url ORDER BY CASE WHEN bluray_url = '' THEN 1 ELSE 0 END, seq) AS bluray_url,
  first(tmdb_id ORDER BY CASE WHEN tmdb_id = '' THEN 1 ELSE 0 END, seq) AS tmdb_id, first(media_type ORDER BY CASE WHEN tmdb_id = '' THEN 1 ELSE 0 END, seq) AS media_type"""
_WITH = "WITH v AS (SELECT * FROM v_rel)"


def _sql(body: str) -> str:
    """A query over k, the keyed release rows; the views it needs come in front."""
    return f"SELECT * FROM (WITH {KEYED} {body})"


@query(_sql(f"SELECT title_key, year, {SURVIVE} FROM k GROUP BY title_key, year"))
def dedupe_merge(spark, sf_dir):
    return merge.dedupe_merge(merge.canonical(_rel(spark, sf_dir)).drop("url_key"), ["title_key", "year"])


@query(_sql(f"SELECT title_key, {SURVIVE} FROM k GROUP BY title_key, CASE WHEN url_key <> '' THEN 'u:' || url_key ELSE 'y:' || year END"))
def dedupe_title_url(spark, sf_dir):
    return merge.dedupe_title_url(_rel(spark, sf_dir))


@query("SELECT seq, movie_title FROM v_rel WHERE seq % 4 <> 1")
def drop_stale(spark, sf_dir):
    rows = _rel(spark, sf_dir).select("seq", "movie_title", F.expr("CASE WHEN seq % 4 = 0 THEN 'table-row' ELSE 'google-sheet-row' END").alias("evidence_type"))
    stale = F.when(F.col("seq") % 4 == 1, F.when(F.col("seq") % 8 == 1, F.concat(F.trim("movie_title"), F.lit(" Box Set"))).otherwise(F.concat(F.trim("movie_title"), F.lit(".1999")))).otherwise(F.col("movie_title"))
    return merge.drop_stale(rows.withColumn("movie_title", stale)).select("seq", "movie_title")


@query("SELECT min(doc_id) AS seq, md5(text) AS text_md5 FROM documents GROUP BY text")
def dedupe_first(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.md5("text").alias("text_md5"))
    return merge.dedupe_first(docs, ["text_md5"])


@query(
    _sql(
        """SELECT title_key, year, CASE WHEN tmdb_id <> '' THEN media_type || '/' || tmdb_id ELSE '' END AS identity, count(*) AS n, first(movie_title ORDER BY seq) AS first_title
FROM k GROUP BY 1, 2, 3 HAVING count(*) > 1"""
    )
)
def duplicate_identity(spark, sf_dir):
    return merge.duplicate_identity(_rel(spark, sf_dir))


_PADDED = "CASE WHEN length(release_date) = 4 THEN release_date || '-00-00' ELSE release_date END"


@query(f"SELECT seq, row_number() OVER (ORDER BY CASE WHEN release_date = 'Unknown' THEN 1 ELSE 0 END, {_PADDED} DESC, seq) AS rank FROM v_rel")
def sort_newest(spark, sf_dir):
    rows = _rel(spark, sf_dir).withColumn("padded", X.pad_date(F.col("release_date")))
    # Years before the sort: the unknown come last, later years first.
    by = F.when(F.col("release_date") == X.UNKNOWN, F.lit(1)).otherwise(-F.substring("padded", 1, 4).try_cast("int"))
    return merge.with_rank(rows, [F.col("padded").desc(), F.col("seq")], by).select("seq", "rank")


@query("SELECT seq, row_number() OVER (ORDER BY lower(studio), rpad(CASE WHEN release_date = 'Unknown' THEN '' ELSE release_date END, 10, '~') DESC, seq) AS rank FROM v_rel")
def sort_view(spark, sf_dir):
    rows = _rel(spark, sf_dir).withColumn("shown", F.rpad(F.when(F.col("release_date") == X.UNKNOWN, "").otherwise(F.col("release_date")), 10, "~"))
    return merge.with_rank(rows, [F.col("shown").desc(), F.col("seq")], F.lower("studio")).select("seq", "rank")


@query("SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 3")
def top_k_per_group(spark, sf_dir):
    # Each task keeps three rows a group before the shuffle, so a hot group moves three rows a task.
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    from pyspark.sql import Window

    return events.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("value").desc(), "event_id"))).where("rank <= 3").select("user_id", "event_id", "rank")


@query(
    _sql(
        """SELECT title_key, year, CASE WHEN max(CASE WHEN seq % 2 = 0 THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN seq % 2 = 1 THEN 1 ELSE 0 END) = 1 THEN 'both' WHEN max(CASE WHEN seq % 2 = 0 THEN 1 ELSE 0 END) = 1 THEN 'left' ELSE 'right' END AS side
FROM k GROUP BY title_key, year"""
    )
)
def key_set_ops(spark, sf_dir):
    keys = merge.canonical(_rel(spark, sf_dir)).select("seq", "title_key", "year")
    left, right = keys.where("seq % 2 = 0").drop("seq"), keys.where("seq % 2 = 1").drop("seq")
    tag = lambda df, name: df.withColumn("side", F.lit(name))
    return tag(left.intersect(right), "both").unionByName(tag(left.subtract(right), "left")).unionByName(tag(right.subtract(left), "right"))


@query("SELECT seq, 'note=' || studio AS extras FROM v_rel")
def public_view(spark, sf_dir):
    from catalogspark.operators.publish import public_extras

    rows = _rel(spark, sf_dir).select("seq", F.create_map(F.lit("Release-Group"), F.lit("x"), F.lit("note"), F.col("studio"), F.lit("group"), F.lit("y")).alias("extras"))
    return rows.select("seq", F.array_join(F.transform(F.map_entries(public_extras(F.col("extras"))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("extras"))


_SIGNALS = """
SELECT cand, row, bit_or(bit) AS mask FROM (
  SELECT a.seq AS cand, b.seq AS row, 1 AS bit FROM k a JOIN k b ON a.url_key = b.url_key AND a.url_key <> '' AND a.seq % 3 = 0 AND b.seq % 3 <> 0
  UNION ALL SELECT a.seq, b.seq, 2 FROM k a JOIN k b ON a.tmdb_id = b.tmdb_id AND a.media_type = b.media_type AND a.tmdb_id <> '' AND a.seq % 3 = 0 AND b.seq % 3 <> 0
  UNION ALL SELECT a.seq, b.seq, 4 FROM k a JOIN k b ON a.imdb_id = b.imdb_id AND a.imdb_id <> '' AND a.seq % 3 = 0 AND b.seq % 3 <> 0) GROUP BY cand, row"""


@query(_sql(_SIGNALS))
def signal_matches(spark, sf_dir):
    return match.signal_matches(_rel(spark, sf_dir, "new"), _rel(spark, sf_dir, "old"))


@query(_sql("SELECT a.seq AS cand, b.seq AS row FROM k a JOIN k b USING (title_key, year) WHERE a.seq % 3 = 0 AND b.seq % 3 <> 0 AND title_key <> '' AND year <> ''"))
def title_year_matches(spark, sf_dir):
    return match.title_year_matches(_rel(spark, sf_dir, "new"), _rel(spark, sf_dir, "old"))


@query(_sql("SELECT a.seq AS cand, b.seq AS row, count(*) OVER (PARTITION BY a.seq) AS n FROM k a JOIN k b USING (title_key) WHERE a.seq % 3 = 0 AND b.seq % 3 <> 0 AND title_key <> '' AND a.year = '' AND b.year <> ''"))
def yearless_matches(spark, sf_dir):
    return match.yearless_matches(_rel(spark, sf_dir, "new"), _rel(spark, sf_dir, "old"))


# The same decisions, phrased as one list of pairs with flags for each candidate and CASE rules over counts of flags.
_DECIDE = f"""
, s AS (SELECT cand, row, mask FROM ({_SIGNALS})),
pairs AS (SELECT cand, row, bit_or(mask) AS mask FROM (SELECT * FROM s
   UNION ALL SELECT a.seq, b.seq, 8 FROM k a JOIN k b USING (title_key, year) WHERE a.seq % 3 = 0 AND b.seq % 3 <> 0 AND title_key <> '' AND year <> ''
   UNION ALL SELECT a.seq, b.seq, 16 FROM k a JOIN k b USING (title_key) WHERE a.seq % 3 = 0 AND b.seq % 3 <> 0 AND title_key <> '' AND a.year = '' AND b.year <> '') GROUP BY cand, row),
f AS (SELECT p.cand, p.row, p.mask, c.year <> '' AS dated, r.movie_title AS title,
   (c.tmdb_id = '' OR r.tmdb_id = '' OR c.tmdb_id = r.tmdb_id) AND (c.imdb_id = '' OR r.imdb_id = '' OR c.imdb_id = r.imdb_id) AND NOT (c.tmdb_id <> '' AND c.tmdb_id = r.tmdb_id AND c.media_type <> r.media_type) AS ok,
   c.title_key = r.title_key AND c.year = r.year AS same_key,
   c.url_key <> '' AND r.url_key <> '' AND c.url_key <> r.url_key AND NOT (c.title_key = r.title_key AND c.year = r.year AND ((c.tmdb_id <> '' AND c.tmdb_id = r.tmdb_id AND c.media_type = r.media_type) OR (c.imdb_id <> '' AND c.imdb_id = r.imdb_id)
     OR (c.tmdb_id = '' AND c.imdb_id = '' AND r.tmdb_id = '' AND r.imdb_id = ''))) AS apart
   FROM pairs p JOIN k c ON c.seq = p.cand JOIN k r ON r.seq = p.row),
m AS (SELECT cand, max(mask & 1) + max(mask & 2) + max(mask & 4) AS present, max(CASE WHEN mask & 1 > 0 THEN 1 ELSE 0 END) + max(CASE WHEN mask & 2 > 0 THEN 1 ELSE 0 END) + max(CASE WHEN mask & 4 > 0 THEN 1 ELSE 0 END) AS sets,
   max(CASE WHEN mask & 3 = 3 THEN 1 ELSE 0 END) + max(CASE WHEN mask & 5 = 5 THEN 1 ELSE 0 END) + max(CASE WHEN mask & 6 = 6 THEN 1 ELSE 0 END) AS links FROM f GROUP BY cand),
g AS (SELECT f.*, sets, links, present, bool_or(present > 0 AND mask & 7 = present) OVER (PARTITION BY f.cand) AS any_common FROM f JOIN m USING (cand)),
h AS (SELECT *, CASE WHEN any_common THEN mask & 7 = present ELSE mask & 7 > 0 END AS tgt FROM g),
z AS (SELECT cand, any_value(dated) AS dated, any_value(sets) AS sets, any_value(links) AS links,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (mask & 7 > 0) AS sig,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (mask & 1 > 0) AS url,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (tgt) AS tg,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (tgt AND ok) AS live,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (tgt AND ok AND same_key) AS narrow,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (mask & 8 > 0) AS ti,
   list({{'row': row, 'ok': ok, 'apart': apart, 'same': same_key, 't': title}} ORDER BY row) FILTER (mask & 16 > 0) AS ba FROM h GROUP BY cand),
y AS (SELECT cand, dated, CASE
   WHEN sets > 0 THEN CASE WHEN links < sets - 1 THEN 'sig' WHEN len(url) = 1 THEN '=url' WHEN coalesce(len(live), 0) = 0 THEN 'tg' WHEN len(live) = 1 THEN '=live' WHEN dated AND coalesce(len(narrow), 0) = 1 THEN '=narrow' ELSE 'live?' END
   WHEN dated THEN CASE WHEN coalesce(len(list_filter(ti, lambda x: NOT x.ok)), 0) > 0 THEN 'ti' WHEN len(ti) = 1 THEN '=ti' ELSE 'ti?' END
   ELSE CASE WHEN len(ba) = 1 THEN '=ba' ELSE 'ba?' END END AS rule,
   sig, url, tg, live, narrow, ti, ba FROM z),
w AS (SELECT *, CASE rule WHEN 'sig' THEN sig WHEN 'tg' THEN tg WHEN '=url' THEN url WHEN '=live' THEN live WHEN '=narrow' THEN narrow WHEN 'live?' THEN live WHEN 'ti' THEN ti WHEN '=ti' THEN ti WHEN 'ti?' THEN ti ELSE ba END AS l FROM y),
d AS (SELECT cand, CASE WHEN rule IN ('sig', 'tg', 'ti', 'live?', 'ti?', 'ba?') THEN 'review' WHEN NOT l[1].ok THEN 'review' WHEN l[1].apart AND dated THEN 'append' WHEN l[1].apart THEN 'review' ELSE 'merge' END AS action,
   CASE WHEN rule IN ('sig', 'tg', 'ti') THEN 'identity-conflict' WHEN rule IN ('live?', 'ti?') THEN 'ambiguous-edition' WHEN rule = 'ba?' THEN 'ambiguous-yearless-title' WHEN NOT l[1].ok THEN 'identity-conflict' WHEN l[1].apart AND NOT dated THEN 'ambiguous-edition' END AS reason, l FROM w)
SELECT c.seq AS cand, coalesce(d.action, CASE WHEN c.year <> '' THEN 'append' ELSE 'review' END) AS action, CASE WHEN d.action = 'merge' THEN d.l[1].row END AS target,
   CASE WHEN d.cand IS NULL AND c.year = '' THEN 'missing-year-no-match' ELSE d.reason END AS reason,
   CASE WHEN d.action = 'review' THEN array_to_string(list_transform(d.l, lambda x: x.t), '; ') ELSE '' END AS implicated
FROM k c LEFT JOIN d ON d.cand = c.seq WHERE c.seq % 3 = 0"""


@query(_sql(_DECIDE.replace("{{", "{").replace("}}", "}")))
def match_decision(spark, sf_dir):
    return match.match_decision(_rel(spark, sf_dir, "new"), _rel(spark, sf_dir, "old"))


def _asked(spark, sf_dir):
    return _rel(spark, sf_dir).select("seq", F.col("movie_title").alias("title"), F.substring("release_date", 1, 4).alias("year"))


_TOKENS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"
_SCORES = """
q AS (SELECT DISTINCT title_key AS qk, {year} AS qyear FROM k),
w AS (SELECT tmdb_id, vote_count, popularity, {title} AS wk, {original} AS ok, regexp_extract(release_date, '^(19|20)[0-9][0-9]') AS wyear FROM v_works WHERE vote_count > 0 OR poster_path <> ''),
p AS (SELECT *, {qt} AS qt, {wt} AS wt, {ot} AS ot FROM q, w),
b AS (SELECT *, greatest(CAST(round_even(len(list_intersect(qt, wt)) / greatest(len(qt), len(wt)) * 70 + CASE WHEN qk = wk THEN 30 ELSE 0 END, 0) AS INT),
   CAST(round_even(len(list_intersect(qt, ot)) / greatest(len(qt), len(ot)) * 70 + CASE WHEN qk = ok THEN 30 ELSE 0 END, 0) AS INT)) AS base FROM p),
sc AS (SELECT *, base + CASE WHEN qyear = '' THEN 0 WHEN wyear = '' THEN -55 WHEN wyear = qyear THEN CASE WHEN vote_count > 0 THEN 45 ELSE 0 END WHEN abs(CAST(wyear AS INT) - CAST(qyear AS INT)) > 1 THEN -45 ELSE 0 END
   + CASE WHEN wk = qk THEN 20 ELSE 0 END + CASE WHEN ok = qk THEN 20 ELSE 0 END + CASE WHEN base >= 70 AND vote_count > 0 THEN least(50, CAST(round_even(12 * log10(vote_count + 1), 0) AS INT)) ELSE 0 END AS score FROM b),
best{n} AS (SELECT qk, qyear, first(tmdb_id ORDER BY score DESC, popularity DESC, tmdb_id) AS tmdb_id, max(score) AS score FROM sc GROUP BY qk, qyear HAVING max(score) >= 65)"""


def _scores(year: str, n: str = "") -> str:
    return _SCORES.format(year=year, title=KEY_SQL.format("title"), original=KEY_SQL.format("original_title"), qt=_TOKENS.format("qk"), wt=_TOKENS.format("wk"), ot=_TOKENS.format("ok"), n=n)


_LOOKUP = f"SELECT * FROM (WITH {KEYED}, {_scores('year')} SELECT seq, best.tmdb_id, best.score FROM k JOIN best ON k.title_key = best.qk AND k.year = best.qyear)"
_YEARLESS = f"SELECT * FROM (WITH {KEYED}, {_scores(chr(39) * 2)} SELECT seq, best.tmdb_id, best.score FROM k JOIN best ON k.title_key = best.qk)"


@query(_LOOKUP + " /* v_rel v_works */")
def scored_lookup(spark, sf_dir):
    return lookup.scored_lookup(_asked(spark, sf_dir), view(spark, sf_dir, "v_works"))


@query(f"SELECT *, 1 AS attempt FROM ({_LOOKUP}) UNION ALL SELECT *, 2 FROM ({_YEARLESS}) z WHERE seq NOT IN (SELECT seq FROM ({_LOOKUP})) /* v_rel v_works */")
def lookup_fallback(spark, sf_dir):
    return lookup.lookup_with_fallback(_asked(spark, sf_dir), view(spark, sf_dir, "v_works"))


@query(
    f"""SELECT * FROM (WITH {KEYED}, {_scores('year')},
e AS (SELECT qk, qyear, tmdb_id, row_number() OVER (PARTITION BY qk, qyear ORDER BY CASE WHEN wyear = '' THEN 1 ELSE 0 END, vote_count DESC, tmdb_id) AS rank FROM sc
  WHERE (len(list_intersect(qt, wt)) > 0 OR len(list_intersect(qt, ot)) > 0) AND (qyear = '' OR wyear = '' OR abs(try_cast(wyear AS INT) - try_cast(qyear AS INT)) <= 1)),
h AS (SELECT qk, qyear, first(tmdb_id ORDER BY rank) AS tmdb_id FROM e JOIN part ON p_partkey = tmdb_id AND p_name = qk WHERE rank <= 3 GROUP BY qk, qyear)
SELECT seq, h.tmdb_id, upper(qk) AS matched_title FROM k JOIN h ON k.title_key = h.qk AND k.year = h.qyear) /* v_rel v_works */"""
)
def alt_title_rescue(spark, sf_dir):
    alternatives = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("tmdb_id"), F.lit(0).alias("pos"), F.upper("p_name").alias("alt_title"))
    return lookup.alt_title_rescue(_asked(spark, sf_dir), view(spark, sf_dir, "v_works"), alternatives)


@query(
    """
SELECT p_partkey AS seq, 0 AS attempt_no, CASE WHEN p_size % 5 = 0 THEN upper(p_name) ELSE p_name END AS title, CASE WHEN p_size % 5 = 0 THEN '2001' ELSE CAST(1970 + p_size AS STRING) END AS year FROM part
UNION ALL SELECT p_partkey, 1, p_name, CAST(1970 + p_size AS STRING) FROM part WHERE p_size % 5 = 0"""
)
def apply_aliases(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    aliases = part.where("p_size % 5 = 0").selectExpr("p_name AS title_key", "CAST(1970 + p_size AS STRING) AS year", "upper(p_name) AS lookup_title", "'2001' AS lookup_year").distinct()
    return lookup.apply_aliases(part.selectExpr("p_partkey AS seq", "p_name AS title", "CAST(1970 + p_size AS STRING) AS year"), aliases)


@query(
    """
SELECT a.p_partkey AS seq, first('https://www.disc.example/movies/' || replace(b.p_name, ' ', '-') || '-4K/' || CAST(b.p_partkey AS STRING) || '/' ORDER BY b.p_partkey) AS url
FROM part a JOIN part b ON a.p_name = b.p_name AND abs(a.p_size - b.p_size) <= 1 WHERE b.p_partkey % 3 = 0 GROUP BY a.p_partkey"""
)
def product_match(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    wanted = part.selectExpr("p_partkey AS seq", "explode(array(named_struct('attempt_no', 0, 'title', p_name), named_struct('attempt_no', 1, 'title', p_name || ' 4K'))) AS t", "p_size AS wyear").select("seq", "t.attempt_no", "t.title", "wyear")
    discs = part.where("p_partkey % 3 = 0").selectExpr("p_partkey AS pos", "'https://www.disc.example/movies/' || replace(p_name, ' ', '-') || '-4K/' || p_partkey || '/' AS url", "p_size AS dyear")
    return lookup.product_match(wanted, discs)


@query(
    f"""
SELECT * FROM (WITH c AS (SELECT *, {KEY_SQL.format('title').replace("'[''`’]', ''", "'[''`’]', ' '")} AS mk FROM v_cand), x AS (SELECT *, mk || ' (' || year || ')' AS label FROM c),
t AS (SELECT DISTINCT mk FROM x WHERE seq % 3 = 0), u AS (SELECT DISTINCT mk AS rk FROM x WHERE seq % 3 <> 0),
s AS (SELECT mk, max(CAST(round_even(100 * len(list_intersect(list_distinct(string_split(mk, ' ')), list_distinct(string_split(rk, ' ')))) / greatest(len(list_distinct(string_split(mk, ' '))), len(list_distinct(string_split(rk, ' ')))), 0) AS INT)) AS fuzzy FROM t, u GROUP BY mk)
SELECT seq, CASE WHEN label IN (SELECT label FROM x WHERE seq % 3 <> 0) THEN 100 ELSE fuzzy END AS match_percent FROM x JOIN s USING (mk) WHERE seq % 3 = 0)"""
)
def best_match(spark, sf_dir):
    c = view(spark, sf_dir, "v_cand")
    return compare.best_match(c.where("seq % 3 = 0"), c.where("seq % 3 <> 0"))


@query(
    f"""
SELECT * FROM (WITH x AS (SELECT seq, {KEY_SQL.format('title')} || ' (' || year || ')' AS label FROM v_cand), a AS (SELECT DISTINCT label FROM x WHERE seq % 3 = 0), b AS (SELECT DISTINCT label FROM x WHERE seq % 3 <> 0)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM a JOIN b USING (label)) AS n_both, (SELECT count(*) FROM a WHERE label NOT IN (SELECT label FROM b)) AS only_a, (SELECT count(*) FROM b WHERE label NOT IN (SELECT label FROM a)) AS only_b)"""
)
def set_compare(spark, sf_dir):
    c = view(spark, sf_dir, "v_cand")
    return compare.set_compare(c.where("seq % 3 = 0"), c.where("seq % 3 <> 0"))


@query(
    """
SELECT imdb_id, action, CASE WHEN action = 'unchanged' THEN NULL ELSE CAST(floor((row_number() OVER (PARTITION BY action ORDER BY imdb_id) - 1) / 500) AS INT) END AS batch FROM (
  SELECT coalesce(d.id, c.id) AS imdb_id, CASE WHEN c.id IS NULL THEN 'add' WHEN d.id IS NULL THEN 'remove' ELSE 'unchanged' END AS action
  FROM (SELECT DISTINCT 'tt' || CAST(o_orderkey AS STRING) AS id FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 3 <> 0) d FULL JOIN (SELECT DISTINCT 'tt' || CAST(o_orderkey AS STRING) AS id FROM orders WHERE o_orderkey % 2 = 0) c ON d.id = c.id)"""
)
def sync_diff(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    rows = orders.selectExpr("CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE 'tt' END || o_orderkey AS imdb_id", "CASE WHEN o_orderkey % 3 = 0 THEN 'tv' ELSE 'movie' END AS media_type")
    return compare.sync_diff(rows, orders.where("o_orderkey % 2 = 0").selectExpr("'tt' || o_orderkey AS imdb_id"))


@query("SELECT DISTINCT 'p' || CAST(l_partkey AS STRING) || '.jpg' AS name FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0)")
def unreferenced(spark, sf_dir):
    files = read(spark, sf_dir, "lineitem").selectExpr("'posters/p' || l_partkey || '.jpg' AS name")
    return compare.unreferenced(files, read(spark, sf_dir, "part").where("p_partkey % 2 = 0").selectExpr("'/img/p' || p_partkey || '.jpg' AS poster_path"))


@query(
    """
SELECT min(seq) AS seq, first(url ORDER BY seq) AS url FROM (SELECT page_id AS seq, regexp_replace(url, '#.*$', '') AS url, regexp_replace(url, '(#.*|/+)$', '') AS k FROM pages WHERE page_id % 2 = 0) f
WHERE NOT EXISTS (SELECT 1 FROM pages o WHERE o.page_id % 2 = 1 AND regexp_replace(o.url, '(#.*|/+)$', '') = f.k) GROUP BY k ORDER BY 1 LIMIT 25"""
)
def new_sources(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return compare.new_sources(pages.where("page_id % 2 = 0").select(F.col("page_id").alias("seq"), "url"), pages.where("page_id % 2 = 1").select("url"))


@query(
    """
SELECT src, seq, url, source_key FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY src, seq) AS rn FROM (
  SELECT CASE WHEN page_id % 2 = 0 THEN 0 ELSE 1 END AS src, page_id AS seq, url, regexp_replace(regexp_replace(url, '#.*$', ''), '/+$', '') AS source_key FROM pages)) WHERE rn = 1"""
)
def merge_registry(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), "url")
    return compare.merge_registry(pages.where("seq % 2 = 0"), pages.unionByName(pages.where("seq % 4 = 1")).where("seq % 2 = 1"))


@query("SELECT seq FROM v_rel WHERE contains(lower(movie_title || ' ' || release_date || ' ' || studio), 'brand#1')")
def text_filter(spark, sf_dir):
    from catalogspark.operators.publish import text_filter as filtered

    return filtered(_rel(spark, sf_dir), "Brand#1", ["movie_title", "release_date", "studio"]).select("seq")


@query(_sql("SELECT count(*) AS releases, count(*) FILTER (tmdb_id <> '') AS resolved, count(*) FILTER (tmdb_id = '') AS unresolved, count(*) FILTER (year = '') AS yearless, count(DISTINCT CASE WHEN url_key <> '' THEN url_key END) AS pages FROM k"))
def run_metrics(spark, sf_dir):
    from catalogspark.operators.publish import run_metrics as metrics

    return metrics(_rel(spark, sf_dir))


@query(
    _sql(
        """SELECT a.seq, a.movie_title AS input_title, a.year AS input_year, coalesce(b.tmdb_id, '') <> '' AS tmdb_resolved, coalesce(b.tmdb_id, '') AS tmdb_id
FROM k a LEFT JOIN (SELECT title_key, year, first(tmdb_id ORDER BY CASE WHEN tmdb_id = '' THEN 1 ELSE 0 END, seq) AS tmdb_id FROM k WHERE seq % 3 <> 0 GROUP BY title_key, year) b ON a.title_key = b.title_key AND a.year = b.year WHERE a.seq % 3 = 0"""
    )
)
def ingest_report(spark, sf_dir):
    from catalogspark.operators.publish import ingest_report as report

    final = merge.dedupe_merge(merge.canonical(_rel(spark, sf_dir, "old")).drop("url_key"), ["title_key", "year"])
    return report(_rel(spark, sf_dir, "new"), final)


@query("SELECT seq, '| ' || replace(movie_title, '|', chr(92) || '|') || ' | ' || release_date || ' | [source](' || replace(bluray_url, ')', '%29') || ') | ' || evidence_type || ' |' AS line FROM (SELECT *  REPLACE (movie_title || '|x' AS movie_title) FROM v_rel) WHERE seq % 3 = 0")
def delta_report(spark, sf_dir):
    from catalogspark.operators.publish import delta_lines

    return delta_lines(_rel(spark, sf_dir, "new").withColumn("movie_title", F.concat("movie_title", F.lit("|x"))).withColumn("source_url", F.col("bluray_url")))
