"""Scored lookup of candidates in a reference table of works.

A pair needs 65 points, so few ways lead there, and each is a join of its own:

- with equal years, shared tokens of 0.28 of the larger title: joined on year and token;
- otherwise 0.92 of it. Up to LARGE tokens that means equal token sets: joined on
  the set; larger titles on their rarest tokens, as many as may be missing and one.

Works that score alike are reduced to one row first, and a candidate's pairs by one
ordered aggregate, not sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.session import checkpoint as settle

# Fixed values of the score.
YEAR_EQUAL, YEAR_OFF, YEAR_MISSING = 45, -45, -55
EXACT, ENGAGED_FROM, MOST_ENGAGED, ACCEPT = 20, 70, 50, 65
RESCUES = 3
#: Share of tokens without which 65 points are out of reach, but for rounding: with equal years, and otherwise.
NEAR_SHARE, FAR_SHARE = 19.5 / 70, 64.5 / 70
#: Titles of up to so many tokens reach FAR_SHARE with equal token sets alone.
LARGE = int(1 / (1 - FAR_SHARE))


def leading_year(c: Column) -> Column:
    return F.regexp_extract(c, f"^({X.YEAR})", 1)


def title_score(a: str, b: str, key_a: str, key_b: str) -> Column:
    """Seventy points for shared tokens, thirty for an equal key, halves to even."""
    overlap = X.token_overlap(F.col(a), F.col(b)) * 70
    return F.when((F.col(key_a) == "") | (F.col(key_b) == ""), F.lit(0)).otherwise(F.bround(overlap + F.when(F.col(key_a) == F.col(key_b), 30.0).otherwise(0.0)).cast("int"))


def _keyed_works(works: DataFrame) -> DataFrame:
    out = works.withColumns({"wk": X.title_key(F.col("title")), "ok": X.title_key(F.col("original_title")), "wyear": leading_year(F.col("release_date"))})
    return out.withColumns({"wt": X.tokens(F.col("wk")), "ot": X.tokens(F.col("ok"))})


def engaged(works: DataFrame) -> DataFrame:
    """Works that anyone has voted on or made a poster for."""
    return works.where((F.col("vote_count") > 0) | (F.col("poster_path") != ""))


def _asked(candidates: DataFrame, use_year: bool) -> tuple[DataFrame, DataFrame]:
    """The candidates with their keys, and each title and year once."""
    c = candidates.select("seq", X.title_key(F.col("title")).alias("qk"), (X.year_of(F.col("year")) if use_year else F.lit("")).alias("qyear")).withColumn("qt", X.tokens(F.col("qk")))
    return c, c.groupBy("qk", "qyear").agg(F.first("qt").alias("qt"))


def _rarest(sets: DataFrame, often: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t): of each large token set the rarest tokens, one more than may be missing."""
    spread = sets.where(F.size("ts") > LARGE).select(*keys, "ts", F.explode("ts").alias("t")).join(often, "t", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "t")))  # a title's tokens
    ranked = spread.groupBy(*keys).agg(order.alias("o"))
    return ranked.select(*keys, F.explode(F.slice("o", 1, F.size("o") - F.ceil(FAR_SHARE * F.size("o")).cast("int") + 1)).alias("x")).select(*keys, "x.t")


def _large(q: DataFrame, both: DataFrame) -> DataFrame:
    """(qk, qyear, wid) of pairs that share one of the rarest tokens of both."""
    often = both.select(F.explode("ts").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    return _rarest(q, often, ["qk", "qyear"]).join(_rarest(both.drop("wyear"), often, ["wid", "ts"]).drop("ts"), "t").select("qk", "qyear", "wid")


def _sides(w: DataFrame) -> DataFrame:
    return w.select("wid", "wyear", F.col("wt").alias("ts")).union(w.select("wid", "wyear", "ot")).where(F.size("ts") > 0)


def _same(q: DataFrame, both: DataFrame) -> DataFrame:
    """(qk, qyear, wid) of pairs with equal token sets."""
    name = F.array_join(F.array_sort("ts"), " ")
    return q.withColumn("s", name).join(both.select("wid", name.alias("s")), "s").select("qk", "qyear", "wid").distinct()


def _near(q: DataFrame, both: DataFrame) -> DataFrame:
    """(qk, qyear, wid) of all other pairs that may reach the bar."""
    dated = q.where("qyear != ''").select("qk", "qyear", "ts", F.explode("ts").alias("t"))
    works = both.where("wyear != ''").select("wid", F.col("wyear").alias("qyear"), F.col("ts").alias("us"), F.explode("ts").alias("t"))
    enough = F.size(F.array_intersect("ts", "us")) >= NEAR_SHARE * F.greatest(F.size("ts"), F.size("us"))
    near = dated.join(works, ["qyear", "t"]).where(enough).select("qk", "qyear", "wid")
    return near.union(_large(q, both)).distinct()


def _bonus() -> Column:
    return F.when(F.col("vote_count") > 0, F.least(F.lit(MOST_ENGAGED), F.bround(12 * F.log10(F.col("vote_count") + 1.0)).cast("int"))).otherwise(0)


def _kinds(works: DataFrame) -> DataFrame:
    """One row for all works that score alike: equal keys and year, and whether anyone voted.

    Among them a pair's base, year and exact points are one; only the bonus differs,
    and it counts either for all of them or for none. `plain` is the best work where it
    counts for none, `liked` where it counts; `bonus` is that of the liked one.
    """
    w = _keyed_works(engaged(works)).withColumns({"voted": F.coalesce(F.col("vote_count") > 0, F.lit(False)), "bonus": _bonus(), "popularity": F.coalesce(F.col("popularity"), F.lit(0.0)).cast("double")})
    one = F.struct("popularity", (-F.col("tmdb_id")).alias("first"))
    grouped = w.groupBy("wk", "ok", "wyear", "voted").agg(F.max(one).alias("plain"), F.max(F.struct("bonus", *[one[c].alias(c) for c in ("popularity", "first")])).alias("liked"), F.first("wt").alias("wt"), F.first("ot").alias("ot"))
    return grouped.withColumn("wid", F.struct("wk", "ok", "wyear", "voted"))


def _scored(hits: DataFrame, asked: DataFrame, w: DataFrame) -> DataFrame:
    """(qk, qyear, b): the best work of each title and year among the hits, as (score, popularity, first)."""
    p = hits.join(asked, ["qk", "qyear"]).join(w, "wid")
    base = F.greatest(title_score("qt", "wt", "qk", "wk"), title_score("qt", "ot", "qk", "ok"))
    gap = F.abs(F.col("wyear").try_cast("int") - F.col("qyear").try_cast("int"))
    year = (
        F.when(F.col("qyear") == "", 0)
        .when(F.col("wyear") == "", YEAR_MISSING)
        .when(F.col("wyear") == F.col("qyear"), F.when(F.col("voted"), YEAR_EQUAL).otherwise(0))
        .when(gap > 1, YEAR_OFF)
        .otherwise(0)
    )
    exact = F.when(F.col("wk") == F.col("qk"), EXACT).otherwise(0) + F.when(F.col("ok") == F.col("qk"), EXACT).otherwise(0)
    p = p.withColumn("base", base)
    liked = F.col("base") >= ENGAGED_FROM
    score = (F.col("base") + year + exact + F.when(liked, F.col("liked.bonus")).otherwise(0)).cast("int")
    best = lambda k: F.struct(score.alias("score"), F.col(f"{k}.popularity").alias("popularity"), F.col(f"{k}.first").alias("first"))
    return p.groupBy("qk", "qyear").agg(F.max(F.when(liked, best("liked")).otherwise(best("plain"))).alias("b"))


def scored_lookup(candidates: DataFrame, works: DataFrame, use_year: bool = True) -> DataFrame:
    """(seq, tmdb_id, score): the best work of each candidate that reaches the bar; the first work wins ties.

    Works that score alike are one row. Titles that an equal token set gives more
    points than any other pair can have are settled by it; only the others meet the
    works that share some of their tokens.
    """
    c, asked = _asked(candidates, use_year)
    asked = asked.where(F.size("qt") > 0)
    w = settle(_kinds(works))
    both = _sides(w)
    q = settle(asked.select("qk", "qyear", F.col("qt").alias("ts"), "qt"))
    same = settle(_scored(_same(q, both), q.select("qk", "qyear", "qt"), w))
    # Without an equal set at least one token of n + 1 is missing.
    n = F.size("ts")
    base = F.bround(F.lit(70) * n / (n + 1)) + 1
    most = base + YEAR_EQUAL + F.when(base >= ENGAGED_FROM, MOST_ENGAGED).otherwise(0)
    settled = q.join(same, ["qk", "qyear"]).where(F.col("b.score") > most).select("qk", "qyear")
    rest = settle(q.join(settled, ["qk", "qyear"], "left_anti"))
    near = _scored(_near(rest.drop("qt"), both), rest.select("qk", "qyear", "qt"), w)
    best = same.unionByName(near).groupBy("qk", "qyear").agg(F.max("b").alias("b")).where(F.col("b.score") >= ACCEPT)
    return c.join(best, ["qk", "qyear"]).select("seq", (-F.col("b.first")).alias("tmdb_id"), "b.score")


def lookup_with_fallback(candidates: DataFrame, works: DataFrame) -> DataFrame:
    """scored_lookup with the year, then without it for those not found; `attempt` says which."""
    first = scored_lookup(candidates, works)
    rest = candidates.join(first.select("seq"), "seq", "left_anti")
    return first.withColumn("attempt", F.lit(1)).unionByName(scored_lookup(rest, works, use_year=False).withColumn("attempt", F.lit(2)))


def alt_title_rescue(candidates: DataFrame, works: DataFrame, alternatives: DataFrame) -> DataFrame:
    """(seq, tmdb_id, matched_title): of a candidate's three most plausible works, the first with an equal alternative title.

    alternatives holds (tmdb_id, pos, alt_title). Plausible: shares a title token and the years are within one of each other.
    """
    c, asked = _asked(candidates, True)
    w = _keyed_works(engaged(works)).select("tmdb_id", "wyear", F.coalesce("vote_count", F.lit(0)).alias("votes"), F.explode(F.array_union("wt", "ot")).alias("t"))
    # The best three under a token and year are among the best three there, whatever else a candidate's title holds.
    order = [(F.col("wyear") == "").asc(), F.col("votes").desc(), F.col("tmdb_id").asc()]
    first = lambda df, *keys: df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= RESCUES).drop("_n")
    by_year, by_token = first(w, "t", "wyear"), first(w, "t")
    q = asked.select("qk", "qyear", F.explode("qt").alias("t"))
    year = F.col("qyear").try_cast("int")
    years = F.transform(F.array(year - 1, year, year + 1), lambda y: y.cast("string"))
    dated = q.where("qyear != ''").withColumn("wyear", F.explode(F.array_append(years, F.lit("")))).join(by_year, ["t", "wyear"])
    met = dated.unionByName(q.where("qyear = ''").join(by_token, "t")).select("qk", "qyear", "wyear", "votes", "tmdb_id").distinct()
    rank = F.row_number().over(Window.partitionBy("qk", "qyear").orderBy(*order))
    tried = met.withColumn("rank", rank).where(F.col("rank") <= RESCUES).select("qk", "qyear", "rank", "tmdb_id")
    alt = alternatives.withColumn("ak", X.title_key(F.col("alt_title")))
    hit = tried.join(alt, "tmdb_id").where((F.col("ak") == F.col("qk")) & (F.col("qk") != ""))
    best = hit.groupBy("qk", "qyear").agg(F.min_by(F.struct("tmdb_id", "alt_title"), F.struct("rank", "pos")).alias("b"))
    return c.join(best, ["qk", "qyear"]).select("seq", "b.tmdb_id", F.col("b.alt_title").alias("matched_title"))


def series_lookup(candidates: DataFrame, series: DataFrame) -> DataFrame:
    """(seq, tmdb_id, score, media_type) of candidates whose title ends in a season label, looked up among series alone.

    The label goes; only a first season's year is near the series' own, so other
    seasons are scored without one.
    """
    name = X.series_title(F.col("title"))
    first = F.coalesce(X.season_number(F.col("title")) == 1, F.lit(False))
    # Labels are read once: the lookup reads its candidates several times.
    named = settle(candidates.select("seq", name.alias("title"), F.when(first, F.col("year")).otherwise("").alias("year")))
    asked = named.where("title != ''")
    return scored_lookup(asked, series).withColumn("media_type", F.lit("tv"))


def apply_aliases(candidates: DataFrame, aliases: DataFrame) -> DataFrame:
    """(seq, attempt_no, title, year): the pinned name first, then the candidate's own, without repeats.

    Where aliases name a canonical title, `canonical_title` says it for pinned attempts.
    """
    named = "canonical_title" in aliases.columns
    keyed = candidates.withColumn("title_key", X.match_key(F.col("title")))
    joined = keyed.join(aliases, ["title_key", "year"], "left")
    none = F.lit(None).cast("string")
    own = F.struct(F.col("title").alias("title"), F.col("year").alias("year"), none.alias("canonical_title"))
    pinned = F.struct(F.col("lookup_title").alias("title"), F.col("lookup_year").alias("year"), (F.col("canonical_title") if named else none).alias("canonical_title"))
    tries = F.array_distinct(F.when(F.col("lookup_title").isNotNull(), F.array(pinned, own)).otherwise(F.array(own)))
    return joined.select("seq", F.posexplode(tries).alias("attempt_no", "t")).select("seq", "attempt_no", "t.title", "t.year", *(["t.canonical_title"] if named else []))


def product_match(wanted: DataFrame, discs: DataFrame) -> DataFrame:
    """(seq, url): the first product page, by attempt and then page order, with an equal slug key and years at most one apart.

    Of a key's pages only the first that each wanted year may take matters: a
    page stands under its own year and the ones beside it, under every year if it
    has none, and under no year for wanted rows without one. So a wanted row meets
    two pages of a key, however many there are.
    """
    w = wanted.withColumn("k", X.title_key(F.col("title"))).where("k != ''")
    d = discs.withColumn("k", X.title_key(F.replace(F.regexp_replace("url", r"^.*/([^/]+)/\d+/?$", "$1"), F.lit("-"), F.lit(" ")))).where("k != ''")
    first = F.min_by(F.struct("pos", "url"), F.struct("pos", "url")).alias("p")
    y = F.col("dyear")
    by_year = d.where("dyear is not null").groupBy("k", "dyear").agg(first)
    dated = by_year.withColumn("wyear", F.explode(F.array(y - 1, y, y + 1))).groupBy("k", "wyear").agg(F.min("p").alias("dated"))
    always = d.where("dyear is null").groupBy("k").agg(first.alias("always"))
    every = d.groupBy("k").agg(first.alias("every"))
    met = w.join(every, "k").join(always, "k", "left").join(dated, ["k", "wyear"], "left")
    page = F.when(F.col("wyear").isNull(), F.col("every")).otherwise(F.least("dated", "always"))
    return met.withColumn("p", page).where("p is not null").groupBy("seq").agg(F.min_by("p.url", F.struct("attempt_no", "p.pos")).alias("url"))
