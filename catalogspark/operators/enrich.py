"""Enriching catalog rows from the reference tables of works, series and discs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import lookup
from catalogspark.session import checkpoint as settle

# Where works have their pages.
PAGES = {"movie": "https://www.themoviedb.org/movie/", "tv": "https://www.themoviedb.org/tv/", "other": "https://www.imdb.com/title/"}
FIRST = "Dolby Vision"
#: Names that one quote gives, at most as many attempts as a quote has AKAs.
STEP = 1000


def work_page(tmdb_id: Column, imdb_id: Column, media_type: Column) -> Column:
    own = F.concat(F.when(media_type == "tv", PAGES["tv"]).otherwise(F.lit(PAGES["movie"])), tmdb_id)
    return F.when(tmdb_id != "", own).when(imdb_id != "", F.concat(F.lit(PAGES["other"]), imdb_id, F.lit("/"))).otherwise("")


def attempts(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """(seq, no, title, year, canonical_title): the names to look a row up by, in order. Names without a year are not tried."""
    year = X.year_of(F.col("release_date"))
    own = rows.select("seq", F.lit(0).alias("src"), F.col("movie_title").alias("title"), year.alias("year"))
    other = rows.select("seq", F.posexplode(X.aka_titles(F.col("quote"))).alias("src", "title"), year.alias("year")).withColumn("src", F.col("src") + 1)
    named = own.unionByName(other).where("year != ''").withColumn("row", F.col("seq")).withColumn("seq", F.struct("row", "src"))
    tried = lookup.apply_aliases(named.drop("row", "src"), aliases).where("year != ''")
    return tried.select("seq.row", (F.col("seq.src") * STEP + F.col("attempt_no")).cast("long").alias("no"), "title", "year", *[c for c in tried.columns if c == "canonical_title"]).withColumnRenamed("row", "seq")


def resolve(asked: DataFrame, works: DataFrame, alternatives: DataFrame, series: DataFrame) -> DataFrame:
    """(seq, tmdb_id, media_type, alternative) of (seq, title, year): series by their season label, others by score, with the year and without, and by alternative titles."""
    label = X.series_title(F.col("title")) != ""
    films = settle(asked.where(~label))
    scored = settle(lookup.lookup_with_fallback(films, works).select("seq", "tmdb_id"))
    rescued = lookup.alt_title_rescue(films.join(scored.select("seq"), "seq", "left_anti"), works, alternatives)
    out = scored.select("seq", "tmdb_id", F.lit("movie").alias("media_type"), F.lit(False).alias("alternative"))
    out = out.unionByName(rescued.select("seq", "tmdb_id", F.lit("movie").alias("media_type"), F.lit(True).alias("alternative")))
    return out.unionByName(lookup.series_lookup(asked.where(label), series).select("seq", "tmdb_id", "media_type", F.lit(False).alias("alternative")))


def _adopted(title: Column, tried: Column, work: Column, original: Column) -> Column:
    """The row's title after the work is known.

    An alias that renamed the row gives its canonical title; an alternative title
    and a spelling that is neither of the work's give way to the work's title,
    but where the row names an edition.
    """
    edition = X.has_edition(title)
    row, own = X.title_key(title), X.title_key(work)
    third = (own != "") & ~edition & (row != own) & ((row == "") | (row != X.title_key(original)))
    name = F.coalesce(F.col("canonical_title"), tried)
    return F.when(name != title, F.coalesce(F.col("canonical_title"), work)).when(F.col("alternative") & ~edition, work).when(third, work).otherwise(title)


def enrich(rows: DataFrame, works: DataFrame, alternatives: DataFrame, series: DataFrame, discs: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows (seq, movie_title, release_date, studio, quote, fel_confirmed, ..) with ids, page, recorded titles and disc facts.

    works and series: tmdb_id, title, original_title, release_date, vote_count,
    popularity, poster_path, imdb_id, studio. discs: pos, url, year,
    bluray_release_date, hdr_formats, audio_formats, audio_languages.
    """
    tries = settle(attempts(rows, aliases).withColumn("aid", F.concat_ws("#", "seq", "no")))
    if "canonical_title" not in tries.columns:
        tries = tries.withColumn("canonical_title", F.lit(None).cast("string"))
    hits = resolve(tries.select(F.col("aid").alias("seq"), "title", "year"), works, alternatives, series).withColumnRenamed("seq", "aid")
    first = tries.join(hits, "aid").groupBy("seq").agg(F.min_by(F.struct("title", "year", "canonical_title", "tmdb_id", "media_type", "alternative"), "no").alias("h")).select("seq", "h.*")
    facts = lambda df, kind: df.select("tmdb_id", F.lit(kind).alias("media_type"), F.col("title").alias("w_title"), F.col("original_title").alias("w_original"), F.col("release_date").alias("w_date"), F.col("imdb_id").alias("w_imdb"), F.col("studio").alias("w_studio"), F.col("poster_path").alias("w_poster"))
    known = first.join(facts(works, "movie").unionByName(facts(series, "tv")), ["tmdb_id", "media_type"])
    known = known.withColumnsRenamed({"title": "tried", "year": "tried_year", "tmdb_id": "w_id", "media_type": "w_media"})
    base = [c for c in rows.columns if c not in ("tmdb_id", "media_type", "imdb_id", "release_url", "tmdb_title", "tmdb_original_title", "poster_path")]
    have = lambda c, default: F.coalesce(F.col(c), F.lit(default)) if c in rows.columns else F.lit(default)
    r = rows.join(known, "seq", "left")
    found = F.col("w_id").isNotNull()
    pair = found & (F.coalesce("w_original", F.lit("")) != "") & (X.title_key(F.col("w_title")) != X.title_key(F.col("w_original")))
    r = r.withColumns(
        {
            "movie_title": F.when(found, _adopted(F.col("movie_title"), F.col("tried"), F.col("w_title"), F.coalesce("w_original", F.lit("")))).otherwise(F.col("movie_title")),
            "n_id": F.when(found, F.col("w_id").cast("string")).otherwise(have("tmdb_id", "")),
            "n_media": F.when(found, F.col("w_media")).otherwise(have("media_type", "movie")),
            "n_imdb": F.when(found, F.coalesce("w_imdb", F.lit(""))).otherwise(have("imdb_id", "")),
            "n_title": F.when(pair, F.col("w_title")),
            "n_original": F.when(pair, F.col("w_original")),
            "n_poster": F.when(found & (F.coalesce("w_poster", F.lit("")) != ""), F.col("w_poster")).otherwise(have("poster_path", "")),
            "studio": F.when(found & X.known(F.col("studio")).isNull() & (F.coalesce("w_studio", F.lit("")) != ""), F.col("w_studio")).otherwise(F.col("studio")),
            "release_date": F.when(found & ~F.contains("release_date", F.lit("-")) & (F.coalesce("w_date", F.lit("")) != "") & (X.year_of(F.col("w_date")) == F.col("tried_year")), F.col("w_date")).otherwise(F.col("release_date")),
        }
    )
    r = r.withColumn("n_url", work_page(F.col("n_id"), F.col("n_imdb"), F.col("n_media")))
    r = settle(r.select(*base, F.col("n_id").alias("tmdb_id"), F.col("n_media").alias("media_type"), F.col("n_imdb").alias("imdb_id"), F.col("n_url").alias("release_url"), F.col("n_title").alias("tmdb_title"), F.col("n_original").alias("tmdb_original_title"), F.col("n_poster").alias("poster_path")))
    wanted = attempts(r, aliases).select("seq", F.col("no").alias("attempt_no"), "title", F.col("year").cast("int").alias("wyear"))
    met = lookup.product_match(wanted, discs.select("pos", "url", F.col("year").alias("dyear")))
    disc = met.join(discs.select("url", "bluray_release_date", "hdr_formats", "audio_formats", "audio_languages"), "url").withColumnRenamed("url", "d_url").withColumnsRenamed({c: f"d_{c}" for c in ("bluray_release_date", "hdr_formats", "audio_formats", "audio_languages")})
    out = r.join(disc, "seq", "left")
    on = F.col("d_url").isNotNull()
    hdr = F.when(F.col("fel_confirmed") & ~F.exists("d_hdr_formats", lambda h: F.lower(h) == FIRST.lower()), F.concat(F.array(F.lit(FIRST)), "d_hdr_formats")).otherwise(F.col("d_hdr_formats"))
    empty = F.array().cast("array<string>")
    old = lambda c, default: F.col(c) if c in r.columns else default
    out = out.withColumns(
        {
            "bluray_url": F.when(on, F.col("d_url")).otherwise(old("bluray_url", F.lit(""))),
            "bluray_release_date": F.when(on, F.col("d_bluray_release_date")).otherwise(old("bluray_release_date", F.lit(""))),
            "hdr_formats": F.when(on, hdr).otherwise(old("hdr_formats", empty)),
            "audio_formats": F.when(on, F.col("d_audio_formats")).otherwise(old("audio_formats", empty)),
            "audio_languages": F.when(on, F.col("d_audio_languages")).otherwise(old("audio_languages", empty)),
            "english_audio": F.when(on & F.array_contains("d_audio_languages", "English"), F.lit("Yes")).otherwise(old("english_audio", F.lit(X.UNKNOWN))),
        }
    )
    return out.drop(*[c for c in out.columns if c.startswith("d_")])
