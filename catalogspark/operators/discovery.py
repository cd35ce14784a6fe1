"""Finding sources: which links and search results look like pages that list evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import urls as U

# What speaks for and against a source.
WANTED = ("blu-ray", "uhd", "dolby vision", "profile 7", "fel", "remux")
BLOCKED = (
    "1337x", "download", "hardware", "hdmi", "magnet", "mega.nz", "nzb", "player", "rapidgator", "splitter", "player support", "playback", "plex", "torrent",
    "tv-led", "usenet", "warez", "yts",
)
SOURCE_HOSTS = ("blu-ray.com", "caps-a-holic.com", "criterionforum.org", "discourse.coreelec.org", "forum", "github.com", "google.com", "list", "makemkv.com", "reddit.com", "wiki")
SOURCE_PATHS = ("/forum", "/thread", "/list", "/wiki")
BLOCKED_HOSTS = ("simkl.com", "trakt.tv")
CLAIM, FORMAT, MEDIA = ("profile 7", "fel"), ("dolby vision",), ("blu ray", "uhd", "remux")


def holds(c: Column, words: tuple[str, ...], every: bool = False) -> Column:
    out = F.lit(every)
    for w in words:
        out = out & F.contains(c, F.lit(w)) if every else out | F.contains(c, F.lit(w))
    return out


def is_source(url: Column, about: Column, wanted: tuple = (CLAIM, FORMAT, MEDIA)) -> Column:
    """A host or path shaped like a source, words of the claim or of format and medium, and nothing that is blocked."""
    host, path = F.lower(U.part(url, 2)), F.lower(U.part(url, 3))
    said = F.lower(F.replace(F.concat_ws(" ", U.part(url, 2), U.part(url, 3), U.part(url, 4), about), F.lit("-"), F.lit(" ")))
    ends = F.lit(False)
    for h in BLOCKED_HOSTS:
        ends = ends | F.endswith(host, F.lit(h))
    claim, form, media = wanted
    return ~ends & ~holds(said, BLOCKED) & (holds(host, SOURCE_HOSTS) | holds(path, SOURCE_PATHS)) & (holds(said, claim, True) | (holds(said, form) & holds(said, media)))


def classify_sources(results: DataFrame, wanted: tuple = (CLAIM, FORMAT, MEDIA)) -> DataFrame:
    """(seq, url, candidate) of search results (seq, url, title, description): each link once, and whether it may be a source."""
    keyed = results.withColumn("url", U.search_url(F.col("url"))).where("url is not null")
    about = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    first = keyed.withColumn("about", about).groupBy("url").agg(F.min("seq").alias("seq"), F.min_by("about", "seq").alias("about"))
    return first.select("seq", "url", is_source(F.col("url"), F.col("about"), wanted).alias("candidate"))
