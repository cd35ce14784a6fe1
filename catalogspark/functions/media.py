"""Column functions on disc specifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X

# Names of formats, as product pages print them.
HDR = ("Dolby Vision", "HDR10+", "HDR10", "HLG")
SHORT = {"Dolby Digital Plus": "DD+", "Dolby Digital": "DD", "DTS-HD Master Audio": "DTS-HD MA", "DTS-HD High-Resolution Audio": "DTS-HD HRA"}
CODECS = ("Dolby Atmos", "Dolby TrueHD", "Dolby Digital Plus", "Dolby Digital", "DTS:X", "DTS-HD Master Audio", "DTS-HD High-Resolution Audio", "DTS", "LPCM", "PCM")
NO_LANGUAGE = ("note", "notes", "comment", "comments", "subtitle", "subtitles", "music")


def hdr_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t.isin(*HDR)))


def abbreviate(c: Column) -> Column:
    """A format without its parenthetical notes, long names shortened."""
    c = F.trim(F.regexp_replace(c, r"\s*\([^)]*\)", ""))
    out = c
    for long_name, short in SHORT.items():
        out = F.when(F.startswith(c, F.lit(long_name + " ")) | (c == long_name), F.concat(F.lit(short), F.substr(c, F.lit(len(long_name) + 1)))).otherwise(out) if long_name != "Dolby Digital" else F.when(F.startswith(c, F.lit(long_name)) & ~F.startswith(c, F.lit("Dolby Digital Plus")), F.concat(F.lit(short), F.substr(c, F.lit(len(long_name) + 1)))).otherwise(out)
    return out


def merge_tracks(tracks: DataFrame) -> DataFrame:
    """(disc, formats) of (disc, pos, language, format): object formats fold into their language's core track, in order."""
    t = tracks.withColumn("f", abbreviate(F.col("format")))
    by = t.groupBy("disc", "language").agg(
        F.min("pos").alias("at"),
        F.bool_or(F.col("f") == "Dolby Atmos").alias("atmos"),
        F.bool_or(F.col("f") == "DTS:X").alias("dtsx"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "f"))), lambda s: s["f"]).alias("fs"),  # tracks of one language of one disc
    )
    after = lambda c, head: F.substr(c, F.lit(len(head) + 1))
    core = F.transform(
        F.filter("fs", lambda f: ~f.isin("Dolby Atmos", "DTS:X")),
        lambda f: F.when(F.col("atmos") & F.startswith(f, F.lit("Dolby TrueHD ")), F.concat(F.lit("Dolby TrueHD/Atmos "), after(f, "Dolby TrueHD ")))
        .when(F.col("atmos") & F.startswith(f, F.lit("DD+ ")), F.concat(F.lit("DD+/Atmos "), after(f, "DD+ ")))
        .when(F.col("dtsx") & F.startswith(f, F.lit("DTS-HD MA ")), F.concat(F.lit("DTS:X "), after(f, "DTS-HD MA ")))
        .otherwise(f),
    )
    by = by.withColumn("core", core)
    none = F.array().cast("array<string>")
    extra = F.concat(
        F.when(F.col("atmos") & ~F.exists("core", lambda f: F.contains(f, F.lit("Atmos"))), F.array(F.lit("Dolby Atmos"))).otherwise(none),
        F.when(F.col("dtsx") & ~F.exists("core", lambda f: F.startswith(f, F.lit("DTS:X"))), F.array(F.lit("DTS:X"))).otherwise(none),
    )
    by = by.withColumn("out", F.concat("core", extra))
    ordered = F.array_sort(F.collect_list(F.struct("at", "out")))
    return by.groupBy("disc").agg(F.array_distinct(F.flatten(F.transform(ordered, lambda s: s["out"]))).alias("formats"))


def product_pages(pages: DataFrame) -> DataFrame:
    """(page_id, release_date, hdr, languages, blocked): a product page's facts; a page that only says errorNN is blocked, not empty."""
    html = F.col("html")
    block = F.regexp_extract(html, r'(?s)<div id="longaudio"[^>]*>(.*?)</div>', 1)
    lines = F.transform(F.split(block, r"(?i)<br\s*/?>"), lambda x: X.collapse_ws(X.unescape(F.regexp_replace(x, "<[^>]+>", ""))))
    pairs = F.transform(F.filter(lines, lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("language"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("format")))
    codec = "^(?:" + "|".join(c.replace("+", r"\+") for c in CODECS) + ")"
    real = F.filter(pairs, lambda p: F.rlike(p["format"], F.lit(codec)) & ~F.lower(p["language"]).isin(*NO_LANGUAGE))
    return pages.select(
        "page_id",
        X.long_date(F.regexp_extract(html, r"Release Date ([A-Z][a-z]+ \d{1,2}, \d{4})", 1)).alias("release_date"),
        hdr_tokens(F.regexp_extract(html, r"HDR:\s*([^<]+)", 1)).alias("hdr"),
        F.array_distinct(F.transform(real, lambda p: p["language"])).alias("languages"),
        real.alias("tracks"),
        F.rlike(F.trim(html), F.lit(r"(?i)^error\d+$")).alias("blocked"),
    )
