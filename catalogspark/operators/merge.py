"""Deduplication with survivorship: which value of a group of rows survives, field by field.

Every rule is an ordered aggregate over an explicit input order `seq`, so a group
is folded on the map side first and no group is gathered, but for list fields
whose union is the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.functions import urls as U
from catalogspark.session import checkpoint as settle

FULL_DATE = r"^\d{4}-\d{2}-\d{2}$"
LISTS = ("audio_formats", "hdr_formats", "audio_languages", "source_urls")
FIRST_KNOWN = ("studio", "english_audio", "source_label", "collected_at")
FIRST_FILLED = ("imdb_id", "poster_path", "release_url", "bluray_url", "tmdb_title", "tmdb_original_title")
DATES = ("release_date", "bluray_release_date")
BOX_SET_ROW = r"(?i)\b(?:collection|trilogy|duology|quadrilogy|tetralogy|saga|box\s*set|boxset)$|\.(?:19|20)\d{2}\.?$"


def _missing(c: str) -> Column:
    return X.known(F.col(c)).isNull()


def _least(value, *order, seq: str = "seq") -> Column:
    return F.min_by(value, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(seq).alias("last")))


def survivors(columns: list[str], seq: str = "seq", keep_base_title: bool = False) -> list[Column]:
    """One aggregate for each of the catalog columns present."""
    out = [F.min(seq).alias(seq)]
    if "movie_title" in columns:
        title = F.col("movie_title")
        dots = F.length(title) - F.length(F.replace(title, F.lit("."), F.lit("")))
        order = () if keep_base_title else (dots, -F.length(title))
        out.append(_least(title, *order, seq=seq).alias("movie_title"))
    if "evidence_type" in columns:
        weak, ai = F.endswith("evidence_type", F.lit("-list")), F.col("evidence_type") == "ai-extracted"
        won = [c for c in ("evidence_type", "quote", "source_url") if c in columns]
        out += [_least(F.col(c), weak, ai, seq=seq).alias(c) for c in won]
        if "source_label" in columns:
            out.append(F.coalesce(X.known(_least(F.col("source_label"), weak, ai, seq=seq)), _least(F.col("source_label"), _missing("source_label"), seq=seq)).alias("source_label"))
    for c in DATES:
        if c in columns:
            out.append(_least(F.col(c), ~F.rlike(F.col(c), F.lit(FULL_DATE)), _missing(c), seq=seq).alias(c))
    for c in FIRST_KNOWN:
        if c in columns and c != "source_label":
            out.append(_least(F.col(c), _missing(c), seq=seq).alias(c))
    for c in FIRST_FILLED:
        if c in columns:
            out.append(_least(F.col(c), F.coalesce(c, F.lit("")) == "", seq=seq).alias(c))
    if "tmdb_id" in columns:
        # The namespace travels with the id that survives.
        out += [_least(F.col(c), F.col("tmdb_id") == "", seq=seq).alias(c) for c in ("tmdb_id", "media_type") if c in columns]
    for c in LISTS:
        if c in columns:
            ordered = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(c).alias("v"))))
            out.append(F.array_distinct(F.flatten(F.transform(ordered, lambda x: x["v"]))).alias(c))
    if "fel_confirmed" in columns:
        out.append(F.bool_or("fel_confirmed").alias("fel_confirmed"))
    if "is_addition" in columns:
        out.append(F.every("is_addition").alias("is_addition"))
    return out


def canonical(rows: DataFrame) -> DataFrame:
    """rows with their title_key, year and url_key; rows that have them are left as they are."""
    if "title_key" in rows.columns and "year" in rows.columns:
        return rows
    out = rows.withColumns({"title_key": X.title_key(F.col("movie_title")), "year": X.year_of(F.col("release_date"))})
    return out.withColumn("url_key", U.url_key(F.col("bluray_url"))) if "bluray_url" in rows.columns else out


def dedupe_merge(rows: DataFrame, keys: list[str], keep_base_title: bool = False) -> DataFrame:
    """One surviving row a key, with the first row's seq."""
    return rows.groupBy(*keys).agg(*survivors(rows.columns, keep_base_title=keep_base_title))


def dedupe_first(rows: DataFrame, keys: list, seq: str = "seq") -> DataFrame:
    """The first row of each key. The order is explicit, unlike dropDuplicates."""
    names = [c for c in rows.columns if c != seq]
    keyed = rows.withColumns({f"_k{i}": k if isinstance(k, Column) else F.col(k) for i, k in enumerate(keys)})
    first = keyed.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min_by(F.struct(*names), seq).alias("_r"), F.min(seq).alias(seq))
    return first.select(seq, *[F.col(f"_r.{c}").alias(c) for c in names])


def dedupe_title_url(rows: DataFrame) -> DataFrame:
    """Equal title and disc page are one row; rows without a page go by title and year."""
    keyed = canonical(rows).withColumn("by", F.when(F.col("url_key") != "", F.concat(F.lit("u:"), "url_key")).otherwise(F.concat(F.lit("y:"), "year")))
    return dedupe_merge(keyed.drop("year", "url_key"), ["title_key", "by"]).drop("by")


def drop_stale(rows: DataFrame) -> DataFrame:
    """Without sheet rows whose title names a box set or ends in a dotted year."""
    return rows.where(~((F.col("evidence_type") == "google-sheet-row") & F.rlike("movie_title", F.lit(BOX_SET_ROW))))


def duplicate_identity(rows: DataFrame) -> DataFrame:
    """Title, year and namespaced id that several rows share, with the first title: empty for a catalog fit to publish."""
    identity = F.when(F.col("tmdb_id") != "", F.concat_ws("/", "media_type", "tmdb_id")).otherwise(F.lit(""))
    keyed = canonical(rows).withColumn("identity", identity)
    return keyed.groupBy("title_key", "year", "identity").agg(F.count(F.lit(1)).alias("n"), F.min_by("movie_title", "seq").alias("first_title")).where("n > 1")


def sort_newest(rows: DataFrame) -> DataFrame:
    """Newest first: unknown dates last, a bare year after the full dates of it, input order on ties."""
    return rows.orderBy((F.col("release_date") == X.UNKNOWN).asc(), X.pad_date(F.col("release_date")).desc(), "seq")


def with_rank(rows: DataFrame, order: list[Column], by: Column, name: str = "rank") -> DataFrame:
    """Rank under a total order whose first part is `by`.

    Rows are dealt by ranges of the whole order, so a frequent value of `by` is
    split as well; a rank is the place in its range plus the counts of the ranges
    before, one number a range.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(rows.repartitionByRange(n, by.asc(), *order).sortWithinPartitions(by.asc(), *order))
    placed = ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a range
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_shift"))
    return placed.join(F.broadcast(shifts), "_part").withColumn(name, F.col("_at") + F.col("_shift") + 1).drop("_part", "_at", "_shift")
