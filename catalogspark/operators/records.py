"""Records between the catalog and what surrounds it: candidates, earlier runs, golden cases, model responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators import compare, evidence, payload
from catalogspark.operators.merge import dedupe_merge
from catalogspark.session import stored

AI_TYPE, AI_LABEL, LEGACY = "ai-extracted", "codex-ai", "legacy-ai-text"
#: A label in running text: a name that begins with a letter or digit, and a year.
NAME = r"[A-Z0-9][A-Za-z0-9:'&.,!?’ -]{1,100}?"
LABEL = rf"({NAME}\s+\({X.YEAR}\))"


def to_candidates(catalog: DataFrame) -> DataFrame:
    """Catalog rows as candidates."""
    return catalog.select("seq", F.col("movie_title").alias("title"), F.col("release_date").alias("year"), "source_url", F.col("quote").alias("evidence"), F.col("evidence_type").alias("extraction_method"))


def from_candidates(candidates: DataFrame, now: Column) -> DataFrame:
    """Candidates as catalog rows; without evidence their label stands for it."""
    year = F.when(F.coalesce("year", F.lit("")) == "", X.UNKNOWN).otherwise(F.col("year"))
    label = F.concat("title", F.lit(" ("), F.coalesce("year", F.lit("")), F.lit(")"))
    quote = F.when(F.coalesce("evidence", F.lit("")) == "", label).otherwise(F.col("evidence"))
    return candidates.select("seq", F.col("title").alias("movie_title"), year.alias("release_date"), "source_url", quote.alias("quote"), F.lit(AI_TYPE).alias("evidence_type"), F.lit(AI_LABEL).alias("source_label"), now.alias("collected_at"))


def evidence_urls(source_url: Column, more: Column) -> Column:
    """The web addresses that bear a row out, the first one first, each once."""
    every = F.concat(F.array(source_url), F.coalesce(more, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(every, lambda u: F.rlike(u, F.lit("^https?://"))))


def comparison_outputs(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, listings, summary) of two candidate tables: every row with its best match on the other side; the five label lists; counts."""
    # Keys are made once a row and stored, since each side is read from both ends.
    x, y = stored(compare.label_key(a)), stored(compare.label_key(b))

    def one(x: DataFrame, y: DataFrame, side: str) -> DataFrame:
        return compare.matched(x, y).drop("mk").withColumn("label", F.concat("title", F.lit(" ("), "year", F.lit(")"))).withColumn("side", F.lit(side))

    rows = one(x, y, "a").unionByName(one(y, x, "b"))
    line = F.concat("label", F.lit(" | match="), F.col("match_percent").cast("string"), F.lit("% | source="), "source_url")
    lists = F.array(
        F.concat("side", F.lit("_found")),
        F.when(F.col("match_percent") != 100, F.concat("side", F.lit("_only"))).when(F.col("side") == "a", F.lit("overlap")),
    )
    listings = rows.select(F.explode(F.array_compact(lists)).alias("listing"), "side", "seq", line.alias("line"))
    return rows, listings, compare.labels_compared(x, y)


def write_comparison(a: DataFrame, b: DataFrame, folder: str) -> None:
    """The rows as CSV by side, the listings as text by name, the summary as JSON."""
    rows, listings, summary = comparison_outputs(a, b)
    rows.select("side", "title", "year", "label", "match_percent", "source_url", "extraction_method", "evidence").write.partitionBy("side").option("header", True).csv(f"{folder}/found")
    listings.select("listing", "line").write.partitionBy("listing").text(f"{folder}/listings")
    summary.write.json(f"{folder}/summary")


CANDIDATES = "seq long, title string, year string, source_url string, evidence string, extraction_method string"


def write_candidates(candidates: DataFrame, path: str) -> None:
    """Candidates as CSV with a header; quotes are doubled, so commas, quotes and line ends inside fields survive."""
    columns = [c.split()[0] for c in CANDIDATES.split(", ")]
    candidates.select(*columns).write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a CSV with a header, as `write_candidates` and other tools write it; columns are found by the header's names, missing ones are empty."""
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("emptyValue", "").csv(path)
    have = {c.strip().lower(): c for c in raw.columns}
    return raw.select(*[(F.col(f"`{have[n]}`") if n in have else F.lit(None)).cast(kind).alias(n) for n, kind in (c.split() for c in CANDIDATES.split(", "))]).na.fill("", ["title", "source_url", "evidence", "extraction_method"])


def compare_runs(left_path: str, right_path: str, spark: SparkSession, folder: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two candidate CSVs compared in one call: rows with best matches, listings, summary; written to `folder` if one is given."""
    a, b = read_candidates(spark, left_path), read_candidates(spark, right_path)
    if folder is not None:
        write_comparison(a, b, folder)
    return comparison_outputs(a, b)


def label_index(pages: DataFrame) -> DataFrame:
    """(mk, year, source_url, evidence): the first page, by page_id and place, that names a title with its year."""
    found = pages.select("page_id", F.col("url").alias("source_url"), F.posexplode(F.regexp_extract_all("text", F.lit(LABEL), F.lit(1))).alias("pos", "label"))
    name = F.regexp_replace(F.regexp_extract("label", r"(?s)^(.*?)\s+\(", 1), r"\s+", " ")
    named = found.withColumn("title", F.trim(name, F.lit(" ,-"))).withColumn("year", F.regexp_extract("label", r"\((\d{4})\)$", 1)).where("title != ''")
    keyed = named.withColumn("mk", X.match_key(F.col("title")))
    evidence_text = F.concat("title", F.lit(" ("), "year", F.lit(")"))
    return keyed.groupBy("mk", "year").agg(F.min_by(F.struct("source_url", evidence_text.alias("evidence")), F.struct("page_id", "pos")).alias("r")).select("mk", "year", "r.source_url", "r.evidence")


def attach_legacy_sources(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates of earlier listings (seq, line) `Title (YYYY) | ..`, joined with the first page that names them; the first of each title and year."""
    label = F.trim(F.substring_index("line", " | ", 1))
    form = r"^(.+?)\s+\((\d{4}|Unknown)\)$"
    read = lines.select("seq", label.alias("label")).where(F.rlike("label", F.lit(form)))
    read = read.select("seq", F.trim(F.regexp_extract("label", form, 1)).alias("title"), F.regexp_extract("label", form, 2).alias("year")).withColumn("mk", X.match_key(F.col("title")))
    once = read.groupBy("mk", "year").agg(F.min("seq").alias("seq"), F.min_by("title", "seq").alias("title"))
    own = F.concat("title", F.lit(" ("), "year", F.lit(")"))
    out = once.join(label_index(pages), ["mk", "year"], "left")
    return out.select("seq", "title", "year", F.coalesce("source_url", F.lit("unknown")).alias("source_url"), F.coalesce("evidence", own).alias("evidence"), F.lit(LEGACY).alias("extraction_method"))


def evaluate_golden(cases: DataFrame, extracted: DataFrame) -> DataFrame:
    """(name, expected, found, passed) of golden cases (name, expected) against extracted (name, pos, title); the order of titles counts."""
    found = extracted.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda x: x["title"]).alias("found"))  # one case's titles
    out = cases.join(found, "name", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    return out.select("name", "expected", "found", (F.col("expected") == F.col("found")).alias("passed"))


def extract_batch(responses: DataFrame, pages: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(catalog rows, rejection counts) of model responses (resp_id, source_url, payload) over their pages (url, text).

    A malformed response fails the batch. Candidates that their page does not bear
    out are counted by reason; the rest is one row a title and year.
    """
    found, valid = payload.candidates(responses)
    if not valid.where("not valid").isEmpty():
        raise ValueError("a response is not a list of candidates")
    # Stored, since both results read it.
    grounded = stored(evidence.ground(found.withColumn("seq", F.col("resp_id") * payload.MAX_CANDIDATES + F.col("pos")).drop("resp_id", "pos"), pages))
    good = grounded.where("reason is null and title != '' and evidence != ''").drop("reason")
    rows = from_candidates(good, now)
    keyed = rows.withColumns({"title_key": X.title_key(F.col("movie_title")), "_year": X.year_of(F.col("release_date"))})
    return dedupe_merge(keyed, ["title_key", "_year"]).drop("title_key", "_year"), evidence.rejection_counts(grounded)
