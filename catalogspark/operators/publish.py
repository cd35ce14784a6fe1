"""Views, reports and metrics of a catalog on its way out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.operators.merge import canonical

# Extras that are never shown.
PRIVATE = ("group", "release_group")


def public_extras(extras: Column) -> Column:
    """The extras map without private keys, however they are spelled."""
    return F.map_filter(extras, lambda k, _: ~F.translate(F.lower(k), "- ", "__").isin(*PRIVATE))


def text_filter(rows: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows whose columns, joined, hold the query in any case."""
    return rows.where(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(query.strip().lower())))


def run_metrics(rows: DataFrame) -> DataFrame:
    """One row of counters."""
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    keyed = canonical(rows)
    return keyed.agg(F.count(F.lit(1)).alias("releases"), n(F.col("tmdb_id") != "").alias("resolved"), n(F.col("tmdb_id") == "").alias("unresolved"), n(F.col("year") == "").alias("yearless"), F.count_distinct(F.nullif("url_key", F.lit(""))).alias("pages"))


def ingest_report(inputs: DataFrame, final: DataFrame) -> DataFrame:
    """What became of each input: the final row of its title and year, if any."""
    left = canonical(inputs).select("seq", F.col("movie_title").alias("input_title"), F.col("year").alias("input_year"), "title_key", "year")
    right = canonical(final).select("title_key", "year", "tmdb_id")
    out = left.join(right, ["title_key", "year"], "left")
    work = F.coalesce("tmdb_id", F.lit(""))
    return out.select("seq", "input_title", "input_year", (work != "").alias("tmdb_resolved"), work.alias("tmdb_id"))


def table_cell(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def delta_lines(additions: DataFrame) -> DataFrame:
    """(seq, line): a table row for each addition."""
    link = F.concat(F.lit("[source]("), F.replace("source_url", F.lit(")"), F.lit("%29")), F.lit(")"))
    cells = [table_cell(F.col("movie_title")), table_cell(F.col("release_date")), link, table_cell(F.col("evidence_type"))]
    return additions.select("seq", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def review_report(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """(seq, reason, candidate, implicated) of the candidates a person must look at."""
    shown = candidates.select(F.col("seq").alias("cand"), F.col("movie_title").alias("candidate"))
    return decisions.where("action = 'review'").join(shown, "cand").select(F.col("cand").alias("seq"), "reason", "candidate", "implicated")


def enforce_labels(rows: DataFrame) -> DataFrame:
    """Rows with model-made evidence always carry its label."""
    return rows.withColumn("source_label", F.when(F.col("evidence_type") == "ai-extracted", F.lit("codex-ai")).otherwise(F.coalesce(X.known(F.col("source_label")), F.lit(X.UNKNOWN))))


def review_with_counts(decisions: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, header) of a review: the header counts items and reasons, also where there are none."""
    items = review_report(decisions, candidates)
    header = items.agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("reason").alias("n_reasons"))
    return items, header


class NotPublishable(ValueError):
    """The written version did not pass its audit; the version before it stays current."""


def observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """rows, and counters that fill while something else reads them once: no second scan. `run_metrics` adds the distinct pages, which take a shuffle."""
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    seen = Observation()
    keyed = canonical(rows)
    return keyed.observe(seen, F.count(F.lit(1)).alias("releases"), n(F.col("tmdb_id") != "").alias("resolved"), n(F.col("tmdb_id") == "").alias("unresolved"), n(F.col("year") == "").alias("yearless")), seen


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, data folder) of all committed versions in order; one small file each."""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{folder}/versions")
    fs = log.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(log):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(log)]
    return sorted((int(number), data) for number, _, data in (n.partition("-") for n in names if "-" in n and not n.startswith(".")))


def _commit(spark: SparkSession, folder: str, number: int, data: str) -> None:
    """Make a written version current: one empty file, which can be created only once."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/{number}-{data}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if any(n == number for n, _ in versions(spark, folder)):
        raise NotPublishable(f"version {number} was published by someone else")
    fs.create(path, False).close()


def current(spark: SparkSession, folder: str, what: str = "catalog") -> DataFrame | None:
    """The current version's catalog, review or counts; None if nothing has been published."""
    have = versions(spark, folder)
    return spark.read.parquet(f"{folder}/data/{have[-1][1]}/{what}") if have else None


def audit(catalog: DataFrame, counts: dict[str, int]) -> list[str]:
    """What speaks against a written catalog: several rows of one title, year and id; rows lost; labels missing."""
    from catalogspark.operators.merge import duplicate_identity

    against = [f"several rows are one release: {r.first_title}" for r in duplicate_identity(catalog).limit(3).collect()]
    found = catalog.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("evidence_type") == "ai-extracted") & (F.col("source_label") != "codex-ai")).alias("unlabelled")).first()
    if found["n"] != counts["releases"]:
        against.append(f"{counts['releases']} rows were written, {found['n']} are there")
    if found["unlabelled"]:
        against.append(f"{found['unlabelled']} model-made rows lack their label")
    return against


def publish(catalog: DataFrame, review: DataFrame, folder: str) -> int:
    """Write a new version of a catalog and its review, audit what was written, and make it current; returns its number.

    The data goes to a folder of its own; the catalog's counters are taken while it
    is written. Only an audit without fault lets the version's file appear in
    `versions`, so a reader sees the old version or the new one whole. A failed
    audit, a lost driver or a rival's commit leaves the old version current.
    """
    spark = catalog.sparkSession
    have = versions(spark, folder)
    number, data = (have[-1][0] + 1 if have else 1), uuid.uuid4().hex
    rows, seen = observed(enforce_labels(catalog if "source_label" in catalog.columns else catalog.withColumn("source_label", F.lit(None).cast("string"))))
    rows.write.parquet(f"{folder}/data/{data}/catalog")
    counts = seen.get
    review.write.parquet(f"{folder}/data/{data}/review")
    against = audit(spark.read.parquet(f"{folder}/data/{data}/catalog"), counts)
    if against:
        raise NotPublishable("; ".join(against))
    additions = F.count_if("is_addition") if "is_addition" in catalog.columns else F.lit(0)
    head = spark.read.parquet(f"{folder}/data/{data}/catalog").agg(F.count(F.lit(1)).alias("n_rows"), additions.cast("long").alias("n_additions"))
    items = spark.read.parquet(f"{folder}/data/{data}/review").agg(F.count(F.lit(1)).alias("n_review"))
    head.crossJoin(items).withColumn("version", F.lit(number)).write.parquet(f"{folder}/data/{data}/counts")  # one row each
    _commit(spark, folder, number, data)
    return number


def publish_batch(incoming: DataFrame, folder: str) -> int:
    """The whole way of a batch into the published catalog: stale rows out, titles cleaned, reconciled with the current version, exact repeats of title and page collapsed, published."""
    from catalogspark.operators import merge, reconcile

    clean = lambda df: merge.drop_stale(df).withColumn("movie_title", X.clean_title(F.col("movie_title")))
    known = current(incoming.sparkSession, folder)
    new = clean(incoming.select(*reconcile.COLUMNS))
    old = clean(known.select(*reconcile.COLUMNS)) if known is not None else new.limit(0)
    catalog, decisions = reconcile.reconcile(old, new)
    once = merge.dedupe_title_url(catalog.drop("sources", "url_key", "year", "title_key"))
    return publish(once, review_report(decisions, old.unionByName(new)), folder)
