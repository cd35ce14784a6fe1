"""Rows of one work: whether a group of rows names one work at all, and how such a group becomes one row.

A work is known by its namespaced id. Groups are folded in stages, each an
aggregation that is combined on the map side: by disc page, by title and year,
and as a whole. Only the choice of a target for rows without a disc page is
sequential; it is made over the distinct titles and years of one work.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.functions import urls as U
from catalogspark.operators.components import connected
from catalogspark.operators.merge import survivors
from catalogspark.session import release, stored

#: Ends of the stretch that an AKA joins.
LOCAL = r"[.;:!?\n|]"
RECORDED = ("tmdb_title", "tmdb_original_title")


def identity() -> Column:
    return F.when(F.col("tmdb_id") != "", F.concat_ws("/", F.coalesce(X.known(F.col("media_type")), F.lit("movie")), F.col("tmdb_id")))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_id": identity(), "_key": X.title_key(F.col("movie_title")), "_year": X.year_of(F.col("release_date")), "_url": U.url_key(F.col("bluray_url"))})


def _aka_edges(rows: DataFrame) -> DataFrame:
    """(_id, a, b): title keys that some quote of the work joins by AKA, a list number before and a year after them set aside."""
    parts = F.split("quote", r"(?i)\baka\b")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.struct(F.get(parts, i - 1).alias("l"), F.get(parts, i).alias("r")))
    said = rows.where(F.rlike("quote", F.lit(r"(?i)\baka\b"))).select("_id", F.explode(pairs).alias("p")).where("p.r is not null")
    left = X.title_key(F.element_at(F.split("p.l", LOCAL), -1))
    right = X.title_key(F.element_at(F.split("p.r", LOCAL), 1))
    keyed = said.select("_id", left.alias("l"), right.alias("r"))
    forms = keyed.select("_id", F.explode(F.array_distinct(F.array("l", F.regexp_replace("l", r"^\d+\s+", "")))).alias("a"), "r")
    forms = forms.select("_id", "a", F.explode(F.array_distinct(F.array("r", F.regexp_replace("r", r"\s+(?:19|20)\d{2}$", "")))).alias("b"))
    return forms.where("a != '' and b != ''")


def _recorded_edges(rows: DataFrame) -> DataFrame:
    """(_id, a, b): the title and the original title that a lookup recorded for a row."""
    if not set(RECORDED) <= set(rows.columns):
        return rows.sparkSession.createDataFrame([], "_id string, a string, b string")
    both = rows.where("tmdb_title != '' and tmdb_original_title != ''")  # before any key is made
    return both.select("_id", X.title_key(F.col("tmdb_title")).alias("a"), X.title_key(F.col("tmdb_original_title")).alias("b")).where("a != '' and b != '' and a != b")


def alias_groups(rows: DataFrame) -> DataFrame:
    """(identity, n_rows, n_titles, one_work): whether the rows of a work id are shown to name one work.

    They are if they share one year and one outside id, none names an edition, and
    their titles are connected: by spelling, by an AKA in a quote of the group, or
    by a recorded pair of titles.
    """
    return _alias_groups(stored(_keyed(rows).where("_id is not null").select("_id", "_key", "_year", "movie_title", "imdb_id", "quote", *[c for c in RECORDED if c in rows.columns])))


def _alias_groups(keyed: DataFrame) -> DataFrame:
    """The same of stored rows that have an id and their keys. Rows are read for their titles and for what joins those; all else is read from titles and edges, which are stored."""
    # Titles hold all that their work's row needs.
    titles = stored(
        keyed.groupBy("_id", "_key").agg(
            F.count(F.lit(1)).alias("n"), F.min("_year").alias("y0"), F.max("_year").alias("y1"), F.min("imdb_id").alias("i0"), F.max("imdb_id").alias("i1"),
            F.bool_or(X.has_edition(F.col("movie_title"))).alias("edition"),
        )
    )
    heads = titles.groupBy("_id").agg(
        F.sum("n").alias("n_rows"), F.count("_key").alias("n_titles"), F.count(F.lit(1)).alias("nodes"),
        F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("i0").alias("i0"), F.max("i1").alias("i1"), F.bool_or("edition").alias("edition"),
    )
    fit = F.coalesce(F.expr("n_rows > 1 and y0 = y1 and y0 != '' and i0 = i1 and i0 != '' and not edition"), F.lit(False))
    heads = stored(heads.select("_id", "n_rows", "n_titles", "nodes", fit.alias("fit")))
    result = lambda df, one_work: df.select(F.col("_id").alias("identity"), "n_rows", "n_titles", one_work.alias("one_work"))
    some = titles.join(heads.where("fit and n_titles > 1").select("_id"), "_id", "left_semi")
    some = stored(some.select("_id", "_key", X.respelled(F.col("_key")).alias("spelt")))
    if some.isEmpty():
        return result(heads, F.col("fit"))
    left, right = some.select("_id", F.col("_key").alias("a"), F.col("spelt").alias("sa")), some.select("_id", F.col("_key").alias("b"), F.col("spelt").alias("sb"))
    spelled = left.join(right, "_id").where("a < b").where(X.spelled_alike(F.col("sa"), F.col("sb"))).select("_id", "a", "b")
    said = _aka_edges(keyed).unionByName(_recorded_edges(keyed))
    said = said.join(left.drop("sa"), ["_id", "a"], "left_semi").join(right.drop("sb"), ["_id", "b"], "left_semi").select("_id", "a", "b")
    edges = stored(spelled.unionByName(said).where("a != b").select("_id", F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct())
    # A title is known by its work and key; each edge is a key that both its ends share. A title without any edge stands alone.
    ends = edges.select(F.explode(F.array(F.struct("_id", F.col("x").alias("k")), F.struct("_id", F.col("y").alias("k")))).alias("id"), F.struct("_id", "x", "y").alias("key"))
    labels = connected(ends).select(F.col("id._id").alias("_id"), "label")
    joined = labels.groupBy("_id").agg(F.count(F.lit(1)).alias("met"), F.count_distinct("label").alias("labels"))
    together = (F.col("n_titles") <= 1) | F.coalesce((F.col("labels") == 1) & (F.col("met") == F.col("nodes")), F.lit(False))
    return result(heads.join(joined, "_id", "left"), F.col("fit") & together)


def _targets(rows: list[dict]) -> Iterator[tuple]:
    """(title, year, at) of each (title, year) of a work's rows without a disc page: the only row with its title and year, else with its title, else with its year, else the only row."""
    ordered = sorted(rows, key=lambda r: r["at"])
    found = [r for r in ordered if r["paged"]]
    for row in (r for r in ordered if not r["paged"]):
        title, year = row["title"], row["year"]
        tests = [lambda c: c["title"] == title and c["year"] == year, lambda c: c["title"] == title]
        if year:
            tests.append(lambda c: c["year"] == year)
        tests.append(lambda c: True)
        hits = next((h for t in tests if len(h := [c for c in found if t(c)]) == 1), None)
        if hits is None:
            found.append(row)
            yield title, year, row["at"]
            continue
        target = hits[0]
        yield title, year, target["at"]
        if row["at"] < target["at"]:  # the earlier row gives the title
            target["title"] = title
        if not target["year"] or row["full"] and not target["full"]:
            target["year"], target["full"] = year or target["year"], row["full"]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _key, _year, _at) of works (_id, facts), many in a batch."""
    for batch in batches:
        out = [(work["_id"], *t) for work in batch.to_pylist() for t in _targets(work["facts"])]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else ([],) * 4, (pa.string(), pa.string(), pa.string(), pa.int64()), strict=True)], ["_id", "_key", "_year", "_at"])


def _fold(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row a key, title of the first; `_sources` holds the seq of all that went in."""
    sources = F.array_sort(F.flatten(F.collect_list("_sources"))).alias("_sources")
    return _keyed(rows.groupBy(*keys).agg(*survivors(columns, keep_base_title=True), sources)).withColumn("_id", identity())


def dedupe_by_work(rows: DataFrame, safe: bool = False) -> DataFrame:
    """One row a work and disc, with `sources`, the seq of the rows in it; rows without a work id stay as they are.

    Rows with one disc page are one; then those with one title and year; the rest
    is one row if no title names an edition. Rows without a page go to the target
    that `_targets` names. With `safe`, only groups that alias_groups proves are
    folded at all.
    """
    columns = rows.columns
    # Stored with its keys: groups, proofs and folds all read them.
    keyed = stored(_keyed(rows).withColumn("_sources", F.array("seq")))
    named = keyed.where("_id is not null")
    works = named.groupBy("_id").agg(F.bool_or(F.col("_url") != "").alias("_paged"), F.count(F.lit(1)).alias("_n"))
    works = stored(works)
    if works.where("_n > 1").isEmpty():  # every work has one row
        return keyed.select(*columns, F.col("_sources").alias("sources"))
    alone = keyed.where("_id is null")
    if safe:
        proven = _alias_groups(named).where("one_work").select(F.col("identity").alias("_id"))
        works = stored(works.join(proven, "_id", "left_semi"))
        alone = alone.unionByName(named.join(works.select("_id"), "_id", "left_anti").select(*alone.columns))
    marked = stored(named.join(works.drop("_n"), "_id"))
    unpaged = _fold(marked.where("not _paged"), ["_id"], columns)
    pages = _fold(marked.where("_paged and _url != ''"), ["_id", "_url"], columns)
    titled = stored(_fold(pages, ["_id", "_key", "_year"], columns))
    whole = titled.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_key", "_year").alias("k"), F.bool_or(X.has_edition(F.col("movie_title"))).alias("edition"))
    one = stored(whole.where("n > 1 and n = k and not edition").select("_id"))
    folded = stored(titled.join(one, "_id", "left_anti").select(*titled.columns).unionByName(_fold(titled.join(one, "_id", "left_semi"), ["_id"], columns).select(*titled.columns)))
    release(one, titled)
    loose = marked.where("_paged and _url = ''").drop("_paged")
    # The choice of targets reads the distinct titles and years of a work.
    full = F.bool_or(F.rlike("release_date", F.lit(r"^\d{4}-\d{2}-\d{2}$"))).alias("full")
    asked = loose.groupBy("_id", F.col("_key").alias("title"), F.col("_year").alias("year")).agg(F.min("seq").alias("at"), full, F.lit(False).alias("paged"))
    there = folded.join(loose.select("_id").distinct(), "_id", "left_semi").groupBy("_id", F.col("_key").alias("title"), F.col("_year").alias("year"), F.col("seq").alias("at")).agg(full, F.lit(True).alias("paged"))
    facts = asked.unionByName(there).groupBy("_id").agg(F.collect_list(F.struct("title", "year", "at", "full", "paged")).alias("facts"))  # the distinct titles and years of one work
    chosen = stored(facts.mapInArrow(_chosen, "_id string, _key string, _year string, _at long"))
    placed = loose.join(chosen, ["_id", "_key", "_year"]).select(*folded.columns, "_at")
    met = folded.withColumn("_at", F.col("seq")).unionByName(placed)
    joined = _fold(met, ["_id", "_at"], columns)
    out = alone.select(*columns, F.col("_sources").alias("sources"))
    for part in (unpaged, joined):
        out = out.unionByName(part.select(*columns, F.col("_sources").alias("sources")))
    return out
