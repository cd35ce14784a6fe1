"""Comparisons of two candidate lists, catalog deltas and sync differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.functions import text as X
from catalogspark.functions import urls as U
from catalogspark.session import release, stored

BATCH = 500


def label_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("mk", X.match_key(F.col("title"))).withColumn("label", F.concat("mk", F.lit(" ("), "year", F.lit(")")))


def _dealt(df: DataFrame) -> DataFrame:
    """The side of a join that grows with the input: it is dealt by its key, never broadcast."""
    return df.hint("merge")


def percent_of(shared: Column, most: Column) -> Column:
    return F.bround(100 * shared / most).cast("int")


def _ranked(titles: DataFrame, order: DataFrame) -> DataFrame:
    """(mk, size, words): the words of each title that the other side has, rarest first; size counts all words."""
    words = titles.select("mk", F.size("t").alias("size"), F.explode("t").alias("w"))
    found = words.join(_dealt(order), "w").groupBy("mk", "size").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("o"))
    return found.select("mk", "size", F.transform("o", lambda x: x["w"]).alias("words"))


def best_overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """(mk, best): for titles (mk, t: distinct words) of the left the largest percentage of shared words with a title of the right; titles that share none are left out.

    Words are in one order on both sides, rarest on the right first. A pair whose
    first common word is the i-th of n on the left and the j-th of m on the right
    shares at most min(n - i, m - j) + 1 words. Each word thus gives its title a
    floor without any pair: one shared word over the shortest title that has it.
    Pairs then meet in rounds, on the first word, the next, the next two, four
    and so on, and only where the bound beats what the title has so far; no title
    meets on its last word, and common words are reached only by titles that
    nothing rarer has matched. The rounds are as many as the longest title's
    words, by doubling.
    """
    words = right.select("mk", F.size("t").alias("size"), F.explode("t").alias("w"))
    held = stored(words.groupBy("w").agg(F.count(F.lit(1)).alias("df"), F.min("size").alias("least")))
    order = held.select("w", "df")
    x, y = stored(_ranked(left, order)), stored(_ranked(right, order))
    floors = x.select("mk", "size", F.explode("words").alias("w")).join(_dealt(held), "w").groupBy("mk").agg(F.max(percent_of(F.lit(1), F.greatest("size", "least"))).alias("best"))
    best = stored(floors)
    at_left = x.select("mk", F.col("size").alias("n"), F.posexplode("words").alias("i", "w"), F.col("words").alias("a"))
    at_right = y.select(F.col("size").alias("m"), F.posexplode("words").alias("j", "w"), F.col("words").alias("b"))
    longest = x.agg(F.max(F.size("words"))).first()[0] or 0
    done, upto = 0, 1
    while done < longest - 1:
        open_ = at_left.where((F.col("i") >= done) & (F.col("i") < upto)).join(_dealt(best), "mk")
        # The bound by the left side alone keeps settled titles from the exchange.
        open_ = open_.where((F.size("a") - F.col("i") > 1) & (percent_of(F.size("a") - F.col("i"), F.col("n")) > F.col("best")))
        bound = percent_of(F.least(F.size("a") - F.col("i"), F.size("b") - F.col("j")), F.greatest("n", "m"))
        met = open_.join(_dealt(at_right), "w").where(bound > F.col("best"))
        better = met.groupBy("mk").agg(F.max(percent_of(F.size(F.array_intersect("a", "b")), F.greatest("n", "m"))).alias("more"))
        now = stored(best.join(_dealt(better), "mk", "left").select("mk", F.greatest("best", "more").alias("best")))
        release(best)
        best, done, upto = now, upto, 2 * upto
    release(held, x, y)
    return best


def best_match(a: DataFrame, b: DataFrame) -> DataFrame:
    """(seq, match_percent): 100 for an equal label in b, else the best rounded token overlap; 0 where no token is shared."""
    return matched(label_key(a), label_key(b)).select("seq", "match_percent")


def matched(x: DataFrame, y: DataFrame) -> DataFrame:
    """Rows with their label and key, each with its match_percent among those of y. A row meets the labels and the titles of y once each, and not itself.

    No side of these joins is small, so none is sent to the driver to be broadcast, however small an estimate has it.
    """
    exact = x.join(_dealt(y.select("label").distinct().withColumn("_same", F.lit(100))), "label", "left")
    # Equal titles are compared once, and one that stands on both sides is settled by that.
    titles = lambda df: df.groupBy("mk").agg(F.first(X.tokens(F.col("mk"))).alias("t"))
    left, right = titles(x), titles(y)
    some = F.size("t") > 0
    same = left.where(some).join(_dealt(right.select("mk")), "mk", "left_semi").select("mk", F.lit(100).alias("best"))
    other = best_overlaps(left.where(some).join(_dealt(right.select("mk")), "mk", "left_anti"), right.where(some))
    out = exact.join(_dealt(same.unionByName(other)), "mk", "left")
    return out.select(*x.columns, F.coalesce("_same", "best", F.lit(0)).alias("match_percent"))


def set_compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: distinct labels of each side, shared and on one side only."""
    return labels_compared(label_key(a), label_key(b))


def labels_compared(x: DataFrame, y: DataFrame) -> DataFrame:
    """The same of rows that have their labels."""
    one = lambda df, name: df.select("label").distinct().withColumn(name, F.lit(1))
    both = one(x, "a").join(one(y, "b"), "label", "full")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    return both.agg(n(F.col("a") == 1).alias("n_a"), n(F.col("b") == 1).alias("n_b"), n((F.col("a") == 1) & (F.col("b") == 1)).alias("n_both"), n(F.col("b").isNull()).alias("only_a"), n(F.col("a").isNull()).alias("only_b"))


def syncable() -> Column:
    """Films with a proper outside id; series and rows without one can't be in the list."""
    return F.coalesce(F.rlike("imdb_id", F.lit(r"^tt\d+$")) & (F.coalesce("media_type", F.lit("movie")) != "tv"), F.lit(False))


def sync_skipped(catalog: DataFrame) -> DataFrame:
    """(seq, movie_title) of the catalog rows that `sync_diff` leaves out."""
    return catalog.where(~syncable()).select("seq", F.coalesce("movie_title", F.lit("<unknown>")).alias("movie_title"))


def sync_diff(catalog: DataFrame, current: DataFrame, allow_empty: bool = False) -> DataFrame:
    """(imdb_id, action, batch): ids to add, remove or leave, adds and removes numbered into batches.

    A catalog without any id would remove everything: it is refused unless allowed.
    """
    if not allow_empty and catalog.where(syncable()).isEmpty():
        raise ValueError("refusing to empty the list; pass allow_empty to do so")
    wanted = catalog.where(syncable()).select("imdb_id").distinct().withColumn("d", F.lit(1))
    both = wanted.join(current.select("imdb_id").distinct().withColumn("c", F.lit(1)), "imdb_id", "full")
    acts = both.select("imdb_id", F.when(F.col("c").isNull(), "add").when(F.col("d").isNull(), "remove").otherwise("unchanged").alias("action"))
    # Numbered within blocks of ids that share a prefix, so that no task orders a whole action.
    block = F.substring("imdb_id", 1, 6)
    keyed = acts.withColumn("block", block)
    counts = keyed.groupBy("action", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("action").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("action", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    local = F.row_number().over(Window.partitionBy("action", "block").orderBy("imdb_id")) - 1
    numbered = keyed.withColumn("local", local).join(shifts, ["action", "block"])
    return numbered.select("imdb_id", "action", F.when(F.col("action") != "unchanged", F.floor((F.col("local") + F.col("shift")) / BATCH)).cast("int").alias("batch"))


def unreferenced(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """File names that no catalog row points at, each once."""
    base = lambda c: F.substring_index(c, "/", -1)
    return files.select(base("name").alias("name")).distinct().join(catalog.select(base("poster_path").alias("name")).distinct(), "name", "left_anti")


def new_sources(found: DataFrame, known: DataFrame, limit: int = 25) -> DataFrame:
    """The first `limit` safe links of unknown sources, each source once; the limit is the feature."""
    safe = found.withColumn("safe", U.safe_url(F.col("url"))).where("safe is not null").withColumn("key", U.source_key(F.col("safe")))
    fresh = safe.join(known.select(U.source_key(F.col("url")).alias("key")).distinct(), "key", "left_anti")
    first = fresh.groupBy("key").agg(F.min("seq").alias("seq"), F.min_by("safe", "seq").alias("url"))
    return first.orderBy("seq").limit(limit).select("seq", "url")


def merge_registry(registry: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(seq, url, source_key): the registry, then confirmed links of other sources, the first spelling of each."""
    both = registry.select(F.lit(0).alias("src"), "seq", "url").unionByName(confirmed.select(F.lit(1).alias("src"), "seq", "url"))
    keyed = both.withColumn("source_key", U.source_key(F.col("url")))
    first = keyed.groupBy("source_key").agg(F.min_by(F.struct("src", "seq", "url"), F.struct("src", "seq")).alias("r"))
    return first.select("r.src", "r.seq", "r.url", "source_key")
