"""Reconciling a batch of candidates with a catalog.

The rule is sequential: each candidate is matched with the catalog as the ones
before it left it. But a candidate only meets rows that share a key with it, so
rows that are not connected by keys never touch. Connected rows are labelled as
blocks, and rounds of deterministic reservations take each block's candidates in
order, as many at once as cannot feel one another:

1. All waiting candidates are decided against the catalog as it stands.
2. A decision that appends a row, or changes a key of its target, reserves the
   candidate's keys and its target's. Other merges and reviews change no key, so they
   reserve nothing, and any number of them commute.
3. A candidate with a key that an earlier one has reserved might be decided
   otherwise. Of each block, all candidates before the first such one are taken.

The result is that of one candidate after another. The number of rounds is the
longest chain of decisions that change keys under one another, not the number of
candidates: ten thousand candidates of one title take two rounds. A round reads
the blocks that still wait, not the catalog.

Each row carries `sources`, the sorted seqs of all rows that went into it. It is an
addition if all of them are incoming.

Keys of dated rows: disc page, namespaced work id, outside id, and title with
year. Candidates without a year never append, so each phase of them is one pass
over the catalog that the dated ones left; those that meet one row fold into it
in input order. At the end rows that are proven to name one work become one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.operators import match
from catalogspark.operators.components import connected
from catalogspark.operators.merge import FULL_DATE, canonical, survivors
from catalogspark.operators.works import dedupe_by_work
from catalogspark.session import release, stored

COLUMNS = ("seq", "movie_title", "release_date", "studio", "tmdb_id", "media_type", "imdb_id", "bluray_url", "evidence_type", "quote")
KEYED = (*COLUMNS, "title_key", "year", "url_key")


def row_keys(rows: DataFrame) -> DataFrame:
    """(seq, key): every key that can bring a dated row together with another."""
    keys = F.array_compact(
        F.array(
            F.when(F.col("url_key") != "", F.concat(F.lit("u:"), "url_key")),
            F.when(F.col("tmdb_id") != "", F.concat_ws(":", F.lit("w"), "media_type", "tmdb_id")),
            F.when(F.col("imdb_id") != "", F.concat(F.lit("i:"), "imdb_id")),
            F.when(F.col("title_key") != "", F.concat_ws(":", F.lit("t"), "title_key", "year")),
        )
    )
    return rows.select("seq", F.explode(keys).alias("key"))


def blocks(rows: DataFrame) -> DataFrame:
    """(seq, block): the smallest seq that a row reaches over shared keys. Rows without a key are blocks of their own."""
    found = connected(row_keys(rows).withColumnRenamed("seq", "id"))
    return rows.select("seq").join(found.withColumnRenamed("id", "seq"), "seq", "left").select("seq", F.coalesce("label", "seq").alias("block"))


def _merged(catalog: DataFrame, decided: DataFrame) -> DataFrame:
    """The catalog rows that take candidates in: the target's title stays; an old row on an addition goes first and ends its being one."""
    merges = decided.where("action = 'merge'")
    targets = catalog.join(merges.select(F.col("target").alias("seq"), "existing").groupBy("seq").agg(F.bool_or("existing").alias("old")), "seq")
    base = targets.select(*COLUMNS, "is_addition", "sources", F.col("seq").alias("into"), F.when(F.col("old") & F.col("is_addition"), 2).otherwise(1).alias("place"), "old")
    taken = merges.select(*COLUMNS, F.lit(None).cast("boolean").alias("is_addition"), F.array("seq").alias("sources"), F.col("target").alias("into"), F.when(F.col("existing"), 1).otherwise(3).alias("place"), F.col("existing").alias("old"))
    rows = base.unionByName(taken).withColumn("ord", F.struct("place", "seq"))
    title = F.max(F.when(F.col("is_addition").isNotNull(), F.col("movie_title"))).alias("kept")
    lineage = F.array_sort(F.flatten(F.collect_list("sources"))).alias("sources")
    out = rows.drop("seq").withColumnRenamed("ord", "seq").groupBy("into").agg(*survivors(list(COLUMNS))[1:], title, F.bool_and(F.coalesce("is_addition", F.lit(True))).alias("added"), F.bool_or("old").alias("old"), lineage)
    plain = out.select(F.col("into").alias("seq"), F.col("kept").alias("movie_title"), *[c for c in COLUMNS if c not in ("seq", "movie_title")], (F.col("added") & ~F.col("old")).alias("is_addition"), "sources")
    return canonical(plain)


def _applied(catalog: DataFrame, decided: DataFrame) -> DataFrame:
    """The catalog after decisions (candidates with action and target) that do not touch each other."""
    changed = _merged(catalog, decided)
    appended = decided.where("action = 'append'").select(*KEYED, (~F.col("existing")).alias("is_addition"), F.array("seq").alias("sources"))
    rest = catalog.join(decided.where("action = 'merge'").select(F.col("target").alias("seq")).distinct(), "seq", "left_anti")
    return rest.unionByName(changed.select(*KEYED, "is_addition", "sources")).unionByName(appended)


def _turn(catalog: DataFrame, turn: DataFrame, number: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The catalog, the decisions and their texts after a set of candidates that do not meet each other."""
    d, texts, tables = match.decisions(turn, catalog, number)
    d, texts = stored(d), stored(texts)
    release(*tables)
    return stored(_applied(catalog, turn.join(d.withColumnRenamed("cand", "seq"), "seq"))), d, texts


def _safe(decided: DataFrame, catalog: DataFrame) -> DataFrame:
    """Of each block's decided candidates those before the first that an earlier one's decision may concern, stored."""
    facts = ("title_key", "year", "release_date", "url_key", "tmdb_id", "media_type", "imdb_id")
    targets = catalog.select(F.col("seq").alias("target"), *[F.col(c).alias(f"t_{c}") for c in facts])
    met = decided.join(targets, "target", "left")
    filled = lambda c: (F.col(c) != "") & (F.col(f"t_{c}") == "")
    full = lambda c: F.rlike(F.col(c), F.lit(FULL_DATE))
    dated = full("release_date") & ~full("t_release_date") & (F.col("year") != F.col("t_year"))
    changing = met.where((F.col("action") == "append") | ((F.col("action") == "merge") & (filled("url_key") | filled("tmdb_id") | filled("imdb_id") | dated)))
    changing = stored(changing.select("seq", *[c for c in facts], "action", *[f"t_{c}" for c in facts]))
    own = row_keys(changing)
    theirs = row_keys(changing.where("action = 'merge'").select("seq", *[F.col(f"t_{c}").alias(c) for c in facts]))
    moved = row_keys(changing.where("action = 'merge'").select("seq", F.col("t_title_key").alias("title_key"), "year", *[F.lit("").alias(c) for c in ("url_key", "tmdb_id", "media_type", "imdb_id")]))
    reserved = own.unionByName(theirs).unionByName(moved).groupBy("key").agg(F.min("seq").alias("holder"))
    waits = row_keys(decided).join(reserved, "key").where("holder < seq").select("seq").distinct()
    first = decided.join(waits, "seq", "left_semi").groupBy("block").agg(F.min("seq").alias("stop"))
    out = stored(decided.join(first, "block", "left").where("stop is null or seq < stop").drop("stop"))
    release(changing)
    return out


def reconcile(existing: DataFrame, incoming: DataFrame, rounds: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(catalog with is_addition and sources, decisions of all candidates). `rounds` gets the number of candidates of each round.

    Order: dated incoming rows, then old rows without a year, then incoming ones; each by seq.
    """
    old, new = stored(canonical(existing.select(*COLUMNS))), stored(canonical(incoming.select(*COLUMNS)))
    rows = old.where("year != ''").select(*KEYED, F.lit(False).alias("is_addition"), F.array("seq").alias("sources"))
    wanted = new.where("year != ''").select(*KEYED, F.lit(False).alias("existing"))
    labels = blocks(rows.select(*KEYED).unionByName(wanted.select(*KEYED)))
    labels = stored(labels)
    waiting, catalog = stored(wanted.join(labels, "seq")), stored(rows.join(labels, "seq"))
    release(labels)
    done, decided_all, texts_all, number = [], [], [], 0
    while left := waiting.count():
        # Tables of a round are deleted as soon as the next ones stand: the disk holds one round's, and what is done.
        open_blocks = waiting.select("block").distinct()
        live = stored(catalog.join(open_blocks, "block", "left_semi"))
        done.append(stored(catalog.join(open_blocks, "block", "left_anti").drop("block")))
        release(catalog)
        d, texts, tables = match.decisions(waiting.drop("block"), live.drop("block"), number)
        decided = stored(waiting.join(d.withColumnRenamed("cand", "seq"), "seq"))
        turn = _safe(decided, live)
        decided_all.append(stored(turn.select(F.col("seq").alias("cand"), "action", "target", "reason", "text")))
        texts_all.append(stored(texts.join(turn.select("text").distinct(), "text", "left_semi")))
        release(*tables, decided)
        # A row keeps its block: a merged one its target's, an appended one its candidate's.
        after = _applied(live.drop("block"), turn.drop("block", "text"))
        catalog = stored(after.join(live.select("seq", "block").unionByName(turn.select("seq", "block")), "seq"))
        rest = stored(waiting.join(turn.select("seq"), "seq", "left_anti"))
        release(waiting, live, turn)
        waiting, number = rest, number + 1
        if rounds is not None:
            rounds.append(left - waiting.count())
    parts = [*done, catalog]
    catalog = catalog.drop("block")
    for part in done:
        catalog = catalog.unionByName(part)
    catalog = stored(catalog)
    release(*parts)
    for rows, is_old in ((old, True), (new, False)):
        before = catalog
        catalog, d, texts = _turn(before, stored(rows.where("year = ''").select(*KEYED, F.lit(is_old).alias("existing"))), number)
        release(before)
        number += 1
        decided_all.append(d)
        texts_all.append(texts)
    decided, texts = decided_all[0], texts_all[0]
    for d, t in zip(decided_all[1:], texts_all[1:]):
        decided, texts = decided.unionByName(d), texts.unionByName(t)
    return finalized(catalog), match.with_titles(decided, texts)


def finalized(catalog: DataFrame) -> DataFrame:
    """The catalog with the rows of each proven work folded; a row is an addition if all rows in it are, and has all their sources."""
    once = stored(dedupe_by_work(catalog.select(*COLUMNS, "is_addition"), safe=True).withColumnRenamed("sources", "rows"))
    parts = once.select("seq", F.explode("rows").alias("row")).join(catalog.select(F.col("seq").alias("row"), "sources"), "row")
    lineage = parts.groupBy("seq").agg(F.array_sort(F.flatten(F.collect_list("sources"))).alias("sources"))
    out = stored(canonical(once.drop("rows").join(lineage, "seq")).select(*KEYED, "is_addition", "sources"))
    release(once)
    return out


def counts(catalog: DataFrame, decisions: DataFrame) -> DataFrame:
    """(outcome, n): catalog rows, additions, merged candidates, and reviews by reason."""
    rows = catalog.agg(F.count(F.lit(1)).alias("catalog"), F.count_if("is_addition").alias("additions")).select(F.explode(F.create_map(F.lit("catalog"), "catalog", F.lit("additions"), "additions")).alias("outcome", "n"))
    done = decisions.where("action != 'append'").groupBy(F.coalesce("reason", F.lit("merged")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(done)


def delta_summary(base: DataFrame, previous: DataFrame, head: DataFrame) -> DataFrame:
    """One row: rows of `head` that are additions to `base` (pending) and to `previous` (new), and whether there are new ones."""
    added = lambda old: reconcile(old, head)[0].agg(F.count_if("is_addition").alias("n"))
    both = added(base).withColumnRenamed("n", "pending").crossJoin(added(previous).withColumnRenamed("n", "new"))  # one row each
    return both.withColumn("has_new", F.col("new") > 0)
