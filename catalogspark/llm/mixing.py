"""Mixing sources to target weights by Poisson replication.

Each document of source s is repeated a Poisson number of times whose mean is
the source's repetition rate: target share / present share. The Poisson draw
inverts the distribution at a uniform number hashed from (seed, document), so a
lost task redraws the same counts. Copies are ordered by a hash of (seed,
document, copy), dealt by ranges of it: a global shuffle without one global sort task.

Nulls: a null source is a source of its own, a null id hashes as the empty
string. Repeated rows draw the same count. Empty tables give empty results.
A draw enumerates the distribution, so a rate above MAX_RATE is drawn as a sum of
independent Poisson draws of mean PART_RATE at most, which is exact. Documents of
more than BLOCK copies are dealt out in blocks before these become rows. Extra
columns pass through `mix`, whatever their names; its own begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.common import partitions, small_side, stored

SEED = "mixture"
#: Default targets: present shares raised to this power, then normalised.
TEMPERATURE = 0.5
#: Rates up to this are one draw.
MAX_RATE = 200.0
#: The largest mean of a draw that is one of several.
PART_RATE = 100.0
#: Copies that one row becomes in one step.
BLOCK = 1000
NO_SOURCE = "\x00none"


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of the parts."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_rates(docs: DataFrame, targets: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(__source, __rate) over all documents: counts are summed map-side, so a hot source is one small row a task."""
    counts = docs.groupBy(F.coalesce(F.col("source"), F.lit(NO_SOURCE)).alias("__source")).agg(F.count(F.lit(1)).alias("__n"))
    if targets is not None:
        wanted = F.coalesce(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])[F.col("__source")], F.lit(0.0))
    else:
        wanted = F.pow(F.col("__n").cast("double"), F.lit(temperature))
    weighed = counts.withColumn("__w", wanted)
    total, weights = weighed.agg(F.sum("__n"), F.sum("__w")).first()
    rate = F.col("__w") / F.lit(float(weights or 1)) * F.lit(float(total or 1)) / F.col("__n")
    return weighed.select("__source", rate.alias("__rate"))


def poisson_inverse(u: Column, rate: Column, highest: Column) -> Column:
    """The smallest k with P(X <= k) >= u, for k up to `highest`: terms built one from the last."""
    start = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), u.alias("u"))

    def step(acc: Column, i: Column) -> Column:
        p = acc["p"] * rate / i
        return F.when(acc["c"] >= acc["u"], acc).otherwise(F.struct(i.alias("k"), p.alias("p"), (acc["c"] + p).alias("c"), acc["u"].alias("u")))

    return F.aggregate(F.sequence(F.lit(1), highest), start, step, lambda acc: acc["k"])


def highest_count(rate: Column) -> Column:
    """A count that a draw of this mean exceeds with a chance under a double's resolution."""
    return (rate + 12 * F.sqrt(F.greatest(rate, F.lit(1.0))) + 20).cast("int")


def poisson_count(seed: str, name: Column, rate: Column) -> Column:
    """A document's copies: one draw, or the sum of as many draws as its rate needs."""
    parts = F.ceil(rate / PART_RATE).cast("int")
    part = rate / parts
    draw = lambda done, i: done + poisson_inverse(unit_hash(F.lit(seed), name, F.lit("part"), i.cast("string")), part, highest_count(part))
    several = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), draw)
    return F.when(rate <= MAX_RATE, poisson_inverse(unit_hash(F.lit(seed), name), rate, highest_count(rate))).otherwise(several)


def copies_of(drawn: DataFrame, parts: int, some_large: bool) -> DataFrame:
    """One row a copy, numbered in `__copy`. Large counts become blocks, which are dealt out before they become rows."""
    rows = lambda df, first, end: df.withColumn("__copy", F.explode(F.sequence(first, end - 1)))
    if not some_large:
        return rows(drawn, F.lit(0), F.col("__copies"))
    blocks = drawn.where(F.col("__copies") > BLOCK).withColumn("__block", F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / BLOCK).cast("int"))))
    blocks = blocks.repartition(parts, F.xxhash64("doc_id", "__block"))
    first = F.col("__block") * BLOCK
    return rows(drawn.where(F.col("__copies") <= BLOCK), F.lit(0), F.col("__copies")).unionByName(rows(blocks, first, F.least(F.col("__copies"), first + BLOCK)).drop("__block"))


def mix(docs: DataFrame, targets: dict[str, float] | None = None, temperature: float = TEMPERATURE, seed: str = SEED) -> DataFrame:
    """docs' rows repeated to the targets, with `__copy` from 0, `__copies` and `__order`; globally shuffled by `__order`."""
    rates = stored(source_rates(docs, targets, temperature))
    n, top = rates.agg(F.count(F.lit(1)), F.max("__rate")).first()
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = (
        docs.withColumn("__source", F.coalesce(F.col("source"), F.lit(NO_SOURCE)))
        .join(small_side(rates, n), "__source")
        .withColumn("__copies", poisson_count(seed, name, F.col("__rate")))
        .where("__copies > 0")
    )
    parts = partitions(docs.sparkSession)
    copies = copies_of(drawn, parts, (top or 0) > MAX_RATE).withColumn("__order", unit_hash(F.lit(seed), name, F.col("__copy").cast("string")))
    # The order is uniform by its making, so its ranges are known without a pass over the copies.
    return copies.repartitionById(parts, F.floor(F.col("__order") * parts).cast("int")).sortWithinPartitions("__order").drop("__source", "__rate")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """Ids, source, place and text checksum of every copy: what the query returns. The texts are read, but checksums move in their place."""
    slim = docs.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")) if "text" in docs.columns else docs.select("doc_id", "source")
    return mix(slim, **how).select(*slim.columns, F.col("__copy").alias("copy"), F.col("__copies").alias("n_copies"), F.col("__order").alias("shuffle_key"))
