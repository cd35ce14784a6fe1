"""Sharding by weighted rendezvous hashing, in Spark functions alone.

Every record key is scored against every shard with a hash of (seed, key,
shard); the best score wins. A new shard can only take rows whose best score it
beats, so no row moves between old shards. Work is one hash a row and shard, and
no row depends on another until slots are numbered.

Slots are numbered in two steps, so that no task orders a whole shard: rows are
dealt into buckets of about SLOT_ROWS rows by a hash of the key, numbered within
(shard, bucket), and shifted by the running count of earlier buckets.

Nulls: a null key hashes as the empty string, a null text counts no bytes.
Repeated rows get the same shard and different slots; among rows with equal key
and text the slots are dealt in any order. An empty table gives an
empty result. Extra columns stay out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm.common import stored

SLOT_ROWS = 16_384
SEED = "rendezvous"


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def shard_scores(key: Column, weights: list[float], seed: str = SEED) -> Column:
    """One score a shard: weight / -ln(u). The largest wins with probability weight / sum(weights)."""
    return F.array(*[F.lit(float(w)) / -F.ln(unit_hash(F.lit(seed), key, F.lit(str(i)))) for i, w in enumerate(weights)])


def assign(rows: DataFrame, key: str, weights: list[float], grown_weight: float = 1.0, seed: str = SEED) -> DataFrame:
    """Add `shard`, and `grown_shard`: the shard once one more of `grown_weight` joins. Ties go to the lower shard."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    n = len(weights)
    scored = rows.withColumn("_scores", shard_scores(name, [*weights, grown_weight], seed))
    best = F.array_max(F.slice("_scores", 1, n))
    return (
        scored.withColumn("_best", best)
        .withColumn("shard", (F.array_position("_scores", F.col("_best")) - 1).cast("int"))
        .withColumn("grown_shard", F.when(F.element_at("_scores", n + 1) > F.col("_best"), F.lit(n)).otherwise(F.col("shard")).cast("int"))
        .drop("_scores", "_best")
    )


def number_slots(rows: DataFrame, key: str, n_rows: int, seed: str = SEED) -> DataFrame:
    """Add `slot`: 0, 1, 2, ... within each shard, ordered by (bucket, key, text checksum)."""
    buckets = max(1, -(-n_rows // SLOT_ROWS))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    dealt = rows.withColumn("_bucket", F.floor(unit_hash(F.lit(seed), name, F.lit("slot")) * buckets).cast("int"))
    within = Window.partitionBy("shard", "_bucket").orderBy(F.col(key).asc_nulls_last(), "text_crc32")
    numbered = dealt.withColumn("_n", F.row_number().over(within) - 1)
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows")).withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return numbered.join(shifts, ["shard", "_bucket"]).withColumn("slot", (F.col("_n") + F.col("_shift")).cast("long")).drop("_bucket", "_n", "_shift")


def shard_documents(docs: DataFrame, shards: int = 24, weights: list[float] | None = None) -> DataFrame:
    """Shard, slot, size and checksum of every document; the text itself is never shuffled."""
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = stored(assign(slim, "doc_id", weights or [1.0] * shards).withColumn("law", F.lit("key")))  # a few numbers a row: the texts are read once
    return number_slots(placed, "doc_id", placed.count()).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
