"""What several operators share: sizing from the data, checked broadcasts, rows without an id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.session import checkpoint, release, ship, stored

__all__ = ["checkpoint", "release", "ship", "stored"]

#: Counted rows up to which a side is broadcast. Its rows are a few numbers each, so it stays under some 30 MB.
BROADCAST_ROWS = 500_000

#: A row without an id sorts after all rows that have one.
NO_ID = (1 << 63) - 1

#: Equal rows without an id that are put out in one step.
COPIES = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of a whole column: one number to the driver."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Mark a side for broadcast when its counted rows are under the bound; else Spark shuffles it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def keyed_rows(docs: DataFrame) -> DataFrame:
    """docs with `__id` (NO_ID for none) and `__row`, which tells the rows of one id apart.

    `__row` is a hash of the text where there is an id: equal rows of one id are
    one document. Each row without an id has a number of its own: fully equal
    ones are counted, and put out again as that many numbered rows, in blocks
    that are dealt out before they become rows.
    """
    number = F.col("doc_id").cast("long")
    named = docs.where(number.isNotNull()).withColumn("__id", number).withColumn("__row", F.xxhash64("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    parts = [x for c in columns for x in (c.isNull(), c)]
    counted = docs.where(number.isNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    blocks = counted.withColumn("__block", F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / COPIES))))
    dealt = blocks.repartition(partitions(docs.sparkSession), F.xxhash64("__block", *parts))
    first = F.col("__block") * COPIES
    copies = dealt.withColumn("__copy", F.explode(F.sequence(first, F.least(F.col("__n"), first + COPIES) - 1)))
    nameless = copies.select(*columns, F.lit(NO_ID).alias("__id"), F.xxhash64("__copy", *parts).alias("__row"))
    return named.unionByName(nameless)

