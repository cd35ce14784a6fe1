"""Incremental refresh: cached lookups, and a stream of candidates folded into catalog versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MISS_DAYS = 7


def cache_state(log: DataFrame, requests: DataFrame, now: str, version: str) -> DataFrame:
    """(key, state) of every cached or requested key: hit (never expires), fresh-miss (younger than a week), or fetch.

    log holds (key, at, stamp, hit, version); the record with the largest `at` counts.
    """
    latest = log.groupBy("key").agg(F.max_by(F.struct("stamp", "hit", "version"), "at").alias("r"))
    young = F.col("r.stamp") > F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {MISS_DAYS} DAYS")
    current = F.col("r.version") == version
    state = F.when(current & F.col("r.hit"), "hit").when(current & F.coalesce(young, F.lit(False)), "fresh-miss").otherwise("fetch")
    asked = requests.join(latest.select("key"), "key", "left_anti").select("key", F.lit("fetch").alias("state"))
    return latest.select("key", state.alias("state")).unionByName(asked)


def stream_reconcile(spark: SparkSession, source: str, schema, folder: str, fold: Callable[[DataFrame | None, DataFrame], DataFrame], files: int = 1000, checkpoint: str = "checkpoint") -> str:
    """Fold all waiting files of a candidate stream into catalog versions under `folder`; returns the newest version's path.

    A batch has `files` files at most and writes version-N once: a replayed batch finds
    its version and skips, so a restart adds nothing, even where the checkpoint was lost.
    """

    def versions() -> list[int]:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/catalog")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = [f.getPath() for f in fs.listStatus(path)]
        return sorted(int(p.getName().split("-")[1]) for p in done if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def batch(rows: DataFrame, batch_id: int) -> None:
        have = versions()
        if batch_id in have:
            return
        known = spark.read.parquet(f"{folder}/catalog/version-{have[-1]}") if have else None
        fold(known, rows).write.mode("overwrite").parquet(f"{folder}/catalog/version-{batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    run = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/{checkpoint}").trigger(availableNow=True).start()
    run.awaitTermination()
    have = versions()
    return f"{folder}/catalog/version-{have[-1]}" if have else ""
