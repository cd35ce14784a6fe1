"""A training corpus from `documents`: filter, dedupe lines and documents, mix, pack.

Each stage takes all that the one before kept. Stages are joined by Parquet in
the folder the cluster shares, so a lost executor repeats one stage's tasks only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.llm import lines, minhash, mixing, packing, quality
from catalogspark.session import release, shared_folder, ship

#: Two documents with this share of their five-word shingles in common are near duplicates. op10's own 85 does not hold here.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    ship(spark)
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or nearly equal lines the first stays; every document stays, with the lines left to it."""
    ship(spark)
    out = lines.drop_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    return minhash.drop_near(docs, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in a global random order."""
    ship(spark)
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and places."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: MinHash candidates and tokenisation have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again before the next, and goes once that one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/corpus_pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        release(docs)
        docs = spark.read.parquet(f"{base}/{name}")
        docs._stored_at = f"{base}/{name}"
    return docs
