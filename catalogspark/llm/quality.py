"""Quality rules as a bitmask ledger.

Every rule is evaluated once: measurements come from one pass over the text,
each failed rule sets one bit, and both are stored. A policy is a version name
with a mask of the bits it enforces, so applying another version, or asking what
a rule alone costs, is arithmetic on the stored bits.

Defined cases: a null or empty text has no words and fails `few_words`; texts of
any length are measured whole; repeated rows are judged alike; an empty table
gives an empty ledger. The ledger is one struct column, so columns of the input
never clash with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.llm import blocks as B

LEDGER = "__ledger"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: In bit order. Never renumber: stored ledgers hold these bits.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "5 * n_symbols > n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 25 * n_words"),
]
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_words"]
POLICIES = {
    "v1": BASE,
    "v2": BASE | BITS["many_symbols"] | BITS["repeated_lines"] | BITS["word_length"],
}
CURRENT = "v2"


def _dup_lines(data: bytes) -> tuple[int, int]:
    """Lines that hold a word, and how many of them equal an earlier line."""
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def measure_block(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    n = len(off) - 1
    inside = ~B.SPACE[buf]
    starts, ends, first = B.word_bounds(buf, off, inside)
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(inside & ((buf & 0xC0) != 0x80), out=points[1:])
    symbols = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf], out=symbols[1:])
    out = {"n_words": np.diff(first), "word_chars": points[off[1:]] - points[off[:-1]], "n_symbols": symbols[off[1:]] - symbols[off[:-1]], "n_repeat_words": np.zeros(n, np.int64)}
    if len(starts) >= WINDOW:
        grams = B.rolling_hashes(B.span_hashes(buf, starts, ends), WINDOW)
        doc = B.owners(first)
        at = np.flatnonzero(doc[: len(grams)] == doc[WINDOW - 1 :])
        key = grams[at] ^ B.mix(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(B.covered(at[twice], WINDOW, len(starts)), out=hit[1:])
        out["n_repeat_words"] = hit[first[1:]] - hit[first[:-1]]
    data = buf.tobytes()
    lines = np.array([_dup_lines(data[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], np.int64).reshape(n, 2)
    return out | {"n_lines": lines[:, 0], "n_dup_lines": lines[:, 1]}


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the struct column LEDGER of measurements."""
    kind = T.StructType([T.StructField(m, T.LongType(), False) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, text):
            got = measure_block(*B.utf8(part.column(text)))
            struct = pa.StructArray.from_arrays([pa.array(got[m].astype(np.int64)) for m in MEASURES], fields=[pa.field(m, pa.int64(), False) for m in MEASURES])
            yield from part.append_column(pa.field(LEDGER, struct.type, False), struct).combine_chunks().to_batches()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(LEDGER, kind, False)]))


def failed_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, rule in RULES:
        failed = F.expr(re.sub(r"\b(n_\w+|word_chars)\b", rf"{LEDGER}.\1", rule))
        bits = bits.bitwiseOR(F.when(failed, F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with LEDGER holding the measurements and `failed_bits`."""
    return measured(docs, text).withColumn(LEDGER, F.col(LEDGER).withField("failed_bits", failed_bits()))


def verdict(policy: str = CURRENT) -> Column:
    """True where no enforced rule failed."""
    return F.col(f"{LEDGER}.failed_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablations(stored: DataFrame, policy: str = CURRENT) -> DataFrame:
    """One row a rule: rows it rejects, and rows that only it rejects under the policy. One aggregation for all."""
    mask = POLICIES[policy]
    bits = F.col(f"{LEDGER}.failed_bits").bitwiseAND(F.lit(mask).cast("long"))
    counts = stored.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** rules rows
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit")) for name, bit in BITS.items() if bit & mask]))
    return (
        counts.withColumn("_r", rules)
        .groupBy(F.col("_r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("_r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("_r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )


def keep(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of docs that pass the policy, with docs' own columns."""
    return ledger(docs).where(verdict(policy)).drop(LEDGER)
