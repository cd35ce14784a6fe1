"""MinHash near-dedup with bottom-k sketches from one hash function.

1. Sketch: a document's set holds its distinct 5-word shingles; its sketch is the
   K smallest shingle hashes. Documents with equal sets are one class, known by
   the set's size and two independent sums over it; only classes go on. A class is
   a node whose number is a hash of these, so rows of one id may lie in several.
2. Inverted lists: a pair at the threshold T shares at least NEED of its K
   retained values (five standard deviations below the mean, a chance of under
   one in a million to miss a pair), so it shares one of each side's K - NEED + 1
   rarest values. Values are ordered by how many classes retain them, and a class
   is listed under its rarest ones: a value that many unrelated documents share
   lists none of them, unless they share most of their sketch.
3. Links: pairs are first estimated by the union sketch (the K smallest values of
   both), then decided by exact Jaccard on full sets: each list's hub with all its
   members, then in tiles those that the hubs leave apart (see linking.py).
4. Components by distributed union-find.

Defined cases: null or empty texts have an empty set and link with nothing; texts
are read whole; repeated rows are one class; rows that share an id are linked by
that, each set with its own links (one without shingles is linked with nothing);
a row without an id has the smallest id that its links reach, or none, and is kept
if it reaches none; an empty table gives an empty result; other columns stay out
of the report. `drop_near`
decides for each row by its own text, also where rows share an id or have none
(equal rows of one id are one document); other columns pass through, but that names
with two leading underscores are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm import exchange as X
from catalogspark.llm.common import NO_ID, keyed_rows, release, small_side, stored
from catalogspark.llm.components import connected
from catalogspark.llm.linking import linked

SHINGLE = 5
PERCENT = 85
K = 64
SIGMAS = 5
CHUNK_ROWS = 1024


def lowest_estimate(percent: int, k: int = K) -> float:
    """The estimate below which a pair at the threshold falls with a chance of under one in a million."""
    t = percent / 100
    return t - SIGMAS * (t * (1 - t) / k) ** 0.5


def listed(percent: int, k: int = K) -> int:
    """How many of its rarest values a class is listed under."""
    return k - int(lowest_estimate(percent, k) * k) + 1


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each document, in order, and where each document's begin (n + 1)."""
    low = B.ASCII_LOWER[buf]
    starts, ends, first = B.word_bounds(low, off, ~B.SPACE[low])
    codes = B.span_hashes(low, starts, ends)
    doc = B.owners(first)
    grams = B.rolling_hashes(codes, width)
    at = np.flatnonzero(doc[: len(grams)] == doc[width - 1 :]) if len(grams) else np.zeros(0, np.int64)
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < width))
    keys = np.concatenate([grams[at], B.span_hashes(codes.view(np.uint8), 8 * first[short], 8 * first[short + 1])])
    docs = np.concatenate([doc[at], short])
    order = np.lexsort((keys, docs))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    return keys[new], np.searchsorted(docs[new], np.arange(len(off)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, th, n, sum_a, sum_b, sketch) of every row; th tells the texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, "text"):
            keys, bounds = shingle_sets(*B.utf8(part.column("text")))
            data = keys.tobytes()
            rows = [data[8 * a : 8 * min(b, a + k)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").combine_chunks(), part.column("th").combine_chunks(), pa.array(np.diff(bounds).astype(np.int64)), pa.array(_sums(B.mix(keys), bounds)), pa.array(_sums(B.mix(keys ^ np.uint64(0x5851F42D4C957F2D)), bounds)), pa.array(rows, pa.binary())],
                names=["doc_id", "th", "n", "sum_a", "sum_b", "sketch"],
            )

    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return slim.mapInArrow(run, "doc_id long, th long, n long, sum_a long, sum_b long, sketch binary")


def _values(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return X.unpack(table, "sketch", np.uint64)


def _send_values(chunk: int, table: pa.Table, buckets: int) -> pa.Table:
    values, counts = np.unique(_values(table)[0], return_counts=True)
    bucket = (B.mix(values) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    packed = X.by_bucket(bucket[order], {"keys": values[order], "counts": counts[order].astype(np.uint16)})
    return pa.table({"bucket": pa.array(packed["bucket"], pa.int32()), "chunk": pa.array([chunk] * len(packed["keys"]), pa.int32()), "keys": pa.array(packed["keys"], pa.binary()), "counts": pa.array(packed["counts"], pa.binary())})


def _count_values(table: pa.Table) -> pa.Table:
    keys, rows = X.unpack(table, "keys", np.uint64)
    counts, _ = X.unpack(table, "counts", np.uint16)
    _, back = np.unique(keys, return_inverse=True)
    df = np.bincount(back, counts).astype(np.uint32)[back] if len(keys) else np.zeros(0, np.uint32)
    hit = df > 1
    return X.reply(table, rows[hit], {"keys": keys[hit], "counts": df[hit]})


def _list_values(table: pa.Table, replies: pa.Table, most: int) -> pa.Table:
    known = X.unpack(replies, "keys", np.uint64)[0]
    order = np.argsort(known)
    known, df = known[order], X.unpack(replies, "counts", np.uint32)[0][order]
    values, row = _values(table)
    at, found = B.find(known, values)
    count = np.where(found, df[at], 1) if len(known) else np.ones(len(values), np.uint32)
    order = np.lexsort((values, count, row))
    row, values, count = row[order], values[order], count[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    use = (rank < most) & (count > 1)
    reps, n = table.column("rep").to_numpy()[row[use]], table.column("n").to_numpy()[row[use]]
    return pa.table({"value": pa.array(values[use].view(np.int64)), "rep": pa.array(reps), "n": pa.array(n)})


def inverted_lists(classes: DataFrame, n_rows: int, most: int) -> DataFrame:
    """(value, rep, n): each class under its rarest retained values, values of one class left out."""
    chunks = max(1, -(-n_rows // CHUNK_ROWS))
    buckets = max(1, chunks // 2)
    dealt = classes.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.lit(chunks)).cast("int")).groupBy("chunk")
    sent = dealt.applyInArrow(lambda key, t: _send_values(key[0].as_py(), t, buckets), "bucket int, chunk int, keys binary, counts binary")
    counted = sent.groupBy("bucket").applyInArrow(lambda t: _count_values(t), "chunk int, keys binary, counts binary")
    return dealt.cogroup(counted.groupBy("chunk")).applyInArrow(lambda l, r: _list_values(l, r, most), "value long, rep long, n long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in B.slices(batches, "text"):
        keys, bounds = shingle_sets(*B.utf8(part.column("text")))
        data = keys.tobytes()
        rows = [data[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("rep").combine_chunks(), pa.array(rows, pa.binary())], names=["rep", "body"])


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, body): the whole shingle sets of the wanted (rep, doc_id, th); only those leave the scan where they are few."""
    wanted = stored(wanted)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    chosen = rows.join(small_side(wanted, wanted.count()), ["doc_id", "th"]).select("rep", "text")
    out = chosen.mapInArrow(_sets, "rep long, body binary").dropDuplicates(["rep"])
    out._behind = (wanted,)
    return out


def _arrays(bodies: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in bodies]


def same_ids(rows: DataFrame) -> DataFrame:
    """(a, b): links between the classes of rows that share an id."""
    named = rows.where(F.col("doc_id") != NO_ID).select("doc_id", "rep")
    several = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    return named.join(several, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    rows = stored(sketches(docs, k).withColumn("rep", F.when(F.col("n") > 0, F.xxhash64("n", "sum_a", "sum_b"))).drop("sum_a", "sum_b"))
    some = rows.where("n > 0")
    classes = stored(some.groupBy("rep").agg(F.min(F.struct("doc_id", "th")).alias("home"), F.min_by("sketch", F.struct("doc_id", "th")).alias("sketch"), F.min("n").alias("n")).select("rep", "home.*", "sketch", "n"))
    lists = stored(inverted_lists(classes, classes.count(), listed(percent, k)))
    parts = linked(lists, lambda wanted: full_sets(docs, classes.select("rep", "doc_id", "th").join(wanted, "rep")), _arrays, percent, (k, lowest_estimate(percent, k)))
    shared = stored(same_ids(some))
    if not shared.isEmpty():
        merged = connected(parts.toDF("a", "b").unionByName(shared))
        release(parts)
        parts = merged
    # A component is named by its smallest id.
    named = classes.select("rep", "doc_id").join(parts.withColumnRenamed("node", "rep"), "rep")
    first = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    placed = stored(named.select("rep", "component").join(first, "component").select("rep", "component_id"))
    own = stored(classes.select("rep", "doc_id").join(placed, "rep", "left").select("rep", F.coalesce("component_id", "doc_id").alias("component_id")))
    release(lists, classes, parts, shared, placed)
    out = rows.select("doc_id", "n", "rep").join(own, "rep", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id")).withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID))).withColumn("component_id", F.nullif("component_id", F.lit(NO_ID)))


def drop_near(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with the first row, by id, of each component; docs' own columns."""
    rows = keyed_rows(docs).withColumn("__key", F.xxhash64("__id", "__row"))
    near = near_duplicates(rows.select(F.col("__key").alias("doc_id"), "text"), percent).where("not kept")
    others = stored(near.select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__component")).distinct())
    members = stored(others.union(others.select("__component", "__component").distinct()))
    places = stored(rows.select("__id", "__key").join(small_side(members, members.count()), "__key").distinct())
    first = places.groupBy("__component").agg(F.min(F.struct("__id", "__key")).alias("__first"))
    lost = stored(places.join(first, "__component").where(F.col("__key") != F.col("__first.__key")).select("__key"))
    return rows.join(small_side(lost, lost.count()), "__key", "left_anti").select(*docs.columns)
