"""Language-model scores by Katz backoff.

An n-gram seen c > 0 times after its history h (the n - 1 words before it) has the
probability d(c) * c / C(h); any other word has a(h) times its probability after
the history without its first word. d(c) is the Good-Turing discount for c up to 5
and 1 above; C(h) is the number of words seen after h; a(h) is what the discounts of h
free, divided by what the shorter history leaves to words not seen after h. The
last step down is a single unknown word, which gets what the discounts of the
single words free. So after each history the probabilities of all known words and
the unknown one sum to 1 exactly. Where no discount of h frees anything (all counts
above 5) one word more is counted in C(h), which frees its share; a history never
seen passes the shorter one's probabilities on. Where the counts of counts give no
valid Good-Turing discounts up to 5, the longest valid range is used, and without
any a word seen once is halved.

How it runs: documents are cut into blocks (BLOCK_BYTES of text, or one longer
document), whose words become numbers once; blocks are a stored table. Then

1. counts: a block sends each distinct n-gram once, sorted and packed by bucket (a
   range of fingerprints), with its count in the documents learned from. A bucket
   sums up, tells every block the total of each n-gram it sent, and marks one
   block as the n-gram's owner;
2. weights, for n = 2 and up: the owners sum C, the mass freed, and the shorter
   history's probabilities over the n-grams they own, by history; buckets sum
   these, work out a(h), and tell every block that has the history;
3. scores: each block evaluates its tokens, recursively from the longest history.

Counts and weights stand in tables partitioned by kind and order, with the
n-grams' keys in ranges. However often an n-gram occurs, it is one entry a block.
Words and n-grams are known by fingerprints of 64 bits.

Tokens: words in lower case (A-Z), then one end a document. Histories reach back to
the document's beginning, before which stand marks that are never predicted.

Defined cases: a null or empty text is the end alone; a document without an id has
the checksum of the empty text, and is learned from; rows that share an id are
documents of their own, alike in being held out; with nothing to learn from all
words are unknown, with probability 1; an empty table gives an empty result;
other columns of the input, whatever their names, stay out of the result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm.alignment import gathered, opened, squeezed
from catalogspark.llm.common import stored, text_bytes
from catalogspark.session import shared_folder

ORDER = 2
#: Counts up to this are discounted.
DISCOUNTED = 5
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 1 << 20
#: Bytes of text for each bucket.
BUCKET_BYTES = 8 << 20

#: The end of a document, and what stands before its beginning, as words' fingerprints.
END, BEGIN = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)

BLOCKS = "block long, n int, ids binary, named binary, held binary, lengths binary, words binary, codes binary"
SENT = "`order` int, bucket int, block long, keys binary, counts binary"
COUNTED = "kind string, `order` int, bucket int, block long, keys binary, counts binary, own binary, tally array<long>"
SUMMED = "bucket int, block long, keys binary, counts binary, freed binary, left binary"
WEIGHED = "kind string, `order` int, bucket int, block long, keys binary, total binary, weight binary"
REPORT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA24BAED4963EE407)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte of all of them, compressed: the upper bytes of small ones cost nothing."""
    return squeezed(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = opened(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Rising keys by their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def doubles(data: bytes) -> np.ndarray:
    return opened(data, "<f8")


def longer(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of histories with one more word."""
    return B.mix(history * _LEFT + (word ^ (word >> np.uint64(30))) * _RIGHT)


@dataclass
class Level:
    """The n-grams of one order in a block: distinct keys, and for each token which of them it ends."""

    keys: np.ndarray
    of_token: np.ndarray


class Block:
    """A block's tokens as keys of words, n-grams and histories."""

    def __init__(self, row: dict):
        self.n = row["n"]
        self.lengths = unpacked(row["lengths"]).astype(np.int64)
        self.held = opened(row["held"], np.bool_)
        self.words = unpacked_keys(row["words"])
        codes = unpacked(row["codes"]).astype(np.int64)
        ranked, codes = self.words[codes[: len(self.words)]], codes[len(self.words) :]
        self.last = np.cumsum(self.lengths) - 1
        word = np.empty(int(self.lengths.sum()), np.uint64)
        inside = np.ones(len(word), bool)
        inside[self.last] = False
        word[inside], word[self.last] = ranked[codes], END
        self.word, self.doc = word, np.repeat(np.arange(self.n), self.lengths)
        self.learned = ~self.held[self.doc]

    def _before(self, keys: np.ndarray, first: np.uint64) -> np.ndarray:
        """For each token the key of the token before; `first` at a document's beginning."""
        out = np.empty_like(keys)
        out[1:] = keys[:-1]
        out[self.last - self.lengths + 1] = first
        return out

    def histories(self, order: int) -> np.ndarray:
        """Keys of the order - 1 words before each token."""
        keys, first = self.word, BEGIN
        for _ in range(order - 2):
            keys = longer(self._before(keys, first), self.word)
            first = longer(np.array([first]), np.array([BEGIN]))[0]
        return self._before(keys, first)

    def level(self, order: int) -> Level:
        keys = self.word if order == 1 else longer(self.histories(order), self.word)
        return Level(*np.unique(keys, return_inverse=True))

    def past(self, order: int) -> Level:
        return Level(*np.unique(self.histories(order), return_inverse=True))


def tokens_of(part: pa.Table) -> dict[str, object]:
    """A block's row. codes: the words' places in `words` by falling frequency, then every word as its rank in that list."""
    ids = part.column("doc_id").to_pylist()
    keys, counts = [], []
    for piece in B.slices([part], "text"):
        buf, off = B.utf8(piece.column("text"))
        starts, ends, first = B.word_bounds(buf, off, ~B.SPACE[buf])
        keys.append(B.span_hashes(B.ASCII_LOWER[buf], starts, ends))
        counts.append(np.diff(first))
    words, at, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True, return_counts=True)
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    named = np.array([i is not None for i in ids], bool)
    return {
        "n": len(ids), "ids": packed(np.array([i or 0 for i in ids], np.int64)), "named": squeezed(named.tobytes()), "held": squeezed(np.array([held_out(i) for i in ids], bool).tobytes()),
        "lengths": packed(np.concatenate([np.zeros(0, np.int64), *counts]) + 1), "words": packed_keys(words), "codes": packed(np.concatenate([order, rank[at]])),
    }


def tokenised(docs: DataFrame) -> DataFrame:
    """The blocks: one row each. Store them before use: block numbers are a task's, and hold for one run of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, part in enumerate(gathered(batches, BLOCK_BYTES, BLOCK_DOCS)):
            yield pa.RecordBatch.from_pylist([{"block": task + k, **tokens_of(part)}], _BLOCK_SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCKS)


_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "named", "held", "lengths", "words", "codes"))])


def ranges(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of rising keys; a bucket is one value of the upper bits."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return list(zip(bucket[begin].tolist(), begin.tolist(), np.append(begin[1:], len(keys)).tolist(), strict=True))


def send_counts(row: dict, order: int, bits: int) -> Iterator[dict]:
    """Each distinct n-gram of a block with its count in what is learned from."""
    block = Block(row)
    for n in range(1, order + 1):
        level = block.level(n)
        counts = np.bincount(level.of_token, block.learned, minlength=len(level.keys)).astype(np.int64)
        for bucket, a, b in ranges(level.keys, bits):
            yield {"order": n, "bucket": bucket, "block": row["block"], "keys": packed_keys(level.keys[a:b]), "counts": packed(counts[a:b])}


def _cut(parts: list[np.ndarray], values: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum([len(p) for p in parts])[:-1])


def merge_counts(table: pa.Table) -> pa.Table:
    """A bucket: totals to every block that sent an n-gram, one owner each, and the bucket's own table with its counts of counts."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    parts, counts = [unpacked_keys(r["keys"]) for r in rows], np.concatenate([unpacked(r["counts"]) for r in rows]).astype(np.int64)
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(at, counts, minlength=len(keys)).astype(np.int64)
    owner = np.full(len(keys), len(at))
    np.minimum.at(owner, at, np.where(counts > 0, np.arange(len(at)), len(at)))
    own = owner[at] == np.arange(len(at))
    seen = total > 0
    tally = np.bincount(np.minimum(total[seen], DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist() + [int(seen.sum()), int(total.sum())]
    same = {"order": rows[0]["order"], "bucket": rows[0]["bucket"]}
    out = [{"kind": "reply", **same, "block": r["block"], "counts": packed(c), "own": squeezed(np.packbits(o).tobytes())} for r, c, o in zip(rows, _cut(parts, total[at]), _cut(parts, own), strict=True)]
    return pa.Table.from_pylist([*out, {"kind": "table", **same, "keys": packed_keys(keys[seen]), "counts": packed(total[seen]), "tally": tally}], _COUNTED_SCHEMA)


_COUNTED_SCHEMA = pa.schema([("kind", pa.string()), ("order", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("own", pa.binary()), ("tally", pa.list_(pa.int64()))])


def discounts(tally: list[int]) -> np.ndarray:
    """d(0) to d(DISCOUNTED + 1) by Good-Turing, from the number of n-grams seen once, twice and so on; the last is 1."""
    out = np.ones(DISCOUNTED + 2)
    for top in range(DISCOUNTED, 0, -1):
        if all(tally[: top + 1]):
            rest = (top + 1) * tally[top] / tally[0]
            made = [((r + 1) * tally[r] / (r * tally[r - 1]) - rest) / (1 - rest) if rest < 1 else 0.0 for r in range(1, top + 1)]
            if all(0 < d < 1 for d in made):
                out[1 : top + 1] = made
                return out
    out[1] = 0.5
    return out


@dataclass
class Order:
    """What all n-grams of one order have in common."""

    discount: np.ndarray
    distinct: int
    total: int

    def kept(self, counts: np.ndarray) -> np.ndarray:
        """Counts after discounting."""
        return self.discount[np.minimum(counts, DISCOUNTED + 1)] * counts

    def freed(self, counts: np.ndarray) -> np.ndarray:
        return (1 - self.discount[np.minimum(counts, DISCOUNTED + 1)]) * counts


def singles(order: Order, tally: list[int]) -> tuple[float, float]:
    """The divisor of single words' counts, and the unknown word's probability."""
    if not order.total:
        return 1.0, 1.0
    freed = float(order.freed(np.arange(1, DISCOUNTED + 1)) @ np.array(tally[:DISCOUNTED], float))
    divisor = order.total if freed > 0 else order.total + 1
    return float(divisor), (freed if freed > 0 else 1.0) / divisor


class Told:
    """A block with what the buckets have told it so far."""

    def __init__(self, row: dict, replies: pa.Table, orders: list[Order], single: tuple[float, float]):
        self.block, self.orders, self.single = Block(row), orders, single
        by: dict[tuple[str, int], list[dict]] = {}
        for r in replies.to_pylist():
            by.setdefault((r["kind"], r["order"]), []).append(r)
        self.rows = {k: sorted(v, key=lambda r: r["bucket"]) for k, v in by.items()}

    def counts(self, n: int) -> tuple[Level, np.ndarray, np.ndarray]:
        """The distinct n-grams, their totals, and which of them the block owns."""
        rows = self.rows["reply", n]
        parts = [unpacked(r["counts"]).astype(np.int64) for r in rows]
        own = [np.unpackbits(opened(r["own"], np.uint8), count=len(p)).astype(bool) for r, p in zip(rows, parts, strict=True)]
        return self.block.level(n), np.concatenate(parts), np.concatenate(own)

    def weights(self, n: int) -> tuple[Level, np.ndarray, np.ndarray]:
        """The distinct histories of n-grams, C of each (0 if never seen), and a."""
        rows = self.rows["weight", n]
        return self.block.past(n), np.concatenate([doubles(r["total"]) for r in rows]), np.concatenate([doubles(r["weight"]) for r in rows])

    def probability(self, n: int) -> np.ndarray:
        """Of each token after the n - 1 words before it."""
        level, counts, _ = self.counts(n)
        kept = self.orders[n - 1].kept(counts)
        if n == 1:
            return np.where(counts > 0, kept / self.single[0], self.single[1])[level.of_token]
        past, total, weight = self.weights(n)
        total, weight = total[past.of_token], weight[past.of_token]
        seen = counts[level.of_token] > 0
        out = weight * self.probability(n - 1)
        out[seen] = kept[level.of_token[seen]] / total[seen]
        return out

    def sums(self, n: int, number: int, bits: int) -> Iterator[dict]:
        """For each history of n-grams: words seen after it, mass freed, and the shorter history's share of them, over n-grams owned."""
        level, counts, own = self.counts(n)
        past, lower = self.block.past(n), self.probability(n - 1)
        one = np.empty(len(level.keys), np.int64)
        one[level.of_token] = np.arange(len(level.of_token))  # any token that ends the n-gram
        mine = np.flatnonzero(own)
        at = past.of_token[one[mine]]
        total, freed, left = (np.bincount(at, x, minlength=len(past.keys)) for x in (counts[mine], self.orders[n - 1].freed(counts[mine]), lower[one[mine]]))
        for bucket, a, b in ranges(past.keys, bits):
            yield {"bucket": bucket, "block": number, "keys": packed_keys(past.keys[a:b]), "counts": packed(total[a:b].astype(np.int64)), "freed": squeezed(freed[a:b].tobytes()), "left": squeezed(left[a:b].tobytes())}

    def scores(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A document's known tokens, base score and score."""
        level, counts, _ = self.counts(1)
        known, one = counts[level.of_token], self.orders[0]
        base = np.log10((known + 1) / (one.total + one.distinct + 1))
        over = lambda x: np.bincount(self.block.doc, x, minlength=self.block.n)
        return over(known > 0).astype(np.int64), over(base), over(np.log10(self.probability(order)))


def merge_sums(table: pa.Table, order: int) -> pa.Table:
    """A bucket: C and a of its histories, to every block that has them, and as its own table."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    parts = [unpacked_keys(r["keys"]) for r in rows]
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    total, freed, left = (np.bincount(at, np.concatenate([read(r[c]) for r in rows]), minlength=len(keys)) for c, read in (("counts", unpacked), ("freed", doubles), ("left", doubles)))
    seen, free = total > 0, freed > 0
    mass = np.where(free, freed, 1.0)
    total = np.where(seen & ~free, total + 1, total)
    weight = np.ones(len(keys))
    weight[seen] = mass[seen] / total[seen] / (1 - left[seen])
    same = {"order": order, "bucket": rows[0]["bucket"]}
    out = [{"kind": "weight", **same, "block": r["block"], "total": squeezed(t.tobytes()), "weight": squeezed(w.tobytes())} for r, t, w in zip(rows, _cut(parts, total[at]), _cut(parts, weight[at]), strict=True)]
    own = {"kind": "table", **same, "keys": packed_keys(keys[seen]), "total": squeezed(total[seen].tobytes()), "weight": squeezed(weight[seen].tobytes())}
    return pa.Table.from_pylist([*out, own], _WEIGHED_SCHEMA)


_WEIGHED_SCHEMA = pa.schema([("kind", pa.string()), ("order", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("total", pa.binary()), ("weight", pa.binary())])


def _rows(make: Callable[[dict], Iterator[dict]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that reads blocks one by one, and puts out each one's rows as a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for made in make(batch.slice(k, 1).to_pylist()[0]):
                    yield pa.RecordBatch.from_pylist([made], schema)

    return run


_SENT_SCHEMA = pa.schema([("order", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SUMMED_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("freed", pa.binary()), ("left", pa.binary())])


def partitioned(df: DataFrame, path: str) -> DataFrame:
    """Write a table by kind and order, and read it again. The exchange behind it is not needed any more, so Spark may delete its files."""
    spark, name = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        df.write.partitionBy("kind", "order").parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


@dataclass
class Model:
    """counts: (order, bucket, keys, counts); weights: (order, bucket, keys, total, weight); a row a bucket."""

    orders: list[Order]
    single: tuple[float, float]
    counts: DataFrame
    weights: DataFrame | None


def model_and_scores(docs: DataFrame, order: int = ORDER) -> tuple[Model, DataFrame]:
    """The model learned from the documents that are not held out, and the report on all documents."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/katz-{uuid.uuid4().hex}"
    bits = max(1, (text_bytes(docs) // BUCKET_BYTES).bit_length())
    blocks = stored(tokenised(docs))
    sent = blocks.mapInArrow(_rows(lambda row: send_counts(row, order, bits), _SENT_SCHEMA), SENT)
    counted = partitioned(sent.groupBy("order", "bucket").applyInArrow(lambda t: merge_counts(t), COUNTED), f"{folder}/counts")
    table = counted.where("kind = 'table'")
    sums = table.groupBy("order").agg(*[F.sum(F.col("tally")[k]).alias(f"t{k}") for k in range(DISCOUNTED + 3)])
    tallies = {r["order"]: list(r)[1:] for r in sums.collect()}  # a row an order
    tallies = [tallies.get(n, [0] * (DISCOUNTED + 3)) for n in range(1, order + 1)]
    orders = [Order(discounts(t[: DISCOUNTED + 1]), t[-2], t[-1]) for t in tallies]
    single = singles(orders[0], tallies[0])
    replies = counted.where("kind = 'reply'").select("kind", "order", "bucket", "block", "counts", "own", F.lit(None).cast("binary").alias("total"), F.lit(None).cast("binary").alias("weight"))
    weights = None

    def sending(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            return pa.Table.from_pylist(list(Told(row, right, orders, single).sums(n, row["block"], bits)), _SUMMED_SCHEMA)

        return send

    def merging(n: int) -> Callable[[pa.Table], pa.Table]:
        return lambda t: merge_sums(t, n)

    for n in range(2, order + 1):
        summed = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(sending(n), SUMMED)
        made = partitioned(summed.groupBy("bucket").applyInArrow(merging(n), WEIGHED), f"{folder}/weights-{n}")
        told = made.where("kind = 'weight'").select("kind", "order", "bucket", "block", F.lit(None).cast("binary").alias("counts"), F.lit(None).cast("binary").alias("own"), "total", "weight")
        replies = replies.unionByName(told)
        weights = made if weights is None else weights.unionByName(made)

    def report(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        told = Told(row, right, orders, single)
        known, base, score = told.scores(order)
        ids = pa.array(unpacked(row["ids"]).astype(np.int64), mask=~opened(row["named"], np.bool_))
        columns = [ids, pa.array(told.block.held), pa.array(told.block.lengths), pa.array(known), pa.array(np.full(row["n"], orders[0].total)), pa.array(base), pa.array(score)]
        return pa.table(columns, names=[c.split()[0] for c in REPORT.split(", ")])

    scores = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(report, REPORT)
    pick = lambda t, *c: t.where("kind = 'table'").select("order", "bucket", *c)
    return Model(orders, single, pick(counted, "keys", "counts"), None if weights is None else pick(weights, "keys", "total", "weight")), scores


def score_report(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """One row a document: its tokens, how many are known, and its log10 probability under single smoothed counts and under the model."""
    return model_and_scores(docs, order)[1]
