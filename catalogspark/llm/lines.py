"""Fuzzy line dedup by MinHash.

1. Each distinct line that holds a word is known by a 64-bit key. Its set is its
   distinct runs of SHINGLE characters (a shorter line is one run), and its
   signature the minima of BANDS * ROWS hash functions over the set.
2. Banding: lines that agree on all ROWS minima of a band are candidates. At the
   threshold of 0.8 a pair is missed with a chance of (1 - 0.8**3)**14, or 4 in
   100,000, and less above it. Band keys travel packed; only keys that two
   different lines share become rows.
3. Exact Jaccard on the lines' characters decides: each list's hub with all its
   members, then in tiles those that the hubs leave apart (see linking.py).
4. Distributed union-find joins the links, and of each component the line that
   comes first by (document, line number) stays.

Defined cases: null and empty texts have no lines; blank lines (white space only)
stay and match nothing; lines of any length are read whole; in the report, rows
that share an id share their line places; rows without an id come last; an empty
table gives an empty result. `drop_repeats` decides for each row by its own text,
also where rows share an id or have none (equal rows of one id are one document);
other columns of the input pass through it untouched, whatever their names, but
that names with two leading underscores are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm import exchange as X
from catalogspark.llm.common import NO_ID, keyed_rows, release, small_side, stored, text_bytes
from catalogspark.llm.linking import linked

SHINGLE = 8
PERCENT = 80
ROWS = 3
BANDS = 14
#: Bytes of text whose lines make a chunk of the band exchange.
CHUNK_BYTES = 2_800_000
#: Lines that a task remembers so as not to sign them twice, and rows that it merges before it sends them.
SEEN = 200_000
#: Characters hashed at a time: the hash functions run over arrays that stay in cache.
SIGN_CHARS = 1 << 15

_rng = np.random.default_rng(977)
_MULTIPLY = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def line_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all \\n-split lines: begins, ends, document, number in it, and whether it holds a word."""
    breaks = np.flatnonzero(buf == 10)
    doc_of = np.searchsorted(off, breaks, side="right") - 1
    begins = np.concatenate([off[:-1], breaks + 1])
    docs = np.concatenate([np.arange(len(off) - 1), doc_of])
    order = np.lexsort((begins, docs))
    begins, docs = begins[order], docs[order]
    ends = np.empty_like(begins)
    ends[:-1] = np.where(docs[1:] == docs[:-1], begins[1:] - 1, off[docs[:-1] + 1]) if len(begins) else 0
    if len(begins):
        ends[-1] = off[docs[-1] + 1]
    number = np.arange(len(docs)) - np.searchsorted(docs, docs)
    solid = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(~B.SPACE[buf], out=solid[1:])
    return begins, ends, docs, number, solid[ends] > solid[begins]


def _runs(lines: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of characters under U+0100 are hashed as so many bytes; runs with others, and lines shorter than a run, as code points."""
    joined = b"".join(lines)
    done = np.cumsum(np.array([0, *map(len, lines)]))
    if joined.isascii():
        codes = None
        low = np.frombuffer(joined, np.uint8)
    else:
        buf = np.frombuffer(joined, np.uint8)
        done = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[done]
        codes = np.frombuffer(joined.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        low = codes.astype(np.uint8)
    size = np.diff(done)
    # Every character begins a run but the last ones of a line; a shorter line is one run.
    keep = np.ones(len(low), bool)
    for k in range(1, width):
        keep[np.maximum(done[1:] - k, done[:-1] + 1)[size > 1]] = False
    bounds = np.concatenate([[0], np.cumsum(np.maximum(size - width + 1, 1))])
    eight = B.eight_hashes(low)
    out = np.zeros(len(low), np.uint64)
    out[: len(eight)] = eight
    out = out[keep]
    other = np.flatnonzero(size < width)
    spans = [(bounds[other], done[other], done[other + 1])]
    if codes is not None and (wide := np.concatenate([[0], np.cumsum(codes > 255)]))[-1]:
        begin = np.flatnonzero(keep)
        some = np.flatnonzero(wide[np.minimum(begin + width, len(low))] > wide[begin])
        some = some[~np.isin(some, bounds[other])]
        spans.append((some, begin[some], begin[some] + width))
    for at, first, last in spans:
        if len(at):
            data = (codes if codes is not None else low.astype(np.uint32)).view(np.uint8)
            out[at] = B.span_hashes(data, 4 * first, 4 * last, seed=2)
    return out, bounds


def char_shingles(lines: list[bytes], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each line's character runs, repeats included, and where each line's begin (n + 1). Some lines at a time, so that arrays stay in cache."""
    parts = [_runs(lines[a:b], width) for a, b in _some(lines)]
    if len(parts) == 1:
        return parts[0]
    shift = np.cumsum([0, *(len(x) for x, _ in parts)])
    return np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in parts)]), np.concatenate([[0], *(b[1:] + s for (_, b), s in zip(parts, shift[:-1], strict=True))]).astype(np.int64)


def signatures(lines: list[bytes]) -> np.ndarray:
    """One band key a line and band."""
    grams, bounds = char_shingles(lines)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    least, work = np.empty((BANDS * ROWS, len(lines)), np.uint32), np.empty_like(low)
    for j in range(BANDS * ROWS):
        np.bitwise_xor(low, _FLIP[j], out=work)
        np.multiply(work, _MULTIPLY[j], out=work)
        np.minimum.reduceat(work, bounds[:-1], out=least[j])
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(lines), axis=1)
    for row in range(ROWS):
        keys = B.mix((keys << np.uint64(1)) ^ least[row::ROWS])
    return np.ascontiguousarray(keys.T)


def _some(lines: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of lines with about SIGN_CHARS bytes."""
    begin = total = 0
    for i, x in enumerate(lines):
        total += len(x)
        if total >= SIGN_CHARS:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(lines):
        yield begin, len(lines)


class Merger:
    """Rows (key, twin, id, line, again, bands) of a task, one a key, as long as they are held.

    A full table is sent, but for the quarter of it with the keys that came most
    often: a line that stands everywhere is so one row a task, and not one a block.
    """

    def __init__(self, bands: int, rows: int = SEEN):
        self.rows, self.width = rows, bands
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.signed: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, twins: np.ndarray, ids: np.ndarray, line: np.ndarray, again: np.ndarray, fresh: np.ndarray, bands: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take a block's rows in; bands belong to the fresh ones, in order."""
        before = sum(map(len, self.signed))
        at = np.where(fresh, before + np.cumsum(fresh) - 1, -1)
        self.parts.append((keys, twins, ids, line, again, at, np.ones(len(keys), np.int64)))
        self.signed.append(bands)
        self.held += len(keys)
        if self.held >= self.rows:
            yield self.send(self.rows // 4)

    def send(self, hold: int = 0) -> pa.RecordBatch:
        """One row a key, but for `hold` keys that came in several blocks, the most frequent ones."""
        kinds = (np.uint64, np.uint64, np.int64, np.int64, bool, np.int64, np.int64)
        keys, twins, ids, line, again, at, times = (np.concatenate([np.zeros(0, k), *(p[i] for p in self.parts)]) for i, k in enumerate(kinds))
        signed = np.concatenate([np.zeros((0, self.width), np.uint8), *self.signed])
        order = np.lexsort((line, ids, keys))
        begin = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(order) else order
        one = order[begin]
        if len(one):
            again, at, times = np.logical_or.reduceat(again[order], begin), np.maximum.reduceat(at[order], begin), np.add.reduceat(times[order], begin)
            again |= times > 1
        keys, twins, ids, line = keys[one], twins[one], ids[one], line[one]
        most = np.argsort(-times, kind="stable")[:hold]
        most = most[times[most] > 1]
        stay = np.zeros(len(keys), bool)
        stay[most] = True
        own = stay & (at >= 0)
        kept_at = np.where(own, np.cumsum(own) - 1, -1)
        # What is held begins to count anew, so that a key that comes no more goes next time.
        self.parts = [(keys[stay], twins[stay], ids[stay], line[stay], again[stay], kept_at[stay], np.ones(int(stay.sum()), np.int64))]
        self.signed = [signed[at[own]]]
        self.held = int(stay.sum())
        go = ~stay
        bands = [signed[i].tobytes() if i >= 0 else None for i in at[go].tolist()]
        values = (keys[go].view(np.int64), twins[go].view(np.int64), ids[go], line[go], again[go])
        return pa.RecordBatch.from_arrays([*map(pa.array, values), pa.array(bands, pa.binary())], names=["key", "twin", "doc_id", "line", "again", "bands"])


def signed_lines(docs: DataFrame, width: int) -> DataFrame:
    """(key, twin, doc_id, line, again, bands): each distinct line of a task, with its first place there and whether it has others.

    Beyond SEEN distinct lines, only the frequent ones are merged over the whole
    task. twin is a second fingerprint; bands are given about once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        merger = Merger(BANDS * width)
        for part in B.slices(batches, "text"):
            buf, off = B.utf8(part.column("text"))
            begins, ends, doc, number, wordy = line_bounds(buf, off)
            ids = part.column("doc_id").to_numpy()
            at = np.flatnonzero(wordy)
            keys = B.span_hashes(buf, begins[at], ends[at])
            order = np.lexsort((number[at], ids[doc[at]], keys))
            begin = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(order) else order
            again = np.diff(np.append(begin, len(order))) > 1
            keys, at = keys[order[begin]], at[order[begin]]
            fresh = np.array([k not in seen for k in keys.tolist()], bool)
            if len(seen) > SEEN:
                seen.clear()
            seen.update(keys[fresh].tolist())
            data = buf.tobytes()
            new = np.flatnonzero(fresh)
            lines = [data[a:b] for a, b in zip(begins[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
            bands = [X.to_bytes(X.narrow(signatures(lines[a:b]), width).ravel(), width).reshape(b - a, -1) for a, b in _some(lines)]
            twins = B.span_hashes(buf, begins[at], ends[at], seed=1)
            yield from merger.add(keys, twins, ids[doc[at]], number[at], again, fresh, np.concatenate([np.zeros((0, BANDS * width), np.uint8), *bands]))
        yield merger.send()

    return _slim(docs).mapInArrow(run, "key long, twin long, doc_id long, line long, again boolean, bands binary")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")


def _distinct(table: pa.Table) -> pa.Table:
    """One signed row for each key of a chunk."""
    table = table.filter(pc.is_valid(table.column("bands")))
    _, first = np.unique(table.column("key").to_numpy(), return_index=True)
    return table.take(pa.array(first))


def _send_bands(chunk: int, table: pa.Table, buckets: int, width: int) -> pa.Table:
    values, counts = np.unique(X.unpack_keys(_distinct(table), width, "bands")[0], return_counts=True)
    bucket = (values % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    packed = X.by_bucket(bucket[order], {"keys": X.to_bytes(values[order], width), "several": (counts > 1)[order]})
    return pa.table({"bucket": pa.array(packed["bucket"], pa.int32()), "chunk": pa.array([chunk] * len(packed["keys"]), pa.int32()), "keys": pa.array(packed["keys"], pa.binary()), "several": pa.array(packed["several"], pa.binary())})


LISTED = "value long, key long, twin long, doc_id long, line long"


def _list_bands(table: pa.Table, replies: pa.Table, width: int) -> pa.Table:
    """A row (value, key) for each shared band; and one without a value, with the first place, for each line that stands in several places or is listed."""
    known = np.sort(X.unpack_keys(replies, width)[0])
    one = _distinct(table)
    bands, row = X.unpack_keys(one, width, "bands")
    use = B.find(known, bands)[1]
    listed = one.column("key").to_numpy()[row[use]]
    lists = pa.table({"value": pa.array(bands[use].view(np.int64)), "key": pa.array(listed)})
    keys, twins, ids, line, again = (table.column(c).to_numpy() for c in ("key", "twin", "doc_id", "line", "again"))
    order = np.lexsort((line, ids, keys))
    begin = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]])) if len(keys) else order
    many = np.diff(np.append(begin, len(keys))) > 1
    many |= np.logical_or.reduceat(again[order], begin) if len(keys) else many
    at = order[begin]
    at = at[many | B.find(np.unique(listed), keys[at])[1]]
    places = pa.table({"key": pa.array(keys[at]), "twin": pa.array(twins[at]), "doc_id": pa.array(ids[at]), "line": pa.array(line[at])})
    return pa.concat_tables([lists, places], promote_options="default").select(["value", "key", "twin", "doc_id", "line"])


def listed_lines(signed: DataFrame, chunks: int, width: int) -> DataFrame:
    """LISTED rows: band keys that at least two different lines share, with the lines' keys; and the first place of lines that are listed or stand in several places."""
    buckets = max(1, chunks // 4)
    dealt = signed.groupBy("chunk")
    sent = dealt.applyInArrow(lambda key, t: _send_bands(key[0].as_py(), t, buckets, width), X.SENT)
    shared = sent.groupBy("bucket").applyInArrow(lambda t: X.find_repeats(t, width), X.REPEATED)
    return dealt.cogroup(shared.groupBy("chunk")).applyInArrow(lambda l, r: _list_bands(l, r, width), LISTED)


def line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, line_text) of the wanted (doc_id, line) places: only their documents leave the scan where they are few."""
    by_doc = stored(wanted.groupBy("doc_id").agg(F.collect_set("line").alias("wanted")))  # bounded by one document's lines
    n, places = by_doc.agg(F.count(F.lit(1)), F.sum(F.size("wanted"))).first()
    # The bound's rows have some 60 bytes; a line number has 8.
    rows = _slim(docs).join(small_side(by_doc, n + 8 * (places or 0) // 60), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, "text"):
            buf, off = B.utf8(part.column("text"))
            begins, ends, doc, number, wordy = line_bounds(buf, off)
            lists = part.column("wanted").combine_chunks()
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            width = np.int64(int(number.max()) + 2)
            asked = np.repeat(np.arange(len(sizes)), sizes) * width + np.minimum(lists.flatten().to_numpy(), width - 1)
            use = np.flatnonzero(wordy & np.isin(doc * width + number, asked))
            data = buf.tobytes()
            keys = B.span_hashes(buf, begins[use], ends[use]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([data[a:b] for a, b in zip(begins[use].tolist(), ends[use].tolist(), strict=True)], pa.binary())], names=["key", "line_text"])

    out = rows.mapInArrow(run, "key long, line_text binary")
    out._behind = (by_doc,)
    return out


def _sets(bodies: list[bytes]) -> list[np.ndarray]:
    """The distinct run hashes of each line, in order."""
    grams, bounds = char_shingles(bodies)
    cuts = bounds.tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[bounds[:-1]] = True
    at = np.concatenate([[0], np.cumsum(new)])[bounds].tolist()
    grams = grams[new]
    return [grams[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def bodies(docs: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, body): the text of each wanted line."""
    asked = stored(places.join(wanted.withColumnRenamed("rep", "key"), "key").select("key", "doc_id", "line"))
    texts = line_texts(docs, asked)
    out = texts.join(asked.select("key"), "key", "left_semi").dropDuplicates(["key"]).toDF("rep", "body")
    out._behind = (asked, *texts._behind)
    return out


def line_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, line, key, twin) of every line that holds a word; of keyed rows, with their `__row`."""
    rows = docs.select(F.col("__id").alias("doc_id"), "text", "__row") if "__row" in docs.columns else _slim(docs)
    passed = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, "text"):
            buf, off = B.utf8(part.column("text"))
            begins, ends, doc, number, wordy = line_bounds(buf, off)
            at = np.flatnonzero(wordy)
            own = [pa.array(part.column(c).to_numpy()[doc[at]]) for c in passed]
            keys = [pa.array(B.span_hashes(buf, begins[at], ends[at], seed).view(np.int64)) for seed in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(number[at]), *keys], names=[*passed, "line", "key", "twin"])

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*passed, "line", "key", "twin"]))


def line_homes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, twin, component, kept_doc_id, kept_line), stored: a line's component (null where it is alone) and where that one's first line stands.

    A line that stands in one place and is listed with no other has no row.
    """
    # Sized from bytes, so that a chunk's distinct lines are bounded whatever the documents' lengths.
    chunks = max(1, -(-text_bytes(docs) // CHUNK_BYTES))
    width = X.key_bytes(chunks)
    signed = signed_lines(docs, width).withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int"))
    listed = stored(listed_lines(signed, chunks, width))
    lists = listed.where("value is not null").select("value", F.col("key").alias("rep"))
    places = listed.where("value is null").drop("value")
    parts = linked(lists, lambda wanted: bodies(docs, places, wanted), _sets, percent)
    grouped = places.join(parts.withColumnRenamed("node", "key"), "key")
    firsts = grouped.groupBy("component").agg(F.min(F.struct("doc_id", "line")).alias("p"))
    homes = grouped.select("key", "component").join(firsts, "component")
    out = stored(places.join(homes, "key", "left").select("key", "twin", "component", F.coalesce("p.doc_id", "doc_id").alias("kept_doc_id"), F.coalesce("p.line", "line").alias("kept_line")))
    release(listed, parts)
    return out


def _judged(keys: DataFrame, homes: DataFrame) -> DataFrame:
    """A line goes only if its second fingerprint says too that it is the line that was judged. Lines without a home are their own."""
    met = keys.join(small_side(homes.withColumnRenamed("twin", "_twin"), homes.count()), "key", "left")
    same = F.col("twin") == F.col("_twin")
    for c, own in (("kept_doc_id", "doc_id"), ("kept_line", "line")):
        met = met.withColumn(c, F.when(same, F.col(c)).otherwise(F.col(own)))
    return met.withColumn("kept", (F.col("doc_id") == F.col("kept_doc_id")) & (F.col("line") == F.col("kept_line"))).drop("twin", "_twin")


def judged_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, line, kept_doc_id, kept_line, kept of every line with a word: where its component's first line stands."""
    return _judged(line_keys(docs), line_homes(docs, percent)).drop("key", "component")


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The judged lines, with null for the ids of rows that have none."""
    out = judged_lines(docs, percent)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID))).withColumn("kept_doc_id", F.nullif("kept_doc_id", F.lit(NO_ID)))


def _later_rows(rows: DataFrame, homes: DataFrame) -> DataFrame | None:
    """(doc_id, __row, line) of the lines that stand at their component's first place, but in a later row of the same id."""
    ids = rows.groupBy(F.col("__id").alias("doc_id")).agg(F.min("__row").alias("a"), F.max("__row").alias("b"))
    shared = stored(ids.where("a < b").select(F.col("doc_id").alias("__id")))
    n = shared.count()
    if not n:
        return None
    keys = line_keys(rows.join(small_side(shared, n), "__id"))
    tied = _judged(keys, homes).where("kept")
    tied = stored(tied.select("doc_id", "__row", "line", F.coalesce("component", "key").alias("component")))
    first = tied.groupBy("component").agg(F.min("__row").alias("__first"))
    return tied.join(first, "component").where(F.col("__row") != F.col("__first")).select("doc_id", "__row", "line")


def drop_repeats(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with only the kept and the blank lines in `text`; every row stays."""
    rows = keyed_rows(docs)
    homes = line_homes(docs, percent)
    gone = _judged(line_keys(rows), homes).where("not kept").select("doc_id", "__row", "line")
    later = _later_rows(rows, homes)
    gone = gone if later is None else gone.union(later)
    lost = gone.groupBy(F.col("doc_id").alias("__id"), "__row").agg(F.collect_set(F.col("line").cast("int")).alias("__lost"))  # bounded by one document's lines
    joined = rows.join(lost, ["__id", "__row"], "left")
    split = F.split(F.col("text"), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "__lost")
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("__split"), i)), "\n")
    joined = joined.withColumn("__split", F.when(F.col("__lost").isNotNull(), split)).withColumn("__kept", kept)
    return joined.withColumn("text", F.coalesce("__kept", "text")).select(*docs.columns)
