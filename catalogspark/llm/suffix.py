"""Suffix-array dedup by column-wise Burrows-Wheeler construction.

A byte goes when a string of WINDOW bytes that covers it also starts in a
document with a smaller id.

1. Anchor: each window is assigned the GRAM-byte string in it with the smallest
   hash (leftmost on ties), which depends on the window's bytes alone. Windows
   next to each other mostly share it, so an anchor stands for a run of windows,
   and the context of the run is the bytes from its first start to its last end.
   An exchange of fingerprints finds the anchors of two documents or more, and
   how often each stands.
2. Deal: contexts of such anchors meet in the bucket of the anchor's hash, where
   equal contexts are one. An anchor that stands more than HOT times is split by
   more bytes: each of its windows is a context of its own, in the bucket of the
   window's hash, so that a phrase of a third of all documents fills no bucket.
3. Build: a bucket's contexts are laid out as a collection of short documents
   whose anchors stand in one column, and the collection's Burrows-Wheeler
   transform is built column by column from the right: a round inserts one symbol
   per document in front of every suffix, sorts the suffixes stably by it, and
   takes each new common prefix as one more than the least old one between the
   two. Columns are read and rounds are passed on one after another, so that a
   bucket needs its bytes once and the arrays of one round.
4. Scan: each round's suffixes are cut where the common prefix is under WINDOW;
   each piece is one string with all its windows, and its smallest document
   decides. The chunk that sent a context gets back one bit a window.

Why contexts: the plain construction takes one round a byte of the longest
document over the whole collection, each over all data, which no cluster does at
this scale. Matches of WINDOW bytes lie in contexts whole, so nothing is lost.
Why no files of its own: a bucket's sequential streams are its shuffled rows and
the rounds' arrays; executors share no local folder that such files could be in.

Null and empty texts have no bytes; texts are read whole; documents with equal
ids never remove from one another; rows without an id come after all others; an
empty table gives an empty result. Other columns of the input, whatever their
names, stay out of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm import exchange as X
from catalogspark.llm.common import NO_ID

WINDOW = 50
GRAM = 20
SPREAD = WINDOW - GRAM  # a run of windows starts at most so far before its anchor
COLUMNS = SPREAD + WINDOW + 1
#: Places of an anchor beyond which its windows are dealt out one by one.
HOT = 20_000

_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


def context_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, lefts: np.ndarray) -> np.ndarray:
    """Fingerprint of each context and of its anchor's place, as its sender took it; in pieces, so that memory stays small."""
    out = [np.zeros(0, np.uint64)]
    for i in range(0, len(starts), 4096):
        a, n = starts[i : i + 4096], sizes[i : i + 4096].astype(np.int64)
        part = data[a[0] : a[-1] + n[-1]]
        out.append(B.mix(B.span_hashes(part, a - a[0], a - a[0] + n) + lefts[i : i + 4096].astype(np.uint64)))
    return np.concatenate(out)


class Runs:
    """Runs of windows of a block by anchor: first and last start, anchor place, fingerprint and document."""

    def __init__(self, part: pa.Table):
        self.ids = part.column("doc_id").to_numpy()
        self.buf, self.off = B.utf8(part.column("text"))
        n = len(self.buf) - WINDOW + 1
        if n <= 0:
            self.first = self.last = self.anchor = self.doc = self.place = np.zeros(0, np.int64)
            self.gram = np.zeros(0, np.uint64)
            return
        grams = B.rolling_bytes(self.buf, GRAM)
        low = (grams & _HIGH) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= SPREAD + 1:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = SPREAD + 1 - width
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        place = (low & _LOW).astype(np.int64)
        for a, b in zip(self.off[:-1].tolist(), self.off[1:].tolist(), strict=True):
            place[max(a, b - WINDOW + 1) : b] = -1  # these windows would leave their document
        self.place = place
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        end = np.append(begin[1:], len(place)) - 1
        use = place[begin] >= 0
        self.first, self.last, self.anchor = begin[use], end[use], place[begin[use]]
        self.gram = grams[self.anchor]
        self.doc = np.searchsorted(self.off, self.first, side="right") - 1

    def contexts(self) -> np.ndarray:
        """Fingerprint of each run's context and of the anchor's place in it."""
        return B.mix(B.span_hashes(self.buf, self.first, self.last + WINDOW) + (self.anchor - self.first).astype(np.uint64))


    def window_keys(self, start: np.ndarray) -> np.ndarray:
        """Fingerprints of the windows that start there and of their anchors' places."""
        return B.mix(B.span_hashes(self.buf, start, start + WINDOW) + (self.place[start] - start).astype(np.uint64))

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, documents and fingerprints of all windows of some runs."""
        if not len(runs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        n = self.last[runs] - self.first[runs] + 1
        start = np.repeat(self.first[runs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return start, np.repeat(self.doc[runs], n), self.window_keys(start)


def chunk_grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    runs = [Runs(p) for p in B.slices([table], "text")]
    if not runs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([r.gram for r in runs]), np.concatenate([r.ids[r.doc] for r in runs])


def take_spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after another."""
    done = np.cumsum(lengths)
    return buf[np.repeat(starts - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)]


def send_grams(keys: np.ndarray, ids: np.ndarray, chunk: int, buckets: int, width: int) -> pa.Table:
    """First exchange, sending side: each distinct anchor, whether several documents have it, and how often it stands."""
    distinct, low, high, _ = X.smallest(X.narrow(keys, width), ids)
    count = np.bincount(B.find(distinct, X.narrow(keys, width))[0], minlength=len(distinct)) if len(keys) else np.zeros(0, np.int64)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    packed = X.by_bucket(bucket[order], {"keys": X.to_bytes(distinct[order], width), "several": (low < high)[order], "counts": np.minimum(count, 65535).astype(np.uint16)[order]})
    return pa.table({"bucket": pa.array(packed.pop("bucket"), pa.int32()), "chunk": pa.array([chunk] * len(packed["keys"]), pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in packed.items()})


def find_grams(table: pa.Table, width: int, hot: int) -> pa.Table:
    """First exchange, bucket side: tell every chunk which of its anchors stand in another document too, and which stand very often."""
    keys, rows = X.unpack_keys(table, width)
    several, counts = X.unpack(table, "several", np.bool_)[0], X.unpack(table, "counts", np.uint16)[0]
    distinct, back = np.unique(keys, return_inverse=True)
    hit = (np.bincount(back, minlength=len(distinct)) > 1)[back] | several if len(keys) else several
    often = (np.bincount(back, counts, len(distinct)) > hot)[back] if len(keys) else several
    return X.reply(table, rows[hit], {"keys": X.to_bytes(keys[hit], width), "often": often[hit]})


CONTEXTS = "bucket int, chunk int, ids binary, lefts binary, sizes binary, own binary, data binary"


def send_contexts(chunk: int, table: pa.Table, repeated: pa.Table, buckets: int, width: int = 8) -> pa.Table:
    """Each distinct context of the chunk's repeated anchors, with the chunk's smallest document; windows of their own for very frequent ones."""
    known, often = X.unpack_keys(repeated, width)[0], X.unpack(repeated, "often", np.bool_)[0]
    order = np.argsort(known)
    known, often = known[order], often[order]
    none = np.zeros(0, np.int64)
    fields: list[list[np.ndarray]] = [[none.astype(np.uint64), none, none.astype(np.uint64), none, none, none.astype(bool)]]
    spans: list[np.ndarray] = [np.zeros(0, np.uint8)]
    for part in B.slices([table], "text") if len(known) else ():
        r = Runs(part)
        at, found = B.find(known, X.narrow(r.gram, width))
        hot = found & often[at]
        use = np.flatnonzero(found & ~hot)
        size = r.last[use] - r.first[use] + WINDOW
        fields.append([r.contexts()[use], r.ids[r.doc[use]], r.gram[use], r.anchor[use] - r.first[use], size, np.zeros(len(use), bool)])
        spans.append(take_spans(r.buf, r.first[use], size))
        start, doc, keys = r.windows(np.flatnonzero(hot))
        fields.append([keys, r.ids[doc], keys, r.place[start] - start, np.full(len(start), WINDOW), np.ones(len(start), bool)])
        spans.append(take_spans(r.buf, start, np.full(len(start), WINDOW)))
    keys, ids, deal, left, size, own = (np.concatenate(x) for x in zip(*fields, strict=True))
    data, begin = np.concatenate(spans), np.cumsum(size) - size
    _, low, _, one = X.smallest(keys, ids)
    bucket = (deal[one] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    one = one[order]
    packed = X.by_bucket(bucket[order], {"ids": low[order], "lefts": left[one].astype(np.uint8), "sizes": size[one].astype(np.uint8), "own": own[one]}, size[one], take_spans(data, begin[one], size[one]).tobytes())
    return pa.table({"bucket": pa.array(packed.pop("bucket"), pa.int32()), "chunk": pa.array([chunk] * len(packed["ids"]), pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in packed.items()})


def _least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a+1 .. b]) for each pair a < b, from minima over runs of powers of two."""
    if not len(a):
        return np.zeros(0, values.dtype)
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    out = np.zeros(len(a), values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[a[at] + 1], table[b[at] - width + 1])
        table, width = np.minimum(table[:-width], table[width:]), 2 * width
    return out


def build_columns(columns: Iterator[np.ndarray], m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Column-wise construction over m rows: for each column of symbols, from the right, (transform, order, common).

    `transform` is the stretch of the Burrows-Wheeler transform that the round
    adds (the symbols in front of the suffixes so far, in their order), `order`
    the sorted suffixes that now begin with them, `common` their common prefixes
    with the suffix before.
    """
    order, common = np.arange(m), np.zeros(m, np.uint8)
    for j, symbols in enumerate(columns):
        inserted = symbols[order]
        at = np.argsort(inserted, kind="stable")
        sorted_symbols = inserted[at]
        equal = np.flatnonzero(sorted_symbols[1:] == sorted_symbols[:-1])
        fresh = np.zeros(m, np.uint8)
        fresh[equal + 1] = 1 + (_least_between(common, at[equal], at[equal + 1]) if j else 0)
        order, common = order[at], fresh
        yield inserted, order, common


def find_earlier(table: pa.Table) -> pa.Table:
    """A bucket's contexts: one bit a window, set where a smaller document than the sender's has it. Windows of their own are always answered."""
    ids, rows = X.unpack(table, "ids", np.int64)
    lefts, sizes = (X.unpack(table, name, np.uint8)[0] for name in ("lefts", "sizes"))
    own = X.unpack(table, "own", np.bool_)[0]
    data, _ = X.unpack(table, "data", np.uint8)
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    keys = context_keys(data, begin, sizes, lefts)
    distinct, low, _, one = X.smallest(keys, ids)
    back, _ = B.find(distinct, keys)
    m = len(distinct)
    left, size = lefts[one].astype(np.int64), sizes[one].astype(np.int64)
    matrix = np.zeros((COLUMNS, m), np.uint8)
    matrix[np.repeat(SPREAD - left - (np.cumsum(size) - size), size) + np.arange(size.sum()), np.repeat(np.arange(m), size)] = take_spans(data, begin[one], size)
    del data
    bits = np.zeros(len(keys), np.uint64)
    first, last = SPREAD - left, SPREAD - left + size - WINDOW
    for j, (_, order, common) in zip(range(COLUMNS - 1, -1, -1), build_columns(iter(matrix[::-1]), m), strict=True) if m else ():
        if j > SPREAD:
            continue
        here = (first <= j) & (j <= last)
        cuts = np.flatnonzero(common < WINDOW)
        least = np.minimum.reduceat(np.where(here, low, NO_ID)[order], cuts)
        best = np.empty(m, np.int64)
        best[order] = np.repeat(least, np.diff(np.append(cuts, m)))
        hit = np.flatnonzero(here[back] & (best[back] < ids))
        bits[hit] |= np.uint64(1) << (j - first[back[hit]]).astype(np.uint64)
    hit = (bits > 0) | own
    return X.reply(table, rows[hit], {"keys": keys[hit], "bits": bits[hit], "own": own[hit]})


def remove(table: pa.Table, earlier: pa.Table) -> pa.Table:
    """The result's rows of a chunk."""
    known, bits, own = (X.unpack(earlier, name, kind)[0] for name, kind in (("keys", np.uint64), ("bits", np.uint64), ("own", np.bool_)))
    order = np.argsort(known)
    known, bits, own = known[order], bits[order], own[order]
    alone, told = known[own], bits[own]
    known, bits = known[~own], bits[~own]
    runs = [Runs(p) for p in B.slices([table], "text")]
    marks = [r.contexts() if len(r.first) else np.zeros(0, np.uint64) for r in runs]
    owners = [r.ids[r.doc] for r in runs]
    keys, low, _, _ = X.smallest(np.concatenate(marks), np.concatenate(owners)) if runs else (np.zeros(0, np.uint64), np.zeros(0, np.int64), None, None)
    # Windows that were dealt out by themselves are all answered, so the first one of a run tells.
    single = [r.windows(np.flatnonzero(B.find(alone, r.window_keys(r.first))[1])) if len(alone) else None for r in runs]
    if len(alone):  # the chunk's smallest document of each
        at = [B.find(alone, w[2]) for w in single]
        least = np.full(len(alone), NO_ID)
        for r, w, (place, found) in zip(runs, single, at, strict=True):
            np.minimum.at(least, place[found], r.ids[w[1][found]])
    out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for i, (r, mark, owner) in enumerate(zip(runs, marks, owners, strict=True)):
        change = np.zeros(len(r.buf) + 1, np.int32)
        if len(alone) and len(mark):
            place, found = at[i]
            start = single[i][0][found & ((told[place] > 0) | (least[place] < r.ids[single[i][1]]))]
            np.add.at(change, start, 1)
            np.subtract.at(change, start + WINDOW, 1)
        if len(mark):
            whole = low[B.find(keys, mark)[0]] < owner
            where, found = B.find(known, mark)
            np.add.at(change, r.first[whole], 1)
            np.subtract.at(change, r.last[whole] + WINDOW, 1)
            some = np.flatnonzero(found & ~whole)
            for k in range(SPREAD + 1) if len(some) else ():
                start = r.first[some[(bits[where[some]] >> np.uint64(k)) & np.uint64(1) > 0]] + k
                np.add.at(change, start, 1)
                np.subtract.at(change, start + WINDOW, 1)
        gone = np.cumsum(change[:-1]) > 0
        lead = gone.copy()
        lead[1:] &= ~gone[:-1]
        inner = r.off[:-1][r.off[:-1] < r.off[1:]]
        lead[inner] = gone[inner]
        total, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, lead))
        n_removed = total[r.off[1:]] - total[r.off[:-1]]
        for d, (a, b, lost) in enumerate(zip(r.off[:-1].tolist(), r.off[1:].tolist(), n_removed.tolist(), strict=True)):
            kept = r.buf[a:b][~gone[a:b]] if lost else r.buf[a:b]
            out["kept_sha256"].append(hashlib.sha256(np.ascontiguousarray(kept)).hexdigest())
        out["doc_id"] += r.ids.tolist()
        out["n_bytes"] += np.diff(r.off).tolist()
        out["n_removed"] += n_removed.tolist()
        out["n_spans"] += (spans[r.off[1:]] - spans[r.off[:-1]]).tolist()
    return pa.table({k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()})


def dedup_bytes(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows, chunks = X.chunked(docs)
    buckets = max(1, chunks // 4)
    width = X.key_bytes(chunks)
    grams = rows.groupBy("chunk").applyInArrow(lambda key, t: send_grams(*chunk_grams(t), key[0].as_py(), buckets, width), X.SENT + ", counts binary")
    again = grams.groupBy("bucket").applyInArrow(lambda t: find_grams(t, width, hot), X.REPEATED + ", often binary")
    sent = rows.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(lambda key, l, r: send_contexts(key[0].as_py(), l, r, buckets, width), CONTEXTS)
    earlier = sent.groupBy("bucket").applyInArrow(lambda t: find_earlier(t), "chunk int, keys binary, bits binary, own binary")
    out = rows.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(lambda l, r: remove(l, r), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
