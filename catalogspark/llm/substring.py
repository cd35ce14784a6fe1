"""Substring dedup by difference-cover anchors.

A window is `window` consecutive words. Of each document, runs of ANCHOR words
are fingerprinted only where their position modulo PERIOD lies in a difference
cover: every difference of two positions modulo PERIOD is a difference of two
members, so however two equal windows are shifted, some run inside both starts at
a cover position of both.

1. Anchors that occur in two documents are found by an exchange of fingerprints.
2. Each such anchor is extended: all windows that hold it get two fingerprints of
   64 bits from different seeds, and a second exchange finds the smallest document
   of each pair of fingerprints.
3. Each chunk marks the words covered by a window that a smaller document has,
   and hashes the words that stay. Between chunks, both fingerprints must agree.

A document's words never meet another's. Null and empty texts have no words and
hash the empty string; texts are read whole; documents with equal ids never
remove from one another; rows without an id come after all others; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm import exchange as X
from catalogspark.llm.common import NO_ID

WINDOW = 50
PERIOD = 31
#: A perfect difference cover: each of 1..30 is the difference of one pair, modulo 31.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1

_AT_COVER = np.isin(np.arange(PERIOD), COVER)


class Words:
    """The words of a block: codes, their documents, and the documents' bounds."""

    def __init__(self, part: pa.Table):
        self.ids = part.column("doc_id").to_numpy()
        self.buf, self.off = B.utf8(part.column("text"))
        self.starts, self.ends, self.first = B.word_bounds(self.buf, self.off, ~B.SPACE[self.buf])
        self.codes = B.span_hashes(self.buf, self.starts, self.ends)
        self.doc = B.owners(self.first)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and fingerprints of all runs of `width` words inside one document."""
        grams = B.rolling_hashes(self.codes, width)
        at = np.flatnonzero(self.doc[: len(grams)] == self.doc[width - 1 :]) if len(grams) else np.zeros(0, np.int64)
        return at, grams[at]

    def twins(self, at: np.ndarray) -> np.ndarray:
        """Second fingerprints of the windows at the given places."""
        return B.rolling_hashes(B.span_hashes(self.buf, self.starts, self.ends, seed=1), WINDOW)[at] if len(at) else np.zeros(0, np.uint64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and fingerprints of the runs at cover positions, in documents that hold a window."""
        at, grams = self.windows(ANCHOR)
        doc = self.doc[at]
        use = _AT_COVER[(at - self.first[doc]) % PERIOD] & (np.diff(self.first)[doc] >= WINDOW)
        return at[use], grams[use]


def _joined(parts: list[tuple[np.ndarray, ...]], *kinds: type) -> tuple[np.ndarray, ...]:
    """The parts' columns, each as one array."""
    return tuple(np.concatenate([np.zeros(0, kind), *(p[i] for p in parts)]) for i, kind in enumerate(kinds))


def least_by(keys: np.ndarray, twins: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item the smallest id with its key and twin; and one place for each such pair, in order."""
    order = np.lexsort((ids, twins, keys))
    k, t = keys[order], twins[order]
    lead = np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])]) if len(k) else np.zeros(0, bool)
    begin = np.flatnonzero(lead)
    least = np.empty(len(keys), np.int64)
    least[order] = np.repeat(ids[order[begin]], np.diff(np.append(begin, len(keys))))
    return least, order[begin]


def chunk_anchors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for part in B.slices([table], "text"):
        w = Words(part)
        at, grams = w.anchors()
        out.append((grams, w.ids[w.doc[at]]))
    return _joined(out, np.uint64, np.int64)


def extend(chunk: int, table: pa.Table, repeated: pa.Table, buckets: int, width: int = 8) -> pa.Table:
    """The windows around the chunk's repeated anchors, each once, with the chunk's smallest document."""
    known = np.sort(X.unpack_keys(repeated, width)[0])
    out = []
    for part in B.slices([table], "text") if len(known) else ():
        w = Words(part)
        at, grams = w.anchors()
        at = at[B.find(known, X.narrow(grams, width))[1]]
        near = B.covered(np.maximum(at - (WINDOW - ANCHOR), 0), np.minimum(at, WINDOW - ANCHOR) + 1, len(w.codes))
        places, windows = w.windows(WINDOW)
        use = near[places]
        out.append((windows[use], w.twins(places[use]), w.ids[w.doc[places[use]]]))
    keys, twins, ids = _joined(out, np.uint64, np.uint64, np.int64)
    _, one = least_by(keys, twins, ids)
    bucket = (keys[one] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    one = one[order]
    packed = X.by_bucket(bucket[order], {"keys": keys[one], "twins": twins[one], "ids": ids[one]})
    return pa.table({"bucket": pa.array(packed.pop("bucket"), pa.int32()), "chunk": pa.array([chunk] * len(packed["keys"]), pa.int32())} | {k: pa.array(v, pa.binary()) for k, v in packed.items()})


def find_earlier(table: pa.Table) -> pa.Table:
    """Tell each chunk which of its windows stand in a document smaller than all of its own that have them."""
    keys, rows = X.unpack(table, "keys", np.uint64)
    twins, _ = X.unpack(table, "twins", np.uint64)
    ids, _ = X.unpack(table, "ids", np.int64)
    hit = least_by(keys, twins, ids)[0] < ids
    return X.reply(table, rows[hit], {"keys": keys[hit], "twins": twins[hit]})


def remove(table: pa.Table, earlier: pa.Table) -> pa.Table:
    """The result's rows of a chunk."""
    known, twins = X.unpack(earlier, "keys", np.uint64)[0], X.unpack(earlier, "twins", np.uint64)[0]
    order = np.argsort(known)
    known, twins = known[order], twins[order]
    parts = [Words(p) for p in B.slices([table], "text")]
    found = [w.windows(WINDOW) for w in parts]
    keys, low, _, _ = X.smallest(*_joined([(g, w.ids[w.doc[at]]) for w, (at, g) in zip(parts, found, strict=True)], np.uint64, np.int64))
    ids, n_words, n_removed, digests = [], [], [], []
    for w, (at, grams) in zip(parts, found, strict=True):
        hit = low[B.find(keys, grams)[0]] < w.ids[w.doc[at]] if len(grams) else np.zeros(0, bool)
        place, told = B.find(known, grams)
        told = np.flatnonzero(told)
        hit[told] |= w.twins(at[told]) == twins[place[told]]
        gone = B.covered(at[hit], WINDOW, len(w.codes))
        total = np.concatenate([[0], np.cumsum(gone)])
        data = w.buf.tobytes()
        first, off = w.first.tolist(), w.off.tolist()
        for d in range(len(w.ids)):
            a, b = first[d], first[d + 1]
            words = data[off[d] : off[d + 1]].split()
            lost = int(total[b] - total[a])
            digests.append(hashlib.sha256(b" ".join(compress(words, ~gone[a:b]) if lost else words)).hexdigest())
            n_removed.append(lost)
        ids.append(w.ids)
        n_words.append(np.diff(w.first))
    flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table({"doc_id": pa.array(flat(ids), pa.int64()), "n_words": pa.array(flat(n_words), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    rows, chunks = X.chunked(docs)
    buckets = max(1, chunks // 4)
    width = X.key_bytes(chunks)
    again = X.repeats(rows, chunk_anchors, buckets, width)
    sent = rows.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(lambda key, l, r: extend(key[0].as_py(), l, r, buckets, width), "bucket int, chunk int, keys binary, twins binary, ids binary")
    earlier = sent.groupBy("bucket").applyInArrow(lambda t: find_earlier(t), "chunk int, keys binary, twins binary")
    out = rows.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInArrow(lambda l, r: remove(l, r), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
