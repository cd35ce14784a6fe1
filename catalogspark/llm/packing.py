"""Hierarchical multi-length packing.

1. Tokenise: one pass over the text. Full windows of the longest tier are cut
   from each document at once and are sequences; the rest of it is one piece.
2. Route: a piece belongs to the shortest tier (128, 256, 512, 1024) that holds it.
3. Pack each tier, the longest first: the longest piece of the tier opens a window
   of the tier's length, and pieces of the same and of shorter tiers fill its gap,
   largest fit first. Where nothing fits whole, the head of the longest piece left
   fills the gap and its rest is routed anew. So every window ends full, at a power
   of two, but for one window a group at the very end.
4. Balance: sequences of a tier are ranked over the whole result, and eight in a
   row are one step with one sequence for each step group. Thus all groups of a
   step read the same number of tokens, and a tier's last step alone is short.

The rests travel with their ids, so that a piece can be cut and its checksum
taken where it is packed; full windows travel as a few numbers. Pieces are dealt
into groups of about GROUP_ROWS documents, which bounds a packer's memory at any
scale; a rank is the place in the group plus the counts of the groups before.
The deal adds a number within the task, so that equal rows spread as well; the
input should be a stored table, read alike if a task is repeated.

Tokens are those of the tokenizer file without added ones, then id 0. The string of a
special token inside a text is that token, as the file has it, or ordinary text
where `special_as_text` is set. Text is cut before a space that stands between two
other characters: the tokenizer always begins a piece there, so such segments
can be encoded apart, and each worker keeps the ids of those it has met, under
two fingerprints of 64 bits, both of which must agree.

Defined cases: a null or empty text is the single id 0; a document of any length
is cut into windows; repeated rows are packed each for itself; rows without an id
are packed like others; an empty table gives no pieces. Extra columns of the
input, whatever their names, stay out of the result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm.common import checkpoint, small_side

LENGTH = 1024
TIERS = (128, 256, 512, 1024)
GROUP_ROWS = 8_192
STEP_GROUPS = 8
#: Segments whose ids a worker keeps before it starts anew: some 60 bytes each.
CACHE = 3_000_000
#: Bytes of segments that are encoded as one text.
JOINED = 1 << 14

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, number long, body binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, place long"

_JOINED = B.SPACE.copy()
_JOINED[28:32] = True
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # UTF-8 lead bytes of all other white space


def segment_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the text can be cut without changing its tokens: documents' begins, and lone spaces."""
    n = len(buf)
    cut = np.zeros(n, bool)
    if n > 2:
        wide = _LEADS[buf]
        solid = ~_JOINED[buf]
        before = solid[:-2].copy()
        tail = buf[:-2] >= 0x80
        before[1:] &= ~(tail[1:] & wide[:-3])
        before[2:] &= ~(tail[2:] & wide[:-4])
        cut[1:-1] = (buf[1:-1] == 32) & before & solid[2:] & ~wide[2:]
    inside = off[(off > 0) & (off < n)]
    cut[inside - 1] = False  # the space at a document's end
    cut[off[off < n]] = True
    return np.flatnonzero(cut)


def _extended(array: np.ndarray, used: int, values: np.ndarray) -> np.ndarray:
    """array with values after its first `used` entries; it grows by doubling."""
    if used + len(values) > len(array):
        array = np.concatenate([array[:used], np.empty(max(used, 2 * len(values)), array.dtype)])
    array[used : used + len(values)] = values
    return array


class SegmentCache:
    """Ids of segments by fingerprint, as flat arrays; new ones are encoded in a batch.

    Keys stand in a large sorted run and a small one, which is merged into it once
    it has an eighth of its size: a new segment is moved a few times in all.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        # A byte-level token's name has one character for each of its bytes.
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], np.int64)
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64)
        self.runs = [(none, np.zeros(0, np.int64)), (none, np.zeros(0, np.int64))]  # sorted keys, with their place below
        self.known, self.used = 0, 0
        self.checks, self.starts, self.lengths = none, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        out = np.full(len(keys), -1)
        for run, places in self.runs:
            at, found = B.find(run, keys)
            out[found] = places[at[found]]
        return out

    def _add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        places = np.arange(self.known, self.known + len(keys))
        self.starts = _extended(self.starts, self.known, self.used + np.cumsum(lengths) - lengths)
        self.lengths, self.checks = _extended(self.lengths, self.known, lengths), _extended(self.checks, self.known, checks)
        self.ids = _extended(self.ids, self.used, ids)
        self.known, self.used = self.known + len(keys), self.used + len(ids)
        (large, at), (small, small_at) = self.runs
        small, small_at = np.concatenate([small, keys]), np.concatenate([small_at, places])
        if 8 * len(small) > len(large):
            small, small_at, large, at = np.concatenate([large, small]), np.concatenate([at, small_at]), large[:0], at[:0]
            order = np.argsort(small, kind="stable")
            self.runs = [(small[order], small_at[order]), (large, at)]
        else:
            order = np.argsort(small, kind="stable")
            self.runs = [(large, at), (small[order], small_at[order])]

    def _apart(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments one after another, and how many each has."""
        texts = [data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        lists = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(x) for x in lists], np.int64)
        return np.fromiter((i for x in lists for i in x), np.uint32, int(lengths.sum())), lengths

    def _together(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for segments between lone spaces: joined to a few texts, whose ids are cut by the tokens' bytes."""
        want = np.cumsum(ends - starts)
        joined = b"".join(data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
        cuts = [0, *np.unique(want[np.searchsorted(want, np.arange(JOINED, len(joined), JOINED))]).tolist(), len(joined)]
        lists = self.tokenizer.encode_batch_fast([joined[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in lists])
        at, exact = B.find(np.cumsum(self.sizes[ids]), want)
        return (ids, np.diff(at, prepend=-1)) if exact.all() else self._apart(data, starts, ends)

    def encode(self, buf: np.ndarray, starts: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments one after another, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(buf))
        checks = B.span_hashes(buf, starts, ends, seed=1)
        keys, first, back = np.unique(B.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        if self.known > CACHE:
            self.clear()
        at = self._look(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            a, b = starts[first[new]], ends[first[new]]
            data, edge = buf.tobytes(), np.isin(a, off) | np.isin(b, off)
            for use, encoded in ((new[~edge], self._together), (new[edge], self._apart)):
                if len(use):
                    self._add(keys[use], checks[first[use]], *encoded(data, starts[first[use]], ends[first[use]]))
            at = self._look(keys)
        at = at[back]
        lengths = self.lengths[at]
        done = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[at] - (done - lengths), lengths) + np.arange(done[-1])]
        odd = np.flatnonzero(self.checks[at] != checks)
        if len(odd):  # another segment has the same first fingerprint
            parts = np.split(ids, done[:-1])
            own, n = self._apart(buf.tobytes(), starts[odd], ends[odd])
            lengths[odd] = n
            for i, x in zip(odd.tolist(), np.split(own, np.cumsum(n)[:-1]), strict=True):
                parts[i] = x
            ids = np.concatenate(parts)
        return ids, lengths


_caches: dict[tuple[str, bool], SegmentCache] = {}


def token_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, special_as_text: bool = False) -> DataFrame:
    """One row a piece: full windows, then the rest with its ids, of every document of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = (tokenizer, special_as_text)
        if known not in _caches:
            _caches[known] = SegmentCache(*known)
        cache, number = _caches[known], 0
        for part in B.slices(batches, "text"):
            buf, off = B.utf8(part.column("text"))
            starts = segment_starts(buf, off)
            ids, lengths = cache.encode(buf, starts, off)
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, off)]
            rows: list[tuple[int, int, int, int]] = []
            bodies: list[bytes | None] = []
            raw = ids.astype("<u4")
            for d, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                data = raw[a:b].tobytes() + b"\0\0\0\0"
                total = b - a + 1
                for s in range(0, total, length):
                    body = data[4 * s : 4 * (s + length)]
                    rows.append((d, s, len(body) // 4, zlib.crc32(body)))
                    bodies.append(body if len(body) < 4 * length else None)
            d, s, n, crc = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").combine_chunks().cast(pa.int64()).take(pa.array(d)), pa.array(s), pa.array(n.astype(np.int32)), pa.array(crc), pa.array((np.diff(ends) + 1)[d]), pa.array(np.arange(number, number + len(d))), pa.array(bodies, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "number", "body"],
            )
            number += len(d)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    """The shortest tier that holds a piece."""
    return next(t for t in tiers if length <= t)


def fill_windows(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (piece, its first token, tokens): each tier packed, gaps filled from shorter tiers.

    Pieces left are kept by length, and the lengths in stock as bits of one
    integer, so the largest that fits is found without a search.
    """
    left: list[list[tuple[int, int]]] = [[] for _ in range(tiers[-1] + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        left[lengths[i]].append((i, 0))
    stock = sum(1 << n for n, x in enumerate(left) if x)
    windows = []

    def take(n: int) -> tuple[int, int]:
        nonlocal stock
        out = left[n].pop()
        if not left[n]:
            stock ^= 1 << n
        return out

    while stock:
        n = stock.bit_length() - 1
        window, room = [(*take(n), n)], tier_of(n, tiers) - n
        while room and stock:
            fits = stock & ((1 << (room + 1)) - 1)
            n = (fits or stock).bit_length() - 1
            piece, first = take(n)
            used = min(n, room)
            window.append((piece, first, used))
            if used < n:
                left[n - used].append((piece, first + used))
                stock |= 1 << (n - used)
            room -= used
        windows.append(window)
    return windows


def pack_group(table: pa.Table, length: int = LENGTH, tiers: tuple[int, ...] = TIERS) -> pa.Table:
    """Sequences of one group of pieces; sequence ids are group * 2**32 + window, places count a tier's sequences."""
    table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
    group = int(table.column("_group")[0].as_py()) << 32
    n = table.column("length").to_pylist()
    whole = n.count(length)
    bodies = table.column("body").to_pylist()
    windows = [[(i, 0, length)] for i in range(whole)] + [[(i + whole, first, used) for i, first, used in w] for w in fill_windows(n[whole:], tiers)]
    starts, crcs = table.column("start").to_pylist(), table.column("ids_crc32").to_pylist()
    count = dict.fromkeys(tiers, 0)
    at, rows = [], []
    for k, window in enumerate(windows):
        tier, offset = tier_of(sum(x[2] for x in window), tiers), 0
        for i, first, used in window:
            crc = crcs[i] if used == n[i] else zlib.crc32(bodies[i][4 * first : 4 * (first + used)])
            at.append(i)
            rows.append((starts[i] + first, used, crc, group + k, offset, tier, count[tier]))
            offset += used
        count[tier] += 1
    columns = np.array(rows, np.int64).reshape(-1, 7).T
    take = pa.array(np.array(at, np.int64))
    out = {"doc_id": table.column("doc_id").take(take)} | dict(zip(("start", "length", "ids_crc32"), map(pa.array, columns[:3]), strict=True)) | {"doc_tokens": table.column("doc_tokens").take(take)}
    return pa.table(out | {"sequence_id": pa.array(columns[3]), "offset": pa.array(columns[4]), "tier": pa.array(columns[5].astype(np.int32)), "place": pa.array(columns[6])})


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, tiers: tuple[int, ...] = TIERS, special_as_text: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and place, its tier, and its step and group of the step."""
    groups = max(1, -(-docs.count() // GROUP_ROWS))
    pieces = token_pieces(docs, tokenizer, length, special_as_text)
    key = F.xxhash64("doc_id", "start", "ids_crc32", "number")
    dealt = pieces.withColumn("_group", F.pmod(key, F.lit(groups)).cast("int")).drop("number")
    packed = checkpoint(dealt.groupBy("_group").applyInArrow(lambda t: pack_group(t, length, tiers), PACKED))
    group = F.shiftright("sequence_id", 32)
    counts = packed.groupBy(group.alias("_g"), "tier").agg((F.max("place") + 1).alias("_n"))  # a row a group and tier
    before = Window.partitionBy("tier").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranked = packed.withColumn("_g", group).join(small_side(shifts, groups * len(tiers)), ["_g", "tier"]).withColumn("_rank", F.col("place") + F.col("_before"))
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", F.floor(F.col("_rank") / STEP_GROUPS).alias("step"), (F.col("_rank") % STEP_GROUPS).cast("int").alias("step_group"))
