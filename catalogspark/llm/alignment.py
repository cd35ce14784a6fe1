"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut each text. A, a byte-level BPE, reads the text behind one
space; B, a piece BPE, puts that space there itself. An A token and a B token whose
byte ranges overlap are linked; byte offsets where tokens of both end cut the
text into groups.

1. Blocks of documents are tokenised and inverted: for every id pair that the block
   links, a bitmap of the documents that link it, and planes for the
   multiplicities (plane j has the documents whose number of links has bit j).
   A bitmap is a list of 16-bit document numbers, or one bit a document where
   that is shorter. The blocks are one stored table.
2. Merging: the bitmaps of a pair in different blocks have no document in common,
   so OR-merging them adds up popcounts: documents from the OR of the planes, links
   from the planes weighted by 2**j. These are summed a pair, partially in each task.
3. Postings return scores: each pair's count, and whether it is the highest of its B
   id, goes back to the blocks that have the pair, and along the pair's planes
   to the documents.

Both tokenizers begin anew at a space between two other characters (no piece of B
holds a space behind another character; this is checked when it is loaded), so
such segments are tokenised and linked once a worker, however often they occur
(until it has met MEMORY others). They are known by two fingerprints in one number.

A pair is one row a block at most, whatever documents hold it, and joins on pairs
are equi-joins that Spark splits where skewed; a block is bounded by BLOCK_BYTES and
BLOCK_DOCS, but for one longer document.

Defined cases: null and empty texts, and texts whose A or B bytes differ from space
plus text (U+2581 reads as a space in B), have no tokens: zeros and an empty digest
column; special tokens' strings inside texts are plain text; rows that share an id
or have none are judged each by itself; an empty table gives an empty result;
other columns of the input, whatever their names, stay out of the result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm.common import stored
from catalogspark.llm.packing import segment_starts

BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1 << 15
#: Bytes of segments that are tokenised as one text.
JOINED = 1 << 14
#: Segments that a worker remembers before it starts anew: some 120 bytes each.
MEMORY = 1_500_000
SPACE_MARK = "▁"

BLOCKS = "block long, n int, ids binary, named binary, totals binary, digests binary, pairs binary, sizes binary, planes binary"
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_CODEC = "zstd"


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, codec=_CODEC, asbytes=True) if data else b"")


def opened(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec=_CODEC, asbytes=True) if size else b"", kind)


class Bitmaps:
    """Sets of document numbers below n, one after another: 16-bit numbers, or a bit a document where that is shorter."""

    @staticmethod
    def pack(owner: np.ndarray, docs: np.ndarray, sets: int, n: int) -> bytes:
        """owner: the set of each number, in order; docs: the numbers, rising within a set."""
        sizes = np.bincount(owner, minlength=sets)
        dense = 2 * sizes > -(-n // 8)
        full = dense[owner]
        bits = np.zeros((int(dense.sum()), n), bool)
        bits[(np.cumsum(dense) - 1)[owner[full]], docs[full]] = True
        parts = [sizes.astype("<u4").tobytes(), docs[~full].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes()]
        return b"".join(len(x).to_bytes(8, "little") + x for x in map(squeezed, parts))

    @staticmethod
    def popcounts(data: bytes) -> np.ndarray:
        return opened(data[8 : 8 + int.from_bytes(data[:8], "little")], "<u4").astype(np.int64)

    @staticmethod
    def unpack(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
        """owner and docs as `pack` was given them."""
        parts, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            parts.append(data[at + 8 : at + 8 + size])
            at += 8 + size
        sizes = opened(parts[0], "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        full = (2 * sizes > -(-n // 8))[owner]
        docs = np.empty(len(owner), np.int64)
        docs[~full] = opened(parts[1], "<u2")
        if full.any():
            docs[full] = np.nonzero(np.unpackbits(opened(parts[2], np.uint8).reshape(-1, -(-n // 8)), axis=1, count=n))[1]
        return owner, docs


def pack_planes(owner: np.ndarray, docs: np.ndarray, times: np.ndarray, sets: int, n: int) -> bytes:
    """The multiplicity planes of all pairs of a block, one after another."""
    planes = [Bitmaps.pack(owner[on], docs[on], sets, n) for j in range(int(times.max(initial=0)).bit_length()) if len(on := np.flatnonzero(times >> j & 1)) or True]
    return b"".join(len(x).to_bytes(8, "little") + x for x in planes)


def planes_of(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        yield data[at + 8 : at + 8 + size]
        at += 8 + size


class Aligner:
    """Both tokenizers, and for texts laid one after another the tokens, links and groups of each."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        # A byte-level token's name has one character for each of its bytes.
        self.sizes_a = np.array([len(self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())], np.int64)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("pieces of B hold spaces behind other characters: its texts can't be cut at spaces")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.flat_b = np.frombuffer(b"".join(self.bytes_b), np.uint8)
        self.start_b = np.cumsum(self.sizes_b) - self.sizes_b
        # The decimal digits of every id, with room for what follows them.
        top = max(len(self.sizes_a), len(pieces))
        self.width = np.array([len(str(i)) for i in range(top)], np.int64)
        self.digits = np.zeros((top, int(self.width.max()) + 1), np.uint8)
        for i in range(top):
            self.digits[i, : self.width[i]] = np.frombuffer(str(i).encode(), np.uint8)

    def ids_a(self, texts: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def ids_b(self, texts: list[bytes]) -> list[list[int]]:
        """B puts the space that each text begins with there itself."""
        return self.b.encode([t[1:].decode() for t in texts], num_threads=1)

    def _spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of B's pieces one after another."""
        size = self.sizes_b[ids]
        done = np.cumsum(size)
        return self.flat_b[np.repeat(self.start_b[ids] - (done - size), size) + np.arange(int(size.sum()))]

    def tokens(self, texts: list[bytes], alone: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids and their ends in the texts laid one after another, B's likewise, and which texts both spell as they are.

        The last `alone` texts are tokenised each by itself; the others stand between lone spaces and are joined to longer ones.
        Texts that B spells differently keep no tokens.
        """
        data, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
        many, good = len(texts) - alone, np.ones(len(texts), bool)
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if many:
            size = int(ends[many - 1])
            cuts = [0, *np.unique(ends[np.searchsorted(ends, np.arange(JOINED, size, JOINED))]).tolist(), size]
            runs = [data[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True) if y > x]
            a, b = (np.concatenate([np.array(x, np.int64) for x in ids_of(runs)]) for ids_of in (self.ids_a, self.ids_b))
            end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
            whole = B.find(end_a, ends[:many])[1].all() and B.find(end_b, ends[:many])[1].all() and self._spelled(b).tobytes() == data[:size]
            if whole:
                for k, x in enumerate((a, end_a, b, end_b)):
                    out[k].append(x)
            else:
                many = 0
        rest = texts[many:]
        for i, (a, b) in enumerate(zip(self.ids_a(rest), self.ids_b(rest), strict=True), many) if rest else ():
            good[i] = b"".join([self.bytes_b[x] for x in b]) == texts[i]
            if good[i]:
                start = int(ends[i]) - len(texts[i])
                for k, (ids, sizes) in enumerate(((a, self.sizes_a), (b, self.sizes_b))):
                    out[2 * k].append(np.array(ids, np.int64))
                    out[2 * k + 1].append(start + np.cumsum(sizes[ids]))
        return *map(np.concatenate, out), good

    def written(self, ids: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Each id in decimal with the byte that follows it; how long each is, is width + 1."""
        rows = self.digits[ids]
        rows[np.arange(len(ids)), self.width[ids]] = after
        return rows[rows != 0]


class Linked:
    """Tokens, groups and links of distinct texts: numbers a text, and all links as (text, pair)."""

    def __init__(self, aligner: Aligner, texts: list[bytes], alone: int):
        ends = np.cumsum([len(t) for t in texts])
        a, end_a, b, end_b, self.good = aligner.tokens(texts, alone)
        n = len(texts)
        home = lambda at: np.searchsorted(ends, at)
        both = end_a[B.find(end_b, end_a)[1]]
        cuts = np.union1d(end_a, end_b)
        self.n_a, self.n_b = np.bincount(home(end_a), minlength=n), np.bincount(home(end_b), minlength=n)
        self.n_groups, self.n_links = np.bincount(home(both), minlength=n), np.bincount(home(cuts), minlength=n)
        # Between two neighbouring cuts lie one A and one B token; two tokens overlap in one such stretch at most.
        self.pairs = b[np.searchsorted(end_b, cuts)] << 32 | a[np.searchsorted(end_a, cuts)] if len(cuts) else np.zeros(0, np.int64)
        # `a1,a2|b1;`: A's tokens of a group, then B's.
        last_a, last_b = B.find(both, end_a)[1], B.find(both, end_b)[1]
        group = np.concatenate([np.searchsorted(both, end_a), np.searchsorted(both, end_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((np.concatenate([end_a, end_b]), side, group))
        ids = np.concatenate([a, b])[order]
        after = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])[order]
        data = aligner.written(ids, after).tobytes()
        size = np.bincount(np.concatenate([home(end_a), home(end_b)])[order], aligner.width[ids] + 1, minlength=n).astype(np.int64) if len(ids) else np.zeros(n, np.int64)
        done = np.cumsum(size).tolist()
        self.texts = [data[x:y] for x, y in zip([0, *done[:-1]], done, strict=True)]


class Memory:
    """What a worker knows of the segments it has met, by fingerprint: their numbers, links and group texts.

    Keys stand in a large sorted run and a small one, which joins it once it has an eighth of its size.
    """

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64)
        self.runs = [(none, np.zeros(0, np.int64)), (none, np.zeros(0, np.int64))]
        self.numbers = np.zeros((5, 0), np.int32)  # n_a, n_b, n_groups, n_links, good
        self.first = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.texts: list[bytes] = []

    def _look(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1)
        for run, places in self.runs:
            at, found = B.find(run, keys)
            out[found] = places[at[found]]
        return out

    def places(self, keys: np.ndarray, text_of: Callable[[np.ndarray], list[bytes]], alone: np.ndarray) -> np.ndarray:
        """Where each segment's facts stand; new ones are tokenised first. alone: segments that cannot be joined to others."""
        if len(self.texts) > MEMORY:
            self.clear()
        at = self._look(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            texts = text_of(new)
            apart = alone[new] | np.array([SPACE_MARK.encode() in t for t in texts], bool)
            order = np.argsort(apart, kind="stable")
            new, texts = new[order], [texts[i] for i in order.tolist()]
            made = Linked(self.aligner, texts, int(apart.sum()))
            own = len(self.texts) + np.arange(len(new))
            self.numbers = np.concatenate([self.numbers, np.stack([made.n_a, made.n_b, made.n_groups, made.n_links, made.good]).astype(np.int32)], 1)
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(made.n_links)])
            self.pairs = np.concatenate([self.pairs, made.pairs])
            self.texts += made.texts
            (large, large_at), (small, small_at) = self.runs
            small, small_at = np.concatenate([small, keys[new]]), np.concatenate([small_at, own])
            if 8 * len(small) > len(large):
                small, small_at, large, large_at = np.concatenate([large, small]), np.concatenate([large_at, small_at]), large[:0], large_at[:0]
            rank = np.argsort(small, kind="stable")
            self.runs = [(large, large_at), (small[rank], small_at[rank])] if len(large) else [(small[rank], small_at[rank]), (large, large_at)]
            at[new] = own
        return at


_memories: dict[tuple[str, str], Memory] = {}


def memory_of(path_a: str, path_b: str) -> Memory:
    """One a worker: loading takes a second."""
    if (path_a, path_b) not in _memories:
        _memories[path_a, path_b] = Memory(Aligner(path_a, path_b))
    return _memories[path_a, path_b]


def invert(part: pa.Table, memory: Memory) -> dict[str, object]:
    """A block's row: its documents' own numbers, and its pairs' planes."""
    ids, n = part.column("doc_id").combine_chunks(), part.num_rows
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.fill_null(part.column("text").cast(pa.large_string()), ""), pa.scalar("", pa.large_string()))
    buf, off = B.utf8(spaced)
    starts = segment_starts(buf, off)
    stops = np.append(starts[1:], len(buf))
    keys = B.mix(B.span_hashes(buf, starts, stops) + B.mix(B.span_hashes(buf, starts, stops, seed=1)))
    keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
    data = buf.tobytes()
    text_of = lambda at: [data[x:y] for x, y in zip(starts[first[at]].tolist(), stops[first[at]].tolist(), strict=True)]
    back = memory.places(keys, text_of, np.isin(starts[first], off) | np.isin(stops[first], off))[back]
    doc = np.searchsorted(off, starts, side="right") - 1
    numbers = memory.numbers[:, back]
    good = (np.diff(off) > 1) & (np.bincount(doc, 1 - numbers[4], minlength=n) == 0)
    totals = np.stack([np.bincount(doc, x, minlength=n) * good for x in numbers[:4]]).astype("<i8")
    bounds, whole = np.searchsorted(starts, off).tolist(), back.tolist()
    digests = b"".join(hashlib.sha256(b"".join([memory.texts[k] for k in whole[bounds[d] : bounds[d + 1]]])[:-1]).digest() if good[d] else bytes(32) for d in range(n))
    use = good[doc]
    times = numbers[3][use].astype(np.int64)
    done = np.cumsum(times)
    at = np.repeat(memory.first[back[use]] - (done - times), times) + np.arange(int(times.sum()))
    kinds, pair = np.unique(memory.pairs[at], return_inverse=True)
    held, count = np.unique(pair * n + np.repeat(doc[use], times), return_counts=True)
    owner, docs = held // max(n, 1), held % max(n, 1)
    named = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    return {
        "n": n, "ids": squeezed(pc.fill_null(ids, 0).to_numpy().astype("<i8").tobytes()), "named": squeezed(np.stack([named, good]).tobytes()), "totals": squeezed(totals.tobytes()), "digests": digests,
        "pairs": squeezed(kinds.astype("<i8").tobytes()), "sizes": squeezed(np.bincount(owner, minlength=len(kinds)).astype("<u4").tobytes()), "planes": pack_planes(owner, docs, count, len(kinds), n),
    }


def gathered(batches: Iterator[pa.RecordBatch], bytes_: int, docs: int) -> Iterator[pa.Table]:
    """Tables of about so many bytes of text and so many rows at most."""
    held: list[pa.Table] = []
    size = rows = 0
    for part in B.slices(batches, "text", bytes_ // 4):
        for k in range(0, part.num_rows, docs):
            piece = part.slice(k, docs)
            if held and (size >= bytes_ or rows + piece.num_rows > docs):
                yield pa.concat_tables(held).combine_chunks()
                held, size, rows = [], 0, 0
            held.append(piece)
            size += int(pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0)
            rows += piece.num_rows
    if held:
        yield pa.concat_tables(held).combine_chunks()


def inverted(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The blocks: one row each. Store them before use: block numbers are a task's, and hold for one run of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, part in enumerate(gathered(batches, BLOCK_BYTES, BLOCK_DOCS)):
            row = invert(part, memory_of(path_a, path_b))
            arrays = [pa.array([task + k], pa.int64()), pa.array([row["n"]], pa.int32()), *[pa.array([row[c]], pa.binary()) for c in ("ids", "named", "totals", "digests", "pairs", "sizes", "planes")]]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "n", "ids", "named", "totals", "digests", "pairs", "sizes", "planes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BLOCKS)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, docs, links): popcounts of the pairs' bitmaps in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs = opened(row["pairs"], "<i8")
                links = np.zeros(len(pairs), np.int64)
                for j, plane in enumerate(planes_of(row["planes"])):
                    links += Bitmaps.popcounts(plane) << j
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row["block"])), pa.array(pairs), pa.array(opened(row["sizes"], "<u4").astype(np.int64)), pa.array(links)], names=["block", "pair", "docs", "links"])

    return blocks.select("block", "pairs", "sizes", "planes").mapInArrow(run, "block long, pair long, docs long, links long")


def pair_scores(counted: DataFrame) -> DataFrame:
    """(pair, a, b, docs, links, best) of all pairs: their documents, their links, and whether no pair of the B id has more."""
    pairs = counted.groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    split = pairs.withColumn("b", F.shiftright("pair", 32).cast("int")).withColumn("a", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
    highest = F.max("links").over(Window.partitionBy("b"))  # a B id has no more rows than A has ids
    return split.select("pair", "a", "b", "docs", "links", (F.col("links") == highest).alias("best"))


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, b, docs, links, best), one row an id pair that some text links."""
    return pair_scores(block_pairs(stored(inverted(docs, path_a, path_b)))).drop("pair")


def returned(blocks: pa.Table, scores: pa.Table) -> pa.Table:
    """The documents of a block, with its pairs' scores summed along their planes."""
    row = blocks.to_pylist()[0]
    n = row["n"]
    pairs = opened(row["pairs"], "<i8")
    at = B.find(pairs, scores.column("pair").to_numpy())[0]
    links, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    links[at], best[at] = scores.column("links").to_numpy(), scores.column("best").to_numpy(zero_copy_only=False)
    sums = np.zeros((2, n), np.int64)
    for j, plane in enumerate(planes_of(row["planes"])):
        owner, docs = Bitmaps.unpack(plane, n)
        order = np.argsort(docs, kind="stable")
        begin = np.searchsorted(docs[order], np.arange(n + 1))
        for k, value in enumerate((best, links)):
            total = np.concatenate([[0], np.cumsum(value[owner[order]])])
            sums[k] += (total[begin[1:]] - total[begin[:-1]]) << j
    named, good = opened(row["named"], np.bool_).reshape(2, n)
    totals = opened(row["totals"], "<i8").reshape(4, n)
    digests = [row["digests"][32 * d : 32 * d + 32].hex() if good[d] else "" for d in range(n)]
    columns = [pa.array(opened(row["ids"], "<i8"), mask=~named), *map(pa.array, totals), pa.array(sums[0]), pa.array(sums[1]), pa.array(digests, pa.string())]
    return pa.table(columns, names=[c.split()[0] for c in REPORT.split(", ")])


def alignment_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row a document: its tokens, groups and links, what its links' pairs score, and its groups' digest."""
    blocks = stored(inverted(docs, path_a, path_b))
    counted = block_pairs(blocks)
    scores = pair_scores(counted).select("pair", "links", "best")
    back = counted.select("block", "pair").join(scores, "pair")
    return blocks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(lambda left, right: returned(left, right), REPORT)
