"""Periodic runs by online dyadic square catching.

The words of a text are appended one after another. Whenever a block of 2**k words
is complete, it becomes a catcher for the squares whose period lies in
[2**k, 2**(k+1)): each later word ends a suffix of 2**k words, which is compared with
the catcher that stands one block back, until the next block is complete. A
suffix equal to its catcher at distance d is a part of a square of period d; it is
extended to both sides as far as words d apart are equal, and all squares that
extend to the same stretch merge into one run.

A run of period q in [2**k, 2**(k+1)) and three periods at least holds an aligned block
of 2**k words that stands again q words later, wherever the run begins: no such
run escapes. Catchers go from short to long, so a stretch is first met with its
smallest period; squares inside a run whose period divides theirs are that run.

A batch advances all of its words together: suffixes of 2**k words have rolling
fingerprints joined from those of 2**(k-1), so a word costs a few vector operations
a level. Documents of a batch are parted by words of their own that equal no
other, so no run crosses them. Each run found is checked once more word by word
under a second fingerprint; after a chance match the batch is done again with
another seed. There is no shuffle; memory follows the longest document, with some
8 bytes a word and level.

Defined cases: a null or empty text has no words and no runs, and its digests are
those of the empty string; rows that share an id or have none are judged each by
itself; texts are read whole; ties in length / period go to the smallest start,
then period; an empty table gives an empty result; other columns of the input,
whatever their names, stay out of the result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B

#: Shortest run in words, and in periods.
MIN_WORDS = 24
MIN_PERIODS = 3

REPORT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
RUNS = "doc_id long, start long, length long, period long"

_LEFT = np.uint64(0xD1B54A32D192ED03)
_RIGHT = np.uint64(0xABC98388FB8FAC03)

#: (doc_id, number of words) -> (first word changed, period), or None for a document left as it is.
Rewrite = Callable[[int, int], tuple[int, int] | None]


def _doubled(width_hashes: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of runs of 2 * width words from those of width."""
    left, right = width_hashes[:-width], width_hashes[width:]
    return B.mix(left * _LEFT + (right ^ (right >> np.uint64(29))) * _RIGHT)


class Suffixes:
    """Fingerprints of all runs of 1, 2, 4, ... words, and common extensions by them."""

    def __init__(self, codes: np.ndarray, seed: int, longest: int):
        """longest: suffixes up to this length."""
        self.n = len(codes)
        self.levels = [B.mix(codes ^ B.mix(np.full(1, seed + 1, np.uint64)))]
        while 2 << (len(self.levels) - 1) <= longest:
            self.levels.append(_doubled(self.levels[-1], 1 << (len(self.levels) - 1)))

    def _steps(self) -> Iterator[tuple[np.ndarray, int, bool]]:
        """Levels from long to short; the longest is to be repeated while it matches."""
        for k in range(len(self.levels) - 1, -1, -1):
            yield self.levels[k], 1 << k, k == len(self.levels) - 1

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a on equal those from b on; a < b."""
        out = np.zeros(len(a), np.int64)
        for level, width, again in self._steps():
            live = np.arange(len(a))
            while len(live):
                y = b[live] + out[live]
                live = live[y + width <= self.n]
                x, y = a[live] + out[live], b[live] + out[live]
                live = live[level[x] == level[y]]
                out[live] += width
                if not again:
                    break
        return out

    def back(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a equal those before b; a < b."""
        out = np.zeros(len(a), np.int64)
        for level, width, again in self._steps():
            live = np.arange(len(a))
            while len(live):
                x = a[live] - out[live] - width
                live = live[x >= 0]
                x, y = a[live] - out[live] - width, b[live] - out[live] - width
                live = live[level[x] == level[y]]
                out[live] += width
                if not again:
                    break
        return out

    def caught(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Catchers of 2**k words, and the suffixes in the next block that equal them: their first words.

        Where the pair one block before is equal too, both are parts of one square, and the earlier stands for it.
        """
        level, width = self.levels[k], 1 << k
        rows = -(-len(level) // width)
        grid = np.zeros(rows * width, np.uint64)
        grid[: len(level)] = level
        grid = grid.reshape(rows, width)
        at = np.flatnonzero(grid[1:] == grid[:-1, :1]) + width
        at = at[at < len(level)]
        at = at[~B.find(at, at - width)[1]]
        return (at // width - 1) * width, at


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, sizes[i] of them."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _merged(squares: list[np.ndarray]) -> np.ndarray:
    """Distinct stretches as rows of start, end, period, each with its smallest period; in order of start, then period."""
    rows = np.concatenate([np.zeros((0, 3), np.int64), *squares])
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _catch(codes: np.ndarray, longest: int, seed: int, words: int, periods: int) -> np.ndarray:
    suffixes, found = Suffixes(codes, seed, longest // periods), []
    reach, period = np.zeros(len(codes), np.int64), np.ones(len(codes), np.int64)  # the run that covers a word and ends last
    for k in range(len(suffixes.levels)):
        width = 1 << k
        a, b = suffixes.caught(k)
        new = (b + width > reach[a]) | ((b - a) % period[a] != 0)
        a, b = a[new], b[new]
        if len(a):
            left, right = suffixes.back(a, b), suffixes.ahead(a + width, b + width)
            rows = np.stack([a - left, b + width + right, b - a], 1)
            rows = _merged([rows[rows[:, 1] - rows[:, 0] >= np.maximum(words, periods * rows[:, 2])]])
            found.append(rows)
            rows = rows[np.argsort(rows[:, 1], kind="stable")]
            size = rows[:, 1] - rows[:, 0]
            at, end, own = _ranges(rows[:, 0], size), np.repeat(rows[:, 1], size), np.repeat(rows[:, 2], size)
            later = end > reach[at]
            reach[at[later]], period[at[later]] = end[later], own[later]
    return _merged(found)


def find(codes: np.ndarray, bounds: np.ndarray, twins: Callable[[np.ndarray], np.ndarray], words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> np.ndarray:
    """Runs of all documents: rows of start, end, period in word places.

    codes: a fingerprint a word; bounds: the documents' first words (n + 1);
    twins(places): second fingerprints of the words at these places.
    """
    docs, sizes = len(bounds) - 1, np.diff(bounds)
    longest = int(sizes.max(initial=0))
    if longest < max(words, periods):
        return np.zeros((0, 3), np.int64)
    owner = np.repeat(np.arange(docs), sizes)
    parted = np.zeros(len(codes) + docs, np.uint64)
    parted[bounds[1:] + np.arange(docs)] = np.arange(docs, dtype=np.uint64)
    parted[np.arange(len(codes)) + owner] = codes
    for seed in count():
        rows = _catch(parted, longest, seed, words, periods)
        if not len(rows):
            return rows
        before = np.searchsorted(bounds[1:] + np.arange(docs), rows[:, 0])
        rows[:, :2] -= before[:, None]
        size = rows[:, 1] - rows[:, 0] - rows[:, 2]
        at = _ranges(rows[:, 0], size)
        distance = np.repeat(rows[:, 2], size)
        inside = (rows[:, 1] <= bounds[before + 1]).all()
        if inside and (codes[at] == codes[at + distance]).all() and (twins(at) == twins(at + distance)).all():
            return rows
    raise AssertionError


class Batch:
    """The words of a batch of documents, rewritten where asked, and their runs."""

    def __init__(self, part: pa.Table, rewrite: Rewrite | None, words: int, periods: int):
        self.ids = part.column("doc_id").to_pylist()
        self.buf, self.off = B.utf8(part.column("text"))
        starts, ends, self.first = B.word_bounds(self.buf, self.off, ~B.SPACE[self.buf])
        self.source = np.arange(len(starts))
        self.changed = np.zeros(len(self.ids), bool)
        for d, (i, a, b) in enumerate(zip(self.ids, self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)):
            if rewrite and i is not None and b > a and (way := rewrite(i, b - a)):
                self.source[a + way[0] : b] = a + way[0] + np.arange(b - a - way[0]) % way[1]
                self.changed[d] = True
        starts, ends = starts[self.source], ends[self.source]
        self.runs = find(B.span_hashes(self.buf, starts, ends), self.first, lambda at: B.span_hashes(self.buf, starts[at], ends[at], seed=1), words, periods)
        self.doc = np.searchsorted(self.first[1:], self.runs[:, 0], side="right")

    def collapsed(self) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
        """Each document's words with every run cut to its first period, and its runs by place in the document."""
        start, end, period = self.runs.T
        gone = B.covered(start + period, end - start - period, len(self.source))
        cuts = np.searchsorted(self.doc, np.arange(len(self.ids) + 1)).tolist()
        data, off, first = self.buf.tobytes(), self.off.tolist(), self.first.tolist()
        rows = np.stack([start - self.first[self.doc], end - start, period], 1).tolist()
        for d in range(len(self.ids)):
            words, a, b = data[off[d] : off[d + 1]].split(), first[d], first[d + 1]
            own = rows[cuts[d] : cuts[d + 1]]
            if own or self.changed[d]:
                words = [words[i - a] for i in self.source[a:b][~gone[a:b]].tolist()]
            yield b" ".join(words), own


def _batches(docs: DataFrame, made: Callable[[Batch], pa.RecordBatch], schema: str, rewrite: Rewrite | None, words: int, periods: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in B.slices(batches, "text"):
            yield made(Batch(part, rewrite, words, periods))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, start, length, period), one row a run."""

    def rows(batch: Batch) -> pa.RecordBatch:
        start, end, period = batch.runs.T
        ids = pa.array(batch.ids, pa.int64()).take(pa.array(batch.doc, pa.int64()))
        return pa.RecordBatch.from_arrays([ids, pa.array(start - batch.first[batch.doc]), pa.array(end - start), pa.array(period)], names=["doc_id", "start", "length", "period"])

    return _batches(docs, rows, RUNS, rewrite, words, periods)


def collapse(docs: DataFrame, words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, text): each text's words joined by one space, every run cut to its first period."""

    def rows(batch: Batch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(batch.ids, pa.int64()), pa.array([text.decode() for text, _ in batch.collapsed()], pa.string())], names=["doc_id", "text"])

    return _batches(docs, rows, "doc_id long, text string", None, words, periods)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared without rounding; the first of equal ones."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def run_report(docs: DataFrame, rewrite: Rewrite | None = None, words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """One row a document: its number of runs, the strongest run, and digests of all runs and of the collapsed text."""

    def rows(batch: Batch) -> pa.RecordBatch:
        out: list[tuple] = []
        for text, runs in batch.collapsed():
            start, length, period = strongest(runs) or (None, None, None)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
            out.append((len(runs), start, length, period, None if period is None else 1000 * length // period, hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        names = [c.split()[0] for c in REPORT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(batch.ids, pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    return _batches(docs, rows, REPORT, rewrite, words, periods)


def planted(doc_id: int, n_words: int) -> tuple[int, int] | None:
    """The rewriting of one document in ten, by the checksum of its id, that puts a known repetition at its end."""
    check = zlib.crc32(str(doc_id).encode())
    if check % 10:
        return None
    g = check // 10
    first = g % n_words
    return first, 1 + (n_words - first) // (3 + g % 8)
