"""Numpy views over Arrow text: byte blocks, words and rolling fingerprints.

Python tasks of this subpackage receive Arrow batches. A batch is cut into
blocks of bounded size (one long document may exceed the bound), and all work
on a block is vectorised over its UTF-8 bytes, so memory follows the block.

Fingerprints are 64-bit and built from a mixer that is not linear: a span's bytes
are read eight at a time, each eight is mixed with its place, and the sum is mixed
again; a run of codes is mixed from its halves. No algebra carries over from one
level to the next, so repetitive texts collide no more often than random ones.
Two given spans agree with a chance of 2**-64. Where a match removes or reuses
something, a second fingerprint from another seed is compared too (2**-128).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEFT = np.uint64(0xA0761D6478BD642F)
_RIGHT = np.uint64(0xE7037ED1A0B428DB)
_EIGHT = np.uint64(8 * int(_LEFT) % (1 << 64))
#: The bytes of a little-endian eight that belong to a span with so many left.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the word, so that low bits can pick buckets."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def _salts(n: int, seed: int) -> np.ndarray:
    """A number for each of the first n places of a span."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 40)) * _ODD)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Fingerprint of buf[s:e] for each span; equal bytes, equal value."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = (ends - starts).astype(np.int64)
    words, salts = eights(buf), _salts(max((int(size.max()) + 7) >> 3, 1), seed)
    total = mix((words[starts] & _HEAD[np.minimum(size, 8)]) ^ salts[0])
    longer = np.flatnonzero(size > 8)
    if len(longer):
        parts = (size[longer] - 1) >> 3
        begin = np.cumsum(parts) - parts
        k = np.arange(1, int(parts.sum()) + 1) - np.repeat(begin, parts)
        piece = words[np.repeat(starts[longer], parts) + 8 * k] & _HEAD[np.minimum(np.repeat(size[longer], parts) - 8 * k, 8)]
        total[longer] += np.add.reduceat(mix(piece ^ salts[k]), begin)
    return mix(total + size.astype(np.uint64) * _LEFT)


def eight_hashes(buf: np.ndarray) -> np.ndarray:
    """What span_hashes gives for the eight bytes from each place on."""
    return mix(mix(eights(buf)[: max(len(buf) - 7, 0)] ^ _salts(1, 0)[0]) + _EIGHT)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Fingerprint of two stretches one after another."""
    return mix(left * _LEFT + (right ^ (right >> np.uint64(31))) * _RIGHT)


def rolling_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of `width` codes; entry i covers codes[i:i+width]. Runs are joined from parts, which may overlap."""
    if len(codes) < width:
        return np.zeros(0, np.uint64)
    return _grown(mix(codes ^ _ODD), 1, width)


def rolling_bytes(buf: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of `width` bytes, eight at least."""
    if len(buf) < width:
        return np.zeros(0, np.uint64)
    return _grown(mix(eights(buf)[: len(buf) - 7] ^ _ODD), 8, width)


def _grown(out: np.ndarray, have: int, width: int) -> np.ndarray:
    while have < width:
        step = min(have, width - have)
        out, have = _joined(out[:-step], out[step:]), have + step
    return out


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings in a row, and where each begins (n + 1 offsets). Null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(batches: Iterable[pa.RecordBatch | pa.Table], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Cut batches into tables whose text column holds about `limit` bytes."""
    for batch in batches:
        table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
        if not table.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(table.column(text)), 0).to_numpy().astype(np.int64)
        block = np.cumsum(lengths + 16) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), table.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield table.slice(a, b - a)


def word_bounds(buf: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each document, and the index of each document's first word (n + 1)."""
    n = len(buf)
    first = inside.copy()
    last = inside.copy()
    if n:
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begins = off[:-1][off[:-1] < off[1:]]
        first[begins] = inside[begins]
        finish = off[1:][off[:-1] < off[1:]] - 1
        last[finish] = inside[finish]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each item, from the documents' first items (n + 1)."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n items lie in a span that begins at one of `starts`."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.subtract.at(change, np.minimum(starts + width, n), 1)
    return np.cumsum(change[:n]) > 0


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands in sorted_keys, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def binary_rows(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
