"""Fingerprint exchanges between chunks of documents.

Documents are dealt into chunks of bounded size by a hash of their id, or of their
text where they have none. A chunk
merges its own repeats, sends each distinct fingerprint once, packed with the
others of its bucket, and gets back what the bucket's task found out about them.
A passage that a third of all documents share is thus one entry a chunk, however
often it occurs, and Spark moves few, large rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.common import NO_ID, partitions, text_bytes

CHUNK_BYTES = 2 << 20
PARTITION_BYTES = 64 << 20


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text) partitioned by chunk, and the number of chunks: sized from the bytes of all texts.

    Rows without an id are dealt by their texts, so that they fill all chunks; only equal ones meet.
    """
    total, parts = text_bytes(docs), partitions(docs.sparkSession)
    chunks = max(2 * parts, -(-total // chunk_bytes))
    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")
    place = F.when(F.col("doc_id") == NO_ID, F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = slim.withColumn("chunk", F.pmod(place, F.lit(chunks)).cast("int"))
    return dealt.repartition(max(parts, -(-total // PARTITION_BYTES)), "chunk"), chunks


def smallest(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, with their smallest and largest id and one place of each."""
    if not len(keys):
        return keys, ids, ids, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], ids[order]
    begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[begin], np.minimum.reduceat(d, begin), np.maximum.reduceat(d, begin), order[begin]


def by_bucket(bucket: np.ndarray, fields: dict[str, np.ndarray], widths: np.ndarray | None = None, data: bytes = b"") -> dict[str, list]:
    """Rows of packed fields, one a bucket that occurs. `data` holds widths[i] bytes of item i, already in bucket order."""
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    cuts = [*begin.tolist(), len(bucket)]
    out: dict[str, list] = {"bucket": bucket[begin].tolist()}
    for name, values in fields.items():
        out[name] = [values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    if widths is not None:
        at = np.concatenate([[0], np.cumsum(widths)])[cuts].tolist()
        out["data"] = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def flat(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column in a row, and the size of each value."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)), np.diff(off)


def unpack(table: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and the row that each comes from."""
    data, size = flat(table, name)
    width = np.dtype(kind).itemsize
    return np.frombuffer(data.tobytes(), kind), np.repeat(np.arange(len(size)), size // width)


def reply(table: pa.Table, rows: np.ndarray, fields: dict[str, np.ndarray]) -> pa.Table:
    """Answers to the chunks that sent the given rows; rows must be in order."""
    packed = by_bucket(rows, fields)
    chunks = table.column("chunk").to_numpy()
    return pa.table({"chunk": pa.array(chunks[np.array(packed["bucket"], np.int64)].astype(np.int32))} | {k: pa.array(v, pa.binary()) for k, v in packed.items() if k != "bucket"})


def key_bytes(chunks: int) -> int:
    """Bytes of a fingerprint that the first exchange carries.

    Its answers only choose what the next step looks at whole, so a chance match
    costs work and no result. Some 2 ** 17 keys a chunk, and under one chance
    match in a hundred keys.
    """
    return min(8, max(5, -(-(chunks.bit_length() + 17 + 7) // 8)))


def narrow(keys: np.ndarray, width: int) -> np.ndarray:
    """The upper `width` bytes of each key, as numbers."""
    return keys >> np.uint64(64 - 8 * width)


def to_bytes(keys: np.ndarray, width: int) -> np.ndarray:
    """The lower `width` bytes of each key, a row a key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def unpack_keys(table: pa.Table, width: int, name: str = "keys") -> tuple[np.ndarray, np.ndarray]:
    """Narrow keys of all rows, and the row of each."""
    data, size = flat(table, name)
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8").reshape(-1), np.repeat(np.arange(len(size)), size // width)


def send_repeats(keys: np.ndarray, ids: np.ndarray, chunk: int, buckets: int, width: int = 8) -> pa.Table:
    """First exchange, sending side: each distinct key of the chunk, and whether several of its documents have it."""
    distinct, low, high, _ = smallest(narrow(keys, width), ids)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    packed = by_bucket(bucket[order], {"keys": to_bytes(distinct[order], width), "several": (low < high)[order]})
    return pa.table({"bucket": pa.array(packed["bucket"], pa.int32()), "chunk": pa.array([chunk] * len(packed["bucket"]), pa.int32()), "keys": pa.array(packed["keys"], pa.binary()), "several": pa.array(packed["several"], pa.binary())})


def find_repeats(table: pa.Table, width: int = 8) -> pa.Table:
    """First exchange, bucket side: tell every chunk which of its keys stand in another document too."""
    keys, rows = unpack_keys(table, width)
    several, _ = unpack(table, "several", np.bool_)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    hit = several.copy()
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return reply(table, rows[hit], {"keys": to_bytes(keys[hit], width)})


SENT = "bucket int, chunk int, keys binary, several binary"
REPEATED = "chunk int, keys binary"


def repeats(docs: DataFrame, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], buckets: int, width: int = 8) -> DataFrame:
    """Per chunk, the (narrow) keys of keys_of(chunk) -> (keys, doc ids) that occur in two documents or more."""
    sent = docs.groupBy("chunk").applyInArrow(lambda key, t: send_repeats(*keys_of(t), key[0].as_py(), buckets, width), SENT)
    return sent.groupBy("bucket").applyInArrow(lambda t: find_repeats(t, width), REPEATED)
