"""Distributed union-find: connected components of an edge table.

Each task first merges its own edges with a union-find and passes on one edge a
node, from the node to its smallest local partner. Then large-star and
small-star rounds run as joins and minimum aggregations until the edges stop
changing; they end as stars whose centres are the components' smallest nodes.
Nothing is gathered in one task or on the driver. Each round's edges are stored in
the shared folder, so a lost executor costs one round, and the last round's go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm.common import release, stored

#: Edges that a task merges at a time, which bounds its memory.
LOCAL_EDGES = 500_000


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def drain() -> pa.RecordBatch:
        rows = np.array([(x, root(x)) for x in list(parent) if root(x) != x], np.int64).reshape(-1, 2)
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
        if len(parent) > LOCAL_EDGES:
            yield drain()
    yield drain()


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node hands its larger (or smaller and own) neighbours to its smallest neighbour."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    sides = both if large else both.where("v < u")
    least = sides.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("_m", "u"))
    if large:
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
    moved = sides.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).where("u != v")
    return moved.union(least.select("u", F.col("_m").alias("v"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) edges, a stored table; component is the smallest node reachable."""
    e = stored(edges.toDF("a", "b").mapInArrow(_local_forest, "u long, v long").distinct())
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or now[0] == 0:
            break
        state, last = now, e
        e = stored(_stars(_stars(e, True), False))
        release(last)
    out = stored(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct().toDF("node", "component")))
    release(e)
    return out
