"""Exact linking inside candidate lists, without a row for each pair of a list.

Sets x and y link when their Jaccard similarity reaches t. A list names sets that
may link, and only components of links are asked for.

1. Hubs: the set of a list that stands in most lists is its hub, and lists of one
   hub are one group. A hub is compared with every member of its group, which
   makes as many rows as the group has members.
2. Components of these links: what lies in one component need not meet again, so
   a family of near copies is settled by its hub, however large it is.
3. Tiles: members outside their hub's component are compared with the group's
   others. Both are packed into blocks of bounded size, and a row is a pair of
   blocks. Inside a tile, overlaps of all its pairs are counted by a product of
   incidence matrices; a tile passes on a forest of its links.
4. Components of both.

Every pair of a list is thus tested or known to be connected. Where sets come with
a sketch (their smallest elements), pairs of hubs and of tiles are first estimated
by the union of the two sketches, and only what passes is tested in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogspark.llm import blocks as B
from catalogspark.llm.common import partitions, release, stored
from catalogspark.llm.components import connected

#: Members, and elements of members, of one block.
BLOCK_SETS = 256
BLOCK_ELEMENTS = 1 << 18
#: Elements of one matrix product.
COLUMNS = 4096
#: Pairs that are tested one by one rather than by a product.
FEW = 64
#: Tiles decoded together.
TOGETHER = 32

Decode = Callable[[list[bytes]], list[np.ndarray]]
Sketch = tuple[int, float]  # elements, and the lowest estimate that may link


def groups(lists: DataFrame) -> DataFrame:
    """(g, rep): the members of each hub's group, from (value, rep) lists; the hub g is one of them."""
    often = lists.groupBy("rep").agg((-F.count(F.lit(1))).alias("w"))
    weighed = lists.join(often, "rep")
    hubs = weighed.groupBy("value").agg(F.min(F.struct("w", "rep")).alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1")
    return lists.join(hubs.select("value", F.col("hub.rep").alias("g")), "value").select("g", "rep").distinct()


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def estimates(x: np.ndarray, y: np.ndarray, k: int) -> bool | float:
    """Jaccard similarity by the k smallest elements of the union of two sketches."""
    both = np.concatenate([x[:k], y[:k]])
    both.sort()
    twice = both[1:] == both[:-1]
    ends = np.flatnonzero(np.concatenate([[True], ~twice]))
    last = ends[k] if len(ends) > k else len(both)
    return int(twice[: max(last - 1, 0)].sum()) / max(min(k, len(ends)), 1)


def link(x: np.ndarray, y: np.ndarray, percent: int, sketch: Sketch | None) -> bool:
    """One pair: by size, by estimate, then in full."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if sketch is not None and estimates(x, y, sketch[0]) < sketch[1]:
        return False
    return (100 + percent) * _shared(x, y) >= percent * (len(x) + len(y))


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many elements each of xs shares with each of ys."""
    out = np.zeros((len(xs), len(ys)), np.float32)
    if not xs or not ys:
        return out
    ex, ey = np.concatenate(xs), np.concatenate(ys)
    common = np.intersect1d(ex, ey)
    sides = []
    for values, sets in ((ex, xs), (ey, ys)):
        at, found = B.find(common, values)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[found]
        at = at[found]
        order = np.argsort(at, kind="stable")
        sides.append((row[order], at[order]))
    for first in range(0, len(common), COLUMNS):
        left, right = (np.zeros((len(s), COLUMNS), np.float32) for s in (xs, ys))
        for matrix, (row, at) in zip((left, right), sides, strict=True):
            a, b = np.searchsorted(at, [first, first + COLUMNS])
            matrix[row[a:b], at[a:b] - first] = 1
        out += left @ right.T
    return out


def tile_links(xs: list[np.ndarray], ys: list[np.ndarray], apart: np.ndarray, percent: int, sketch: Sketch | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the pairs that link, among those that are apart so far."""
    nx, ny = (np.array([len(s) for s in sets], np.int64) for sets in (xs, ys))
    low, high = np.minimum(nx[:, None], ny[None, :]), np.maximum(nx[:, None], ny[None, :])
    left = apart & (100 * low >= percent * high)
    if left.sum() <= FEW:
        pairs = np.array([(i, j) for i, j in zip(*np.nonzero(left), strict=True) if link(xs[i], ys[j], percent, sketch)], np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]
    if sketch is not None:  # no estimate is above the share of the sketches' common elements
        k, lowest = sketch
        left &= overlaps([x[:k] for x in xs], [y[:k] for y in ys]) >= lowest * np.minimum(k, low)
        for i, j in zip(*np.nonzero(left), strict=True):
            left[i, j] = estimates(xs[i], ys[j], k) >= lowest
    if left.any():
        rows, cols = np.flatnonzero(left.any(axis=1)), np.flatnonzero(left.any(axis=0))
        count = overlaps([xs[i] for i in rows], [ys[j] for j in cols]).astype(np.int64)
        left[np.ix_(rows, cols)] &= (100 + percent) * count >= percent * (nx[rows][:, None] + ny[cols][None, :])
    return np.nonzero(left)


def test_stars(batches: Iterator[pa.RecordBatch], decode: Decode, percent: int, sketch: Sketch | None) -> Iterator[pa.RecordBatch]:
    """The (a, b) rows that link."""
    for batch in batches:
        hubs = batch.column("a").to_pylist()
        first = {h: i for i, h in reversed(list(enumerate(hubs)))}
        sets = dict(zip(first, decode(batch.column("xa").take(pa.array(list(first.values()), pa.int64())).to_pylist()), strict=True))
        keep = [link(sets[h], x, percent, sketch) for h, x in zip(hubs, decode(batch.column("xb").to_pylist()), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """As few of the edges as join the same nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            out.append((x, y))
    return out


def _members(column: pa.ListArray, decode: Decode) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Components and sets of the blocks of a few tiles, decoded together."""
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = column.flatten()
    comps, sets = flat.field("c").to_numpy(), decode(flat.field("body").to_pylist())
    ends = np.cumsum(size).tolist()
    return [(comps[b - n : b], sets[b - n : b]) for b, n in zip(ends, size.tolist(), strict=True)]


def test_tiles(batches: Iterator[pa.RecordBatch], decode: Decode, percent: int, sketch: Sketch | None) -> Iterator[pa.RecordBatch]:
    """Edges between components that a tile links."""
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(start, TOGETHER)
            both = zip(_members(part.column("left"), decode), _members(part.column("right"), decode), part.column("right").is_null().to_pylist(), strict=True)
            edges = []
            for left, right, own in both:
                (ca, xs), (cb, ys) = left, left if own else right
                apart = ca[:, None] != cb[None, :]
                if own:
                    apart &= np.arange(len(ca))[:, None] < np.arange(len(ca))[None, :]
                i, j = tile_links(xs, ys, apart, percent, sketch)
                edges += _forest(ca[i].tolist(), cb[j].tolist())
            found = np.array(edges, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def tiles(members: DataFrame, parts: DataFrame, bodies: DataFrame) -> DataFrame:
    """(left, right): pairs of blocks that may hold links between components; right is null for a block with itself."""
    comp = parts.select(F.col("node").alias("rep"), F.col("component").alias("c"))
    marked = members.join(comp, "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    others = marked.where("rep != g").join(comp.toDF("g", "hc"), "g", "left").withColumn("far", F.col("c") != F.coalesce("hc", "g"))
    sized = others.join(bodies.select("rep", F.octet_length("body").alias("size")), "rep")
    parts_of = lambda n, size: F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(size / (8 * BLOCK_ELEMENTS))).cast("int")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"), F.count_if("far").alias("nf"), F.sum(F.when(F.col("far"), F.col("size")).otherwise(0)).alias("sf"), F.min("c").alias("lo"), F.max("c").alias("hi")]
    heads = sized.groupBy("g").agg(*sums).where("nf > 0 and lo < hi")
    one = parts_of(F.col("n"), F.col("s")) == 1
    heads = heads.select("g", F.when(one, 1).otherwise(parts_of(F.col("nf"), F.col("sf"))).alias("f"), F.when(one, 0).otherwise(parts_of(F.col("n") - F.col("nf"), F.col("s") - F.col("sf"))).alias("m"))
    heads = stored(heads)
    placed = others.join(heads, "g").withColumn("h", F.xxhash64(F.lit(3), "rep"))
    block = F.when(F.col("far") | (F.col("m") == 0), F.pmod("h", F.greatest("f", F.lit(1)))).otherwise(F.col("f") + F.pmod("h", F.greatest("m", F.lit(1)))).cast("int")
    filled = placed.withColumn("block", block).join(bodies, "rep").groupBy("g", "block").agg(F.collect_list(F.struct("c", "body")).alias("sets"))  # bounded by the block's size
    filled = stored(filled)
    pairs = heads.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("f") - 1))).withColumn("j", F.explode(F.sequence("i", F.col("f") + F.col("m") - 1))).select("g", "i", "j")
    left, right = filled.toDF("g", "i", "left"), filled.toDF("g", "j", "right")
    own = pairs.where("i = j").join(left, ["g", "i"]).select("g", "i", "j", "left", F.lit(None).cast(right.schema["right"].dataType).alias("right"))
    met = pairs.where("i < j").join(left, ["g", "i"]).join(right, ["g", "j"]).select("g", "i", "j", "left", "right")
    # Few, heavy rows: dealt so that every core gets some.
    out = own.unionByName(met).repartition(4 * partitions(members.sparkSession), "g", "i", "j").select("left", "right")
    out._behind = (heads, filled)
    return out


def linked(lists: DataFrame, bodies_of: Callable[[DataFrame], DataFrame], decode: Decode, percent: int, sketch: Sketch | None = None) -> DataFrame:
    """(node, component) of all sets that link, directly or through others, among those listed in (value, rep); a stored table.

    bodies_of takes a table of ids (`rep`) and returns (rep, body), with the stored
    tables it reads in `_behind`; decode turns bodies into sorted arrays of distinct
    elements of 8 bytes. Tables are deleted
    when the next ones stand.
    """
    members = stored(groups(lists))
    wanted = bodies_of(members.select("rep").distinct())
    bodies = stored(wanted)
    release(*getattr(wanted, "_behind", ()))
    stars = members.where("rep != g").toDF("a", "b").join(bodies.toDF("b", "xb"), "b").join(bodies.toDF("a", "xa"), "a")
    near = stored(stars.select("a", "b", "xa", "xb").mapInArrow(lambda it: test_stars(it, decode, percent, sketch), "a long, b long"))
    parts = connected(near)
    release(near)
    met = tiles(members, parts, bodies)
    more = stored(met.mapInArrow(lambda it: test_tiles(it, decode, percent, sketch), "a long, b long"))
    release(members, bodies, *met._behind)
    if more.isEmpty():
        return parts
    out = connected(parts.union(more))
    release(parts, more)
    return out
