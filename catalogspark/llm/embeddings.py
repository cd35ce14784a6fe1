"""Embedding near-dedup by PCA-ordered tiled comparison.

1. Equal vectors are one class with a count. Second moments of the unit vectors
   are summed per cell on the cluster; the driver gets d * d numbers and their
   eigenvectors, the largest first.
2. Vectors are ranged by their first coordinate and cut into tiles. A tile's
   summary holds the box of its leading coordinates. Unit vectors with cosine >= t
   differ by at most sqrt(2 - 2t), so tiles meet by cells of that width along
   the first coordinate, and only if their boxes come that near.
3. A pair of tiles is compared in strips. Products of the leading coordinates are
   added up first; what the rest can add is at most the product of the suffix
   norms. A strip stops when no pair can reach t. Pairs left are decided by the
   double-precision cosine of the vectors as given.
4. Link counts are summed by class; a tile pair passes on one edge a linked
   class, from a union of its links, and distributed union-find does the rest.

Near-isotropic vectors are near nothing along any few axes, so boxes part few tiles
and the comparison is quadratic in the vectors; what the method saves there is
the products of the later axes.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; a shorter vector reads as if padded with zeros;
rows that share an id are vectors of their own; rows without one sort last; other columns, whatever their names, stay out of the
result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogspark.llm.common import NO_ID, partitions, release, stored
from catalogspark.llm.components import connected

COSINE = 0.95
#: Vectors of a tile. A pair of tiles is one row, so twice the size halves what is sent.
TILE = 8192
STRIP = 512
#: Tiles that one task cuts from its range.
RANGE_TILES = 4
LEAD = 8
#: Rounding allowed for in bounds; the final cosine has none.
SLACK = 1e-6
TILES = "tile long, cell int, n int, lows array<double>, highs array<double>, reps binary, counts binary, vectors binary"


def valid(vector: str = "embedding"):
    """True for vectors that can link at all."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    at = np.arange(width)[None, :] < sizes[:, None]
    out[at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Columns: eigenvectors of the second moments of all unit vectors, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            if b.num_rows:
                u = _unit(_matrix(b.column("embedding"), width))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width, dtype=np.int64)), pa.array(total.ravel())], names=["cell", "v"])

    moments = np.zeros(width * width)
    for row in classes.select("embedding").mapInArrow(run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect():  # width**2 numbers
        moments[row.cell] = row.v
    moments = moments.reshape(width, width)
    return np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1].copy()


def tiles(classes: DataFrame, axes: np.ndarray, cosine: float, size: int, kind: type) -> DataFrame:
    """Tiles of vectors next to each other along the first axis; stored, so that their numbers stay."""
    width, reach = len(axes), (2 - 2 * cosine) ** 0.5 + SLACK

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _unit(_matrix(b.column("embedding"), width)) @ axes[:, 0] if b.num_rows else np.zeros(0)
            yield b.append_column("z", pa.array(z))

    def cut(key, table: pa.Table) -> pa.Table:
        table = table.sort_by([("z", "ascending"), ("rep", "ascending")])
        rows: dict[str, list] = {k.split()[0]: [] for k in TILES.split(", ")}
        for i in range(0, table.num_rows, size):
            part = table.slice(i, size)
            x = _matrix(part.column("embedding").combine_chunks(), width)
            z = _unit(x) @ axes[:, :LEAD]
            reps, counts = part.column("rep").to_numpy(), part.column("m").to_numpy()
            values = (key[0].as_py() * (1 << 32) + i // size, int(np.floor(z[:, 0].min() / reach)), len(x), z.min(axis=0), z.max(axis=0), reps.tobytes(), counts.tobytes(), x.astype(kind).tobytes())
            for k, v in zip(rows, values, strict=True):
                rows[k].append(v)
        return pa.table({"tile": pa.array(rows["tile"], pa.int64()), "cell": pa.array(rows["cell"], pa.int32()), "n": pa.array(rows["n"], pa.int32()), "lows": pa.array(rows["lows"], pa.list_(pa.float64())), "highs": pa.array(rows["highs"], pa.list_(pa.float64()))} | {k: pa.array(rows[k], pa.binary()) for k in ("reps", "counts", "vectors")})

    placed = classes.mapInArrow(first, f"embedding array<{'float' if kind is np.float32 else 'double'}>, rep long, m long, z double")
    parts = max(1, -(-classes.count() // (RANGE_TILES * size)))
    ranged = placed.repartitionByRange(parts, "z").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged)
    out = stored(ranged.groupBy("part").applyInArrow(lambda key, t: cut(key, t), TILES))
    release(ranged)
    return out


def near_tiles(summary: DataFrame, cosine: float) -> DataFrame:
    """(a, b), a <= b: tiles whose boxes come within reach of each other."""
    reach = (2 - 2 * cosine) ** 0.5 + SLACK
    # A tile stands in every cell its box covers, and meets those that begin in the same or the next one.
    spread = F.sequence(F.col("cell"), (F.floor(F.element_at("highs", 1) / reach) + 1).cast("int"))
    left = summary.select(F.col("tile").alias("a"), F.col("lows").alias("la"), F.col("highs").alias("ha"), F.explode(spread).alias("cell"))
    right = summary.select(F.col("tile").alias("b"), F.col("lows").alias("lb"), F.col("highs").alias("hb"), "cell")
    gap = F.aggregate(
        F.zip_with(F.zip_with("la", "hb", lambda x, y: x - y), F.zip_with("lb", "ha", lambda x, y: x - y), lambda p, q: F.greatest(p, q, F.lit(0.0))),
        F.lit(0.0),
        lambda acc, g: acc + g * g,
    )
    met = left.join(right, "cell").where(gap <= reach * reach)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def strips(xa: np.ndarray, xb: np.ndarray, axes: np.ndarray, cosine: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, hits) of each strip of two tiles with a pair that reaches the cosine: leading products first, suffix norms as the bound."""
    ua, ub = _unit(xa), _unit(xb)
    za, zb = ua @ axes, ub @ axes
    width = za.shape[1]
    steps = [s for s in (LEAD, 2 * LEAD, 4 * LEAD) if s < width]
    sa = {s: np.sqrt(np.maximum((za[:, s:] ** 2).sum(axis=1), 0)) for s in steps}
    sb = {s: np.sqrt(np.maximum((zb[:, s:] ** 2).sum(axis=1), 0)) for s in steps}
    for i in range(0, len(xa), STRIP):
        for j in range(0, len(xb), STRIP):
            p, q = slice(i, i + STRIP), slice(j, j + STRIP)
            done, total = 0, np.zeros((len(za[p]), len(zb[q])))
            left = np.ones(total.shape, bool)
            for s in steps:
                total += za[p, done:s] @ zb[q, done:s].T
                done = s
                left = total + np.outer(sa[s][p], sb[s][q]) >= cosine - SLACK
                if left.mean() < 0.02:
                    break
            r, c = np.nonzero(left)
            hits = np.zeros(total.shape, bool)
            for k in range(0, len(r), 1 << 16):
                rr, cc = r[k : k + (1 << 16)], c[k : k + (1 << 16)]
                hits[rr, cc] = np.einsum("ij,ij->i", ua[rr + i], ub[cc + j]) >= cosine
            if hits.any():
                yield i, j, hits


def _labels(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row that each row and column is joined to by the links (rows count on for none)."""
    rows, cols = np.arange(hit.shape[0]), np.full(hit.shape[1], hit.shape[0])
    while True:
        c = np.where(hit, rows[:, None], hit.shape[0]).min(axis=0)
        r = np.minimum(rows, np.where(hit, c[None, :], hit.shape[0]).min(axis=1))
        if (r == rows).all() and (c == cols).all():
            return rows, cols
        rows, cols = r, c


def _compare_tiles(batches: Iterator[pa.RecordBatch], axes: np.ndarray, cosine: float, kind: type) -> Iterator[pa.RecordBatch]:
    """(rep, links, root): the links of each vector in a strip, counted with copies, and a vector that it is joined to there."""
    width = len(axes)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            xa, xb = (np.frombuffer(row[k], kind).reshape(-1, width).astype(np.float64) for k in ("va", "vb"))
            ra, rb, ma, mb = (np.frombuffer(row[k], np.int64) for k in ("ra", "rb", "ma", "mb"))
            same = row["a"] == row["b"]
            na, nb = np.zeros(len(ra), np.int64), np.zeros(len(rb), np.int64)
            edges = [np.zeros((0, 2), np.int64)]
            for i, j, hit in strips(xa, xb, axes, cosine):
                if same and i == j:
                    np.fill_diagonal(hit, False)
                p, q = slice(i, i + hit.shape[0]), slice(j, j + hit.shape[1])
                na[p] += hit @ mb[q]
                nb[q] += hit.T @ ma[p]
                rows, cols = _labels(hit)
                la, lb = np.flatnonzero(rows != np.arange(len(rows))), np.flatnonzero(hit.any(axis=0))
                edges += [np.stack([ra[p][la], ra[p][rows[la]]], 1), np.stack([rb[q][lb], ra[p][cols[lb]]], 1)]
            joined = np.unique(np.concatenate(edges), axis=0)
            joined = joined[joined[:, 0] != joined[:, 1]]
            sides = [(ra, na)] if same else [(ra, na), (rb, nb)]
            node = np.concatenate([r[n > 0] for r, n in sides] + [joined[:, 0]])
            links = np.concatenate([n[n > 0] for _, n in sides] + [np.zeros(len(joined), np.int64)])
            root = np.concatenate([r[n > 0] for r, n in sides] + [joined[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links), pa.array(root)], names=["rep", "links", "root"])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    kind = np.float32 if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else np.float64  # as given, so that nothing is rounded
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("embedding").cast(T.ArrayType(T.FloatType() if kind is np.float32 else T.DoubleType())).alias("embedding")).withColumn("ok", valid())
    keyed = rows.withColumn("k1", F.when(F.col("ok"), F.xxhash64("embedding"))).withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit(7), F.reverse("embedding"))))
    classes = stored(keyed.where("ok").groupBy("k1", "k2").agg(F.min_by("embedding", "vec_id").alias("embedding"), F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("m")).withColumn("node", F.xxhash64("k1", "k2")))
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    axes = principal_axes(classes, width)
    cut = tiles(classes.select("embedding", F.col("node").alias("rep"), "m"), axes, cosine, tile, kind)
    pairs = stored(near_tiles(cut.select("tile", "cell", "lows", "highs"), cosine))
    side = lambda t, s: cut.select(F.col("tile").alias(t), F.col("reps").alias(f"r{s}"), F.col("counts").alias(f"m{s}"), F.col("vectors").alias(f"v{s}"))
    # Few, heavy rows: dealt so that every core gets some.
    both = pairs.join(side("a", "a"), "a").join(side("b", "b"), "b").repartition(max(4 * partitions(vectors.sparkSession), 1), "a", "b")
    found = stored(both.mapInArrow(lambda it: _compare_tiles(it, axes, cosine, kind), "rep long, links long, root long"))
    release(cut, pairs)
    counts = found.groupBy(F.col("rep").alias("node")).agg(F.sum("links").alias("links"))
    parts = connected(found.where("rep != root").select("rep", "root"))
    grouped = classes.select("node", "vec_id").join(parts, "node")
    least = grouped.groupBy("component").agg(F.min("vec_id").alias("least"))
    joined = grouped.join(least, "component").select("node", "least")
    placed = (
        classes.select("k1", "k2", "node", "vec_id", "m")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    )
    placed = stored(placed)
    release(found, parts, classes)
    out = keyed.select("vec_id", "k1", "k2").join(placed, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return out.withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in ("vec_id", "component_id")})
