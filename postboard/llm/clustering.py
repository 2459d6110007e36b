"""Centroid clustering of integer vectors with scalar lookup tables.

Vectors travel as blocks that are coded by dimension: the sorted distinct integers that occur there, and for each vector the
place of its own. A round makes, per block and dimension, a table of squared differences of each occurring integer to each
centroid; distances are gathered from the tables and summed, with no arithmetic per vector but additions. Tasks send only sums
per cluster and dimension, cut into limbs of 30 bits, so that Spark adds them exactly whatever their size; what comes back is
bounded by clusters times dimensions. Vectors are never shuffled, so it does not matter which of them are alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise
from postboard.llm.topk import finite

BLOCK = "ids array<long>, codes binary, offsets binary, small binary, large array<string>"
LIMB = 30
#: Squared differences of numbers below this, added over 2**7 dimensions, fit 64 bits.
SMALL = 2**27
MOST = 2**63 - 1


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 32-bit numbers where all are small, else as Python's."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() < SMALL:
        return y.astype(np.int64)
    out = np.empty(y.shape, object)
    out.ravel()[:] = [int(a) * scale if abs(a) >= 2**53 else int(b) for a, b in zip(x.ravel().tolist(), y.ravel().tolist(), strict=True)]
    return out


def blocks(rows: DataFrame, dims: int, scale: int, most: int) -> DataFrame:
    """(vec_id, v) as coded blocks of at most `most` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, matrix = batch.column(0), np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, dims)
            for at in range(0, len(matrix), most):
                y = integers(matrix[at : at + most], scale)
                found = [np.unique(y[:, d], return_inverse=True) for d in range(dims)]
                values = np.concatenate([v for v, _ in found])
                large = values.dtype == object
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[at : at + most].to_pylist()], pa.list_(pa.int64())), pa.array([np.stack([c for _, c in found]).astype(np.uint16).tobytes()], pa.binary()),
                        pa.array([np.cumsum([0, *(len(v) for v, _ in found)]).astype(np.int64).tobytes()], pa.binary()),
                        pa.array([None if large else values.astype(np.int32).tobytes()], pa.binary()), pa.array([[str(v) for v in values] if large else None], pa.list_(pa.string())),
                    ],
                    ["ids", "codes", "offsets", "small", "large"],
                )

    return rows.select("vec_id", "v").mapInArrow(run, BLOCK)


def tabulated(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and squared distance of each vector of a block.

    64 bits do where all numbers are small. A few large centroids among small ones, as outliers leave them, do not slow a block
    down: one that is further from all its integers than any vector from its nearest small centroid is left out.
    """

    def distances(chosen: np.ndarray, kind: type) -> np.ndarray:
        own, middle = values.astype(kind), centroids[chosen].astype(kind)
        total = np.zeros((codes.shape[1], len(chosen)), kind)
        for d, code in enumerate(codes):
            table = (own[offsets[d] : offsets[d + 1], None] - middle[None, :, d]) ** 2
            total += table[code]
        return total

    most, size = np.abs(values).max(), np.abs(centroids).max(axis=1)
    small = np.flatnonzero(size < SMALL)
    if most >= SMALL or not len(small) or len(codes) > 128:
        chosen, total = np.arange(len(centroids)), distances(np.arange(len(centroids)), object)
    else:
        chosen, total = small, distances(small, np.int64)
        far = int(total.min(axis=1).max())
        if len(near := np.array([c for c in np.flatnonzero(size >= SMALL) if (int(size[c]) - int(most)) ** 2 <= far], int)):
            chosen, total = np.arange(len(centroids)), np.full((len(total), len(centroids)), 2**63, object)
            total[:, small], total[:, near] = distances(small, np.int64), distances(near, object)
    nearest = total.argmin(axis=1)
    return chosen[nearest], total[np.arange(len(total)), nearest]


def opened(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    for ids, codes, offsets, small, large in zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("ids", "codes", "offsets", "small", "large")], strict=True):
        values = np.array([int(v) for v in large], object) if small is None else np.frombuffer(small, np.int32).astype(np.int64)
        yield ids, values, np.frombuffer(offsets, np.int64), np.frombuffer(codes, np.uint16).reshape(dims, -1)


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """The number as (place, part) with parts below 2**30 in size that share its sign; zero has none."""
    sign, rest, k = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield k, sign * (rest & (2**LIMB - 1))
        rest, k = rest >> LIMB, k + 1


def sums(coded: DataFrame, centroids: list[list[int]], dims: int) -> dict[tuple[int, int], int]:
    """(cluster, dimension) to the sum over its vectors; dimension `dims` has their number, the one after it their distances."""
    middle = np.array(centroids, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(middle), dims + 2), object)
        for batch in batches:
            for _, values, offsets, codes in opened(batch, dims):
                nearest, distance = tabulated(values, offsets, codes, middle)
                vectors = np.stack([values[offsets[d] : offsets[d + 1]][code] for d, code in enumerate(codes)], axis=1)
                for c in np.unique(nearest).tolist():
                    mine = nearest == c
                    total[c] += np.array([*vectors[mine].sum(axis=0).tolist(), int(mine.sum()), sum(distance[mine].tolist())], object)
        parts = [(c, d, k, x) for (c, d), value in np.ndenumerate(total) for k, x in limbs(int(value))]
        columns = [*zip(*parts, strict=True)] or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["c", "d", "k", "part"])

    rows = coded.mapInArrow(run, "c long, d long, k long, part long").groupBy("c", "d", "k").agg(F.sum("part").alias("part")).collect()
    out: dict[tuple[int, int], int] = {}
    for r in rows:
        out[r.c, r.d] = out.get((r.c, r.d), 0) + (r.part << LIMB * r.k)
    return out


def first_centroids(rows: DataFrame, k: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of `seed:id`, in its order; ties by id and components, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.orderBy(mark.asc_nulls_last(), "vec_id", "v").limit(k).collect()
    return [[int(x) for x in integers(np.array(r.v, np.float64), scale)] for r in found]


def cluster(vectors: DataFrame, *, k: int = 40, dims: int = 64, scale: int = 256, rounds: int = 5, seed: int = 2, block: int = 4096) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row for each vector that is kept.

    Kept are vectors of exactly `dims` components, none null or not finite; their components become floor(scale * x). Every
    kept row counts, repeated ones too, and a null id is no hindrance (such rows come last among the first centroids). With
    fewer than k vectors there are as many centroids; without any, no rows. Centroids are updated `rounds` times by floors of
    exact means, then vectors are assigned once more. Distances and inertias beyond a long are given as 2**63 - 1; the
    choice of clusters is exact all the same. Other columns are not read.
    """
    rows = vectors.filter(F.coalesce(F.size("embedding") == dims, F.lit(False)) & finite(F.col("embedding"))).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    coded = materialise(blocks(rows, dims, scale, min(block, 65_536)), "blocks")
    centroids = first_centroids(rows, k, scale, seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        found = sums(coded, centroids, dims)
        centroids = [[found.get((c, d), 0) // found[c, dims] for d in range(dims)] if (c, dims) in found else old for c, old in enumerate(centroids)]
    found = sums(coded, centroids, dims)
    each = [found.get((c, dims + 1), 0) for c in range(len(centroids))]
    return assigned(coded, centroids, each, dims)


def assigned(coded: DataFrame, centroids: Sequence[Sequence[int]], inertia: Sequence[int], dims: int) -> DataFrame:
    """The vectors of coded blocks with their nearest centroids."""
    middle, total = np.array(centroids, object), min(sum(inertia), MOST)
    own = np.array([min(x, MOST) for x in inertia], np.int64)
    marks = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values, offsets, codes in opened(batch, dims):
                nearest, distance = tabulated(values, offsets, codes, middle)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(nearest, pa.int32()), pa.array([min(x, MOST) for x in distance.tolist()], pa.int64()), pa.array(own[nearest]),
                        pa.array(np.full(len(ids), total, np.int64)), pa.array(marks[nearest], pa.string()),
                    ],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return coded.mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
