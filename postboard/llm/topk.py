"""Exact top-k search by inner product: tiles of queries and candidates, partial selection, and merging of top lists.

Queries and candidates travel as blocks (one row holds ids and a matrix), dealt to groups of many blocks. Each group of
queries meets each group of candidates in one tile, so a vector is copied once per group of the other side, not once per
block. A pair of blocks in a tile is one matrix product and a selection of k per query. A task merges the lists of its
tiles, then lists are merged by query in two rounds, so no task ever holds more than a group of one side, a block of the
other, and k entries per query of the group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postboard.llm.common import materialise

BLOCK = "grp int, ids binary, dim int, vectors binary"


#: Beside a score: MIDDLE where it fits a long; else bytes that sort (unsigned) as the exact scores beyond do.
MIDDLE = b"\x80"


def finite(embedding: Column) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    fit = lambda x: ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & F.coalesce(fit(x), F.lit(False)))


def beyond(score: int) -> tuple[int, bytes]:
    """The nearest long (2**63 - 1 in size at most), and the bytes beside it."""
    if abs(score) < 2**63:
        return score, MIDDLE
    raw = abs(score).to_bytes(-(-score.bit_length() // 8), "big")
    key = len(raw).to_bytes(2, "big") + raw
    return (2**63 - 1, b"\xc0" + key) if score > 0 else (1 - 2**63, b"\x40" + bytes(255 - x for x in key))


def whole(x: np.ndarray, y: np.ndarray, scale: int) -> list[int]:
    """The scaled components y of a vector x, also where they are beyond a double."""
    return [int(t) if math.isfinite(t) else int(s) * scale for s, t in zip(x.tolist(), y.tolist(), strict=True)]


def large_scores(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray], own: np.ndarray, k: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per row of q: places in c that can be among the k best, and their exact scores (Python numbers).

    A product in double, with both sides brought to at most 1 in size, bounds each score; places whose upper bound is
    below the k-th lower bound are left out, as are a row's own ones. q and c hold the components before and after scaling.
    """
    fa, fb = (np.where(np.isfinite(y), y / scale, x) for x, y in (q, c))
    fa, fb = (np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) for x in (fa, fb))
    about = fa @ fb.T
    error = (fa.shape[1] + 4) * 2.0**-50 * (np.abs(fa) @ np.abs(fb).T) + 1e-290
    ints: dict[int, list[int]] = {}
    for x, y, low, high, mine in zip(*q, about - error, about + error, own, strict=True):
        at = np.flatnonzero(~mine)
        if len(at) > k:
            at = at[high[at] >= np.partition(low[at], len(at) - k)[len(at) - k]]
        query = whole(x, y, scale)
        for j in at.tolist():
            if j not in ints:
                ints[j] = whole(c[0][j], c[1][j], scale)
        out = np.empty(len(at), object)
        out[:] = [sum(u * v for u, v in zip(query, ints[j], strict=True)) for j in at.tolist()]
        yield at, out


def blocks(rows: DataFrame, groups: int, most: int, scale: int) -> DataFrame:
    """Pack (vec_id, v) into blocks of at most `most` rows of one length; a block's group follows from its ids.

    Scaled components travel as 32-bit numbers where all of a block fit; else the components travel as doubles, not scaled.
    """

    def packed(matrix: np.ndarray) -> bytes:
        with np.errstate(over="ignore"):
            y = np.floor(matrix * scale)
        return (y.astype(np.int32) if not y.size or np.abs(y).max() < 2**31 else matrix).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = np.asarray(vectors.value_lengths())
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                matrix = np.asarray(vectors.take(pa.array(at)).flatten(), np.float64).reshape(len(at), dim)
                for k in range(0, len(at), most):
                    part = ids[at[k : k + most]].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([xxhash.xxh3_64_intdigest(part.tobytes()) % groups], pa.int32()), pa.array([part.tobytes()]), pa.array([int(dim)], pa.int32()), pa.array([packed(matrix[k : k + most])])],
                        ["grp", "ids", "dim", "vectors"],
                    )

    return rows.select("vec_id", "v").mapInArrow(run, BLOCK)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of a row, ties to smaller ids: all above the k-th score, then the smallest at it."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda j: (-scores[j], ids[j]))[:k], int)
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def tiles(pairs: DataFrame, k: int, scale: int) -> DataFrame:
    """The lists of each task: query_id, vec_id, score, beyond."""

    def unpacked(raw: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """The components before and after scaling; where all fit 32 bits, both are the scaled ones."""
        if len(raw) == 4 * n * dim:
            y = np.frombuffer(raw, np.int32).reshape(n, dim).astype(np.float64)
            return y, y
        x = np.frombuffer(raw, np.float64).reshape(n, dim)
        with np.errstate(over="ignore"):
            return x, np.floor(x * scale)

    def rows_of_scores(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray], ids: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, exact scores) of each query, all of them or all that can count, in whichever numbers hold them."""
        a, b = q[1], c[1]
        most_a, most_b = (float(np.abs(x).max()) if x.size else 0.0 for x in (a, b))
        with np.errstate(over="ignore"):
            bound = np.float64(most_a) * most_b * a.shape[1]
        if bound < 2**53:  # exact in double
            yield from ((ids, row.astype(np.int64)) for row in a @ b.T)
        elif bound < 2**62 and max(most_a, most_b) < 2**62:
            yield from ((ids, row) for row in a.astype(np.int64) @ b.astype(np.int64).T)
        else:
            yield from ((ids[at], s) for at, s in large_scores(q, c, own, k, scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for q_ids, q, c_ids, c, dim in zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("q_ids", "q_vectors", "ids", "vectors", "dim")], strict=True):
                queries, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(c_ids, np.int64)
                scores = rows_of_scores(unpacked(q, len(queries), dim), unpacked(c, len(ids), dim), ids, queries[:, None] == ids[None, :])
                for query, (i, s) in zip(queries.tolist(), scores, strict=True):
                    other = i != query
                    s, i = s[other], i[other]
                    at = best(s, i, k)
                    s, i = s[at], i[at]
                    if query in lists:
                        s, i = np.concatenate([lists[query][0], s]), np.concatenate([lists[query][1], i])
                        at = best(s, i, k)
                        s, i = s[at], i[at]
                    lists[query] = s, i
            if len(lists) > 100_000:
                yield flat(lists)
                lists = {}
        yield flat(lists)

    def flat(lists: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        n = [len(s) for s, _ in lists.values()]
        ids = np.concatenate([x[1] for x in lists.values()]) if lists else np.zeros(0, np.int64)
        scores = [beyond(int(x)) for s, _ in lists.values() for x in s.tolist()]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([*lists], dtype=np.int64), n)), pa.array(ids), pa.array([x for x, _ in scores], pa.int64()), pa.array([x for _, x in scores], pa.binary())],
            ["query_id", "vec_id", "score", "beyond"],
        )

    return pairs.mapInArrow(run, "query_id long, vec_id long, score long, beyond binary")


def merged(lists: DataFrame, k: int, groups: int = 16) -> DataFrame:
    """Top k per query of many lists, in two rounds."""
    order = [F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id")]
    first = Window.partitionBy("query_id", "_group").orderBy(*order)
    lists = lists.withColumn("_group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, *, every: int = 100, k: int = 10, scale: int = 1024, block: int = 4096, most_grouped: int = 131_072) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row whose id is divisible by `every`.

    Vectors that are null, or hold a null or a component that is not finite, take no part, nor do rows without an id. Only
    vectors of equal length are compared. Rows with the query's own id are never its results; of several queries with
    one id, the smallest vector counts. Repeated candidate rows each count. All finite vectors take part, and ranks follow
    the exact scores; a score beyond a long is given as the nearest of -(2**63 - 1) and 2**63 - 1.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select("vec_id", F.col("embedding").alias("v"))
    rows = materialise(rows, "vectors")
    numbers = F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    numbers = F.transform(F.arrays_zip(numbers.alias("y"), F.col("v").alias("x")), lambda p: F.when(F.abs(p["x"].cast("double") * scale) < float(2**53), p["y"]).otherwise(p["x"].cast("double") * scale))
    least = F.min(F.struct(numbers.alias("y"), F.col("v")))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(least.alias("_l")).select("vec_id", F.col("_l.v").alias("v"))
    n, n_queries = rows.count(), queries.count()
    tasks = 4 * vectors.sparkSession.sparkContext.defaultParallelism
    grouped = max(block, min(most_grouped, math.isqrt(n * n_queries // tasks)))  # smaller groups where there would be few tiles
    c_groups, q_groups = max(1, -(-n // grouped)), max(1, -(-n_queries // grouped))
    each = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    q = blocks(queries, q_groups, block // 4, scale).select(F.col("grp").alias("q_grp"), F.col("ids").alias("q_ids"), F.col("dim").alias("q_dim"), F.col("vectors").alias("q_vectors"), each(c_groups).alias("c_grp"))
    c = blocks(rows, c_groups, block, scale).select("grp", "ids", "dim", "vectors", each(q_groups).alias("other"))
    pairs = c.join(q, (c.grp == q.c_grp) & (c.other == q.q_grp) & (c.dim == q.q_dim)).select("q_ids", "q_vectors", "ids", "vectors", "dim")
    return merged(tiles(pairs, k, scale), k)
