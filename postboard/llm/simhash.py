"""Near-duplicate texts by SimHash fingerprints and vantage-point trees.

Texts with equal fingerprints are one class from the start. The bits are cut into r + k blocks; two fingerprints with at
most r differing bits agree on at least k whole blocks. So each choice of k blocks (a band) partitions the fingerprints
without overlap, and pairs are sought only within one band value (a cell). With r = 4 and k = 2 there are 15 bands of 21
or 22 bits, so that even billions of fingerprints leave about a thousand to a cell. A cell with too many fingerprints is cut into shards, and every pair of shards is
searched, so pairs across a boundary are found too. Within a task a vantage-point tree finds the pairs: fingerprints
are split by their distance to a vantage point, and the triangle inequality leaves out branches that can hold no pair.
Each task returns a spanning forest of its pairs, never all of them; label propagation joins the forests.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise, rows_of

BITS = 64


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Bit i is set when it is set in over half the hashes of the text's word shingles; 0 for texts without words.

    bytes.lower() and bytes.split() know only ASCII: A-Z, and space and tab to carriage return.
    """
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(s) for s in zip(*[w[k:] for k in range(width)], strict=False)] or [b" ".join(w)]
    total, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(shingles), 8192):
        h = np.fromiter((digest(s, seed) for s in shingles[at : at + 8192]), np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(shingles), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 4, hashed: bool = False) -> DataFrame:
    """(doc_id, fp long) of each row, and text_hash if asked for."""
    extra = ["text_hash"] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts, *more in rows_of(batches, "doc_id", "text", *extra):
            fps = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            hashes = [pa.array(h[0], pa.int64()) for h in [more] if h]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(fps), *hashes], ["doc_id", "fp", *extra])

    rows = docs.select("doc_id", "text", *[F.xxhash64("text").alias(c) for c in extra])
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in extra))


class Forest:
    """Union of the pairs found so far, the smaller place as root."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def search(fps: np.ndarray, left: np.ndarray, right: np.ndarray | None, radius: int, forest: Forest, leaf: int = 64) -> None:
    """Join all pairs within the radius: inside `left`, or between `left` and `right` (places in fps).

    A vantage point that splits off less than a tenth of the pairs is given up: the places are halved instead.
    """
    stack = [(left, right)]
    size = lambda x, y: len(x) * (len(x) - 1) // 2 if y is None else len(x) * len(y)
    while stack:
        a, b = stack.pop()
        own, pairs = b is None, size(a, b)
        if not pairs:
            continue
        b = a if own else b
        if len(a) <= leaf and len(b) <= leaf:
            near = np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= radius
            x, y = np.nonzero(np.triu(near, 1) if own else near)
            for i, j in zip(a[x].tolist(), b[y].tolist(), strict=True):
                forest.join(i, j)
            continue
        vantage = fps[a[0]]
        da, db = np.bitwise_count(fps[a] ^ vantage).astype(int), np.bitwise_count(fps[b] ^ vantage).astype(int)
        cut = int(np.median(da if len(a) >= len(b) else db))
        # d(x, y) >= |d(x, v) - d(y, v)|: across the cut, only those within the radius of it can pair
        low_a, low_b = (da <= cut) & (da > cut - radius), (db <= cut) & (db > cut - radius)
        high_a, high_b = (da > cut) & (da <= cut + radius), (db > cut) & (db <= cut + radius)
        if own:
            parts = [(a[da <= cut], None), (a[da > cut], None), (a[low_a], a[high_a])]
        else:
            parts = [(a[da <= cut], b[db <= cut]), (a[da > cut], b[db > cut]), (a[low_a], b[high_b]), (a[high_a], b[low_b])]
        if max(size(*p) for p in parts) > 0.9 * pairs:
            h, k = len(a) // 2, len(b) // 2
            if own:
                parts = [(a[:h], None), (a[h:], None), (a[:h], a[h:])]
            else:
                parts = [(a[:h], b), (a[h:], b)] if len(a) >= len(b) else [(a, b[:k]), (a, b[k:])]
        stack += parts


def tile_links(tile: np.ndarray, fps: np.ndarray, side: np.ndarray, radius: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of sorted tiles; `side` tells a tile's two shards apart (0 only: one shard).

    Small tiles are compared all at once, each row with those a few places on; others have a vantage-point tree each.
    """
    forest = Forest(len(fps))
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    sizes = np.diff(np.r_[starts, len(tile)])
    two = np.bitwise_or.reduceat(side, starts).astype(bool)
    few = np.repeat(sizes <= small, sizes)
    paired = np.repeat(two, sizes)
    for k in range(1, min(small, int(sizes.max()))):
        i = np.flatnonzero(few[:-k] & (tile[:-k] == tile[k:]) & (~paired[:-k] | (side[:-k] != side[k:])))
        i = i[np.bitwise_count(fps[i] ^ fps[i + k]) <= radius]
        for x in i.tolist():
            forest.join(x, x + k)
    for at, n, both in zip(starts.tolist(), sizes.tolist(), two.tolist(), strict=True):
        if n > small:
            rows = np.arange(at, at + n)
            if both:
                search(fps, rows[side[rows] == 0], rows[side[rows] == 1], radius, forest)
            else:
                search(fps, rows, None, radius, forest)
    roots = np.fromiter(map(forest.root, range(len(fps))), int, len(fps))
    at = np.flatnonzero(roots != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return signed[roots[at]], signed[at]


def cells_of(distinct: DataFrame, radius: int, agree: int) -> DataFrame:
    """(fp, band, value): each fingerprint in a cell per choice of `agree` of the radius + agree blocks of its bits."""
    blocks = radius + agree
    bounds = [BITS * k // blocks for k in range(blocks + 1)]
    block = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    bands = []
    for band, chosen in enumerate(itertools.combinations(range(blocks), agree)):
        value = F.lit(0).cast("long")
        for k in chosen:
            value = F.shiftleft(value, bounds[k + 1] - bounds[k]).bitwiseOR(block[k])
        bands.append(F.struct(F.lit(band).alias("band"), value.alias("value")))
    return distinct.select("fp", F.inline(F.array(*bands)))


def links(distinct: DataFrame, radius: int, cell_rows: int, agree: int = 2) -> DataFrame:
    """(a, b): fingerprints joined by chains of pairs within the radius, a forest per tile."""
    cells = cells_of(distinct, radius, agree)
    sizes = cells.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("band", "value", F.ceil(F.col("n") / cell_rows).cast("int").alias("shards"))
    cells = cells.join(sizes, ["band", "value"]).withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
    with_each = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda o: F.struct(F.least("shard", o).alias("s"), F.greatest("shard", o).alias("t"), (F.col("shard") > o).cast("int").alias("side")),
    )
    keys = ["band", "value", "s", "t"]
    tiles = cells.select("fp", "band", "value", F.inline(with_each)).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tiles at a time: a batch's last tile waits for the next batch. A tile has at most two shards."""
        rest: list[np.ndarray] | None = None

        def tile_numbers(now: list[np.ndarray]) -> np.ndarray:
            moved = np.zeros(len(now[0]), bool)
            for column in now[: len(keys)]:
                moved[1:] |= column[1:] != column[:-1]
            return np.cumsum(moved)

        def found(tile: np.ndarray, part: list[np.ndarray]) -> pa.RecordBatch:
            x, y = tile_links(tile, part[-2].view(np.uint64), part[-1].astype(np.int8), radius)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

        for batch in batches:
            now = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in (*keys, "fp", "side")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if not len(now[0]):
                continue
            tile = tile_numbers(now)
            last = int(np.searchsorted(tile, tile[-1]))
            if last:
                yield found(tile[:last], [x[:last] for x in now])
            rest = [x[last:] for x in now]
        if rest is not None:
            yield found(tile_numbers(rest), rest)

    return tiles.mapInArrow(run, "a long, b long")


def dealt(df: DataFrame, by: str, salts: int = 8) -> DataFrame:
    """Adds salt by another column, so that the rows of a hot key go to several tasks of a join with every_salt()."""
    return df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)))


def every_salt(df: DataFrame, salts: int = 8) -> DataFrame:
    return df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of the edges, root being the least node (by value) of the component.

    Rounds of the large-star and small-star steps, each written before the next, until nothing changes.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = dealt(both, "v").join(every_salt(least), ["u", "salt"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(below.select("u", F.col("m").alias("v")))
        after = materialise(small.filter("u <> v").distinct(), "edges")
        sums = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sums(after) == sums(edges):
            return after.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = after
    raise RuntimeError("the components did not settle")


def labelled(prints: DataFrame, least: Column, radius: int, cell_rows: int, agree: int) -> DataFrame:
    """(_fp, least): for each fingerprint the least value of a column of prints in its component."""
    classes = prints.groupBy("fp").agg(least.alias("least"))
    roots = components(links(classes.select("fp"), radius, cell_rows, agree))
    members = roots.union(roots.select("root", "root").distinct())
    members = members.join(classes, members.node == classes.fp).select("node", "root", "least")
    ids = members.groupBy("root").agg(F.min("least").alias("of_all"))
    members = dealt(members, "node").join(every_salt(ids), ["root", "salt"]).select("node", "of_all")
    joined = classes.join(members, classes.fp == members.node, "left")
    return joined.select(F.col("fp").alias("_fp"), F.coalesce("of_all", "least").alias("least"))


def near_duplicates(docs: DataFrame, *, radius: int = 4, width: int = 4, cell_rows: int = 2048, agree: int = 2) -> DataFrame:
    """Per row: doc_id, fingerprint (hex) and component_id, the least doc_id reachable by links.

    Texts that are null or have no words share fingerprint zero. Rows without an id get a fingerprint; their component
    is the least id among the others, or null. Repeated rows are in one component.
    """
    prints = materialise(fingerprints(docs, width), "prints")
    labels = labelled(prints, F.min("doc_id"), radius, cell_rows, agree)
    prints, labels = dealt(prints, "doc_id"), every_salt(labels).withColumnRenamed("salt", "_salt")
    out = prints.join(labels, (prints.fp == labels["_fp"]) & (prints.salt == labels["_salt"]))  # copies in their thousands share a print
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def survivors(docs: DataFrame, *, radius: int = 4, width: int = 4, cell_rows: int = 2048, agree: int = 2) -> DataFrame:
    """(doc_id, text_hash) of one text per component: the least id, null ids last, then the least hash of the text."""
    prints = materialise(fingerprints(docs, width, hashed=True), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    return labelled(prints, first, radius, cell_rows, agree).select("least.doc_id", "least.text_hash").distinct()
