"""Z-fast trie over conversations: what is shared between the beginnings of conversations.

A conversation is a string of turns. Each of its prefixes has a digest, made in segments so that no conversation need fit a row.
Distinct conversations go into a compacted trie in batches. A node of it is an edge (p, e] of the path of the conversation
that came first there, its owner. A hash table keyed by the digest at each node's handle, the depth in (p, e] that is divisible
by the highest power of two, is the z-fast trie's map: a conversation finds the node in which it leaves the trie by fat binary
search, one join for each bit of its length, then compares itself along that one edge.

Conversations of a batch that leave at one place with the same next turn are a class. The one with the least hash becomes a
path of its own, the others are compared with it and form new classes. As the choice is random, a conversation sees about as
many rounds as the logarithm of its class. The paths hung on a path, those hung on these and so on are as few, so each
conversation knows the chain of paths above it, and sums over subtrees are one aggregation along the chains.

Conversations that branch off one path at m different depths have m * m / 2 turns at least, so the windows over the branchings
of a path are small against the rows: the square root of twice their number at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postboard.llm.common import materialise
from postboard.operators.ranking import global_row_number

#: Turns of a segment, and whole numbers that one row opens into.
SEGMENT, CHUNK = 64, 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def digest(c: Column) -> Column:
    return F.unhex(F.md5(c))


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, own, bytes): each turn's place from 1, its digest and the UTF-8 length of its text. Equal turn numbers are
    put in the order of the digests."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", own.alias("own"), F.octet_length(text).cast("long").alias("bytes"))
    rows = materialise(global_row_number(materialise(rows, "turns"), [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("own")], "row").drop("turn"), "numbered")
    first = rows.groupBy("conv_id").agg((F.min("row") - 1).alias("_before"))
    return rows.join(first, "conv_id").select("conv_id", (F.col("row") - F.col("_before")).alias("k"), "own", "bytes")


def rebuilt(turns: DataFrame, span: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n) and (conv_id, d, own, bytes) of the rebuilt conversations: the first h turns of conversation c - c % span,
    then c's own ones after its first h, with h = crc32(c) % most."""
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("turns")).withColumn("base", F.col("conv_id") - F.col("conv_id") % span)
    sizes = sizes.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    bases = sizes.filter("conv_id = base").select("base", F.col("turns").alias("base_turns"))
    convs = sizes.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = materialise(convs.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("n")), "convs")
    heads = turns.filter((F.col("conv_id") % span == 0) & (F.col("k") < most)).select(F.col("conv_id").alias("base"), F.col("k").alias("d"), "own", "bytes")
    lead = convs.filter("lead > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "lead")).alias("d")).join(heads, ["base", "d"])
    rest = turns.join(convs, "conv_id").filter("k > h").select("conv_id", (F.col("lead") + F.col("k") - F.col("h")).alias("d"), "own", "bytes")
    return convs.select("conv_id", "n"), lead.select("conv_id", "d", "own", "bytes").unionByName(rest)


def scanned(turns: DataFrame, longest: int) -> DataFrame:
    """(conv_id, d, digest, bytes, upto): the digest of the first d turns, the bytes of the d-th and of the first d.

    Segments are scanned each on its own; their totals are scanned in the same way and put before. A digest depends on the
    first d turns alone.
    """
    segment = F.expr(f"(d - 1) div {SEGMENT}")
    rows = turns.groupBy("conv_id", segment.alias("segment")).agg(F.sort_array(F.collect_list(F.struct("d", "own", "bytes"))).alias("rows"))  # at most SEGMENT of them
    start = F.struct(F.lit(b"").alias("digest"), F.lit(0).cast("long").alias("upto"), F.array().cast("array<struct<d:bigint,digest:binary,bytes:bigint,upto:bigint>>").alias("out"))

    def step(before: Column, x: Column) -> Column:
        now = F.struct(x["d"].alias("d"), digest(F.concat(before["digest"], x["own"])).alias("digest"), x["bytes"].alias("bytes"), (before["upto"] + x["bytes"]).alias("upto"))
        return F.transform(F.array(now), lambda y: F.struct(y["digest"].alias("digest"), y["upto"].alias("upto"), F.array_append(before["out"], y).alias("out")))[0]

    rows = rows.select("conv_id", "segment", F.aggregate("rows", start, step).alias("all"))
    if longest <= SEGMENT:
        return rows.select("conv_id", F.inline("all.out"))
    rows = materialise(rows, "segments")
    totals = scanned(rows.select("conv_id", (F.col("segment") + 1).alias("d"), F.col("all.digest").alias("own"), F.col("all.upto").alias("bytes")), -(-longest // SEGMENT))
    before = totals.select(F.col("conv_id"), F.col("d").alias("segment"), F.col("digest").alias("_digest"), F.col("upto").alias("_upto"))
    parts = rows.select("conv_id", "segment", F.inline("all.out")).join(before, ["conv_id", "segment"], "left")
    whole = F.when(F.col("_digest").isNull(), F.col("digest")).otherwise(digest(F.concat("_digest", "digest")))
    return parts.select("conv_id", "d", whole.alias("digest"), "bytes", (F.col("upto") + F.coalesce("_upto", F.lit(0))).alias("upto"))


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that is divisible by the highest power of two: high without the bits after the first in
    which both differ."""
    bits = (F.length(F.bin(low.bitwiseXOR(high))) - 1).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def edges(placed: DataFrame) -> DataFrame:
    """(owner, p, e) of the compacted nodes: what lies between places on a path where something ends or is hung."""
    paths = placed.filter("path")
    places = paths.select(F.col("sid").alias("owner"), F.col("x").alias("e")).union(paths.select("sid", "n")).union(placed.filter("owner is not null").select("owner", "x")).distinct()
    return places.withColumn("p", F.lag("e").over(Window.partitionBy("owner").orderBy("e"))).filter("p is not null")


def locate(placed: DataFrame, strings: DataFrame, prefixes: DataFrame, longest: int) -> DataFrame:
    """Adds owner, x and chain: on whose path, at which depth and below which paths each string leaves the trie.

    A string that leaves at the root has no owner.
    """
    nodes = materialise(edges(placed), "nodes")
    at = prefixes.select(F.col("sid").alias("owner"), "d", "digest")
    handles = nodes.withColumn("d", fattest(F.col("p"), F.col("e"))).join(at, ["owner", "d"]).select(F.col("digest").alias("handle"), F.struct("owner", "p", "e", F.col("d").alias("f")).alias("found"))
    entries = nodes.withColumn("d", F.col("p") + 1).join(at, ["owner", "d"]).select(F.col("digest").alias("handle"), F.struct("owner", "p", "e", "d").alias("child"))
    handles, entries = materialise(handles, "handles"), materialise(entries, "entries")
    df = strings.withColumn("low", F.lit(0).cast("long")).withColumn("high", F.col("n")).withColumn("node", F.lit(None).cast("struct<owner:bigint,p:bigint,e:bigint,f:bigint>"))
    none = digest(F.concat(F.lit("none"), F.col("sid").cast("string")).cast("binary"))  # matches nothing, and is spread evenly

    def asked(df: DataFrame, depth: Column, table: DataFrame) -> DataFrame:
        own = prefixes.select("sid", F.col("d").alias("try"), "digest")
        df = df.withColumn("try", depth).join(own, ["sid", "try"], "left").withColumn("digest", F.coalesce("digest", none))
        return df.join(table, F.col("digest") == F.col("handle"), "left").drop("digest", "handle")

    for _ in range(max(1, longest).bit_length()):
        df = asked(df, F.when(F.col("low") < F.col("high"), fattest(F.col("low"), F.col("high"))), handles)
        hit = F.col("found").isNotNull()
        high = F.when(hit | F.col("try").isNull(), F.col("high")).otherwise(F.col("try") - 1)
        df = df.withColumn("high", high).withColumn("low", F.when(hit, F.col("found.e")).otherwise(F.col("low"))).withColumn("node", F.coalesce("found", "node")).drop("found", "try")
    df = asked(df, F.coalesce("node.e", F.lit(0)) + 1, entries).drop("try")
    df = df.withColumn("owner", F.coalesce("child.owner", "node.owner")).withColumn("a", F.coalesce("child.d", "node.f", F.lit(0).cast("long"))).withColumn("b", F.least("n", F.coalesce("child.e", "node.e", F.lit(0).cast("long"))))
    df = materialise(df.drop("low", "high", "node", "child"), "located")
    df = along(df, prefixes, "owner", F.col("a"), F.col("b"))
    chains = placed.filter("path").select(F.col("sid").alias("_sid"), above().alias("chain"))
    df = df.join(chains, F.col("owner") == F.col("_sid"), "left").withColumn("chain", F.coalesce("chain", F.array().cast(CHAIN)))
    return df.select("sid", "n", "copies", "owner", "x", "chain")


CHAIN = "array<struct<owner:bigint,x:bigint>>"


def above() -> Column:
    """The chain of the paths above a path, from what its string has."""
    return F.when(F.col("owner").isNull(), F.col("chain")).otherwise(F.array_append("chain", F.struct("owner", "x")))


def along(df: DataFrame, prefixes: DataFrame, path: str, low: Column, high: Column) -> DataFrame:
    """Adds x: how far a string that equals a path up to `low` goes along with it, up to `high` at most."""
    own = df.select("sid", F.col(path).alias("_path"), low.alias("_a"), high.alias("_b")).filter("_b > _a").join(prefixes.select("sid", "d", "digest"), "sid").filter("d > _a and d <= _b")
    other = prefixes.select(F.col("sid").alias("_path"), "d", F.col("digest").alias("_digest"))
    far = own.join(other, ["_path", "d"]).filter("digest = _digest").groupBy("sid").agg(F.max("d").alias("_far"))
    return df.join(far, "sid", "left").withColumn("x", F.coalesce("_far", low)).drop("_far")


def insert(placed: DataFrame | None, strings: DataFrame, prefixes: DataFrame, longest: int) -> list[DataFrame]:
    """Places strings (sid, n, copies) in the trie; the tables of the rounds, each (sid, n, copies, owner, x, chain, path)."""
    if placed is None:
        pool = strings.withColumn("owner", F.lit(None).cast("long")).withColumn("x", F.lit(0).cast("long")).withColumn("chain", F.array().cast(CHAIN))
    else:
        pool = locate(placed, strings, prefixes, longest)
    out = []
    while True:
        after = prefixes.select("sid", (F.col("d") - 1).alias("x"), F.col("digest").alias("next"))
        pool = materialise(pool.join(after, ["sid", "x"], "left"), "pool")
        first = pool.filter("next is not null").groupBy("next").agg(F.min(F.struct(F.xxhash64("sid").alias("hash"), "sid"))["sid"].alias("first"))
        there = pool.filter("next is null").withColumn("first", F.lit(None).cast("long"))
        judged = materialise(pool.join(first, "next").unionByName(there).drop("next"), "judged")
        out.append(judged.filter("first is null or sid = first").withColumn("path", F.col("first").isNotNull()).drop("first"))
        others = judged.filter("sid <> first").withColumn("chain", above()).withColumn("owner", F.col("first")).withColumn("known", F.col("x") + 1).drop("first", "x")
        if others.isEmpty():
            return out
        pool = along(others, prefixes, "owner", F.col("known"), F.col("n")).drop("known")


def union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def build(strings: DataFrame, prefixes: DataFrame, longest: int, first_share: int = 8) -> DataFrame:
    """All strings placed, in two batches: one of `first_share` of them (by hash), then all others."""
    early = F.pmod(F.xxhash64(F.col("sid"), F.lit("batch")), F.lit(first_share)) == 0
    first = materialise(union(insert(None, strings.filter(early), prefixes, longest)), "placed")
    return materialise(union([first, *insert(first, strings.filter(~early), prefixes, longest)]), "placed")


def end_digests(ends: DataFrame) -> DataFrame:
    """(sid, ends_sha256) of (sid, conv_id): the ids of a group ascending, joined by commas.

    SHA-256 has to see a group's ids one after the other. They are sorted over many tasks and packed as text; one task then
    reads the packed texts of a group in order and keeps none of them.
    """
    packed = "sid long, at long, ids binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int | None, int, list[int]]] = []
            for sid, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not rows or rows[-1][0] != sid:
                    rows.append((sid, conv, []))
                rows[-1][2].append(conv)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([",".join(map(str, r[2])).encode() for r in rows], pa.binary())], ["sid", "at", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for sid, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if state and sid == now:
                    state.update(b"," + ids)
                else:
                    out += [(now, state.hexdigest())] if state else []
                    now, state = sid, hashlib.sha256(ids)
            yield made(out)
        yield made([(now, state.hexdigest())] if state else [])

    def made(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["sid", "ends_sha256"])

    ids = ends.repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id").mapInArrow(pack, packed)
    return ids.repartition("sid").sortWithinPartitions("sid", "at").mapInArrow(hashed, "sid long, ends_sha256 string")


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per distinct prefix.

    Rows without a conv_id take no part. A null role or text is empty, a null turn comes first, turns with one number are in the
    order of a hash, and repeated rows are turns of their own. Without conversations there is no row, not even of the root.
    Conversations without turns after rebuilding end at the root. Other columns are not read.
    """
    turns = materialise(numbered(conversations), "turns")
    convs, rows = rebuilt(turns)
    longest = convs.agg(F.max("n")).first()[0]
    if longest is None:
        return conversations.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    every = materialise(scanned(rows, longest), "prefixes")
    last = convs.filter("n > 0").join(every.select("conv_id", F.col("d").alias("n"), "digest"), ["conv_id", "n"])
    group = last.groupBy("digest").agg(F.min("conv_id").alias("sid"), F.count("*").alias("copies"), F.first("n").alias("n"))
    strings = materialise(group, "strings")
    ends = last.join(strings.select("digest", "sid"), "digest").select("sid", "conv_id").union(convs.filter("n = 0").select(F.lit(None).cast("long"), "conv_id"))
    prefixes = every.withColumnRenamed("conv_id", "sid").join(strings.select("sid"), "sid", "left_semi")
    prefixes = materialise(prefixes, "paths") if strings.count() < convs.count() else every.withColumnRenamed("conv_id", "sid")
    placed = build(strings.select("sid", "n", "copies"), prefixes, longest)
    return summed(placed, prefixes, materialise(end_digests(ends), "ends"), convs)


def summed(placed: DataFrame, prefixes: DataFrame, ends: DataFrame, convs: DataFrame) -> DataFrame:
    """The rows of all nodes, the edges expanded."""
    paths = placed.filter("path")
    hung = paths.groupBy("owner", F.col("x").alias("e")).agg(F.count("*").alias("hung"))
    spot = F.struct(F.when(F.col("path"), F.col("sid")).otherwise(F.col("owner")).alias("owner"), F.when(F.col("path"), F.col("n")).otherwise(F.col("x")).alias("x"))
    # a path's string that nothing is hung on at its end is a leaf
    placed = placed.join(hung.select(F.col("owner").alias("_sid"), F.col("e").alias("_n")), (F.col("sid") == F.col("_sid")) & (F.col("n") == F.col("_n")), "left").withColumn("leaf", (F.col("path") & F.col("_sid").isNull()).cast("long"))
    up = F.explode(F.array_append(F.when(F.col("path"), above()).otherwise(F.col("chain")), spot)).alias("at")
    counts = placed.select("copies", "sid", "leaf", up).groupBy("at.owner", F.col("at.x").alias("e")).agg(F.sum("copies").alias("convs"), F.min("sid").alias("least"), F.sum("leaf").alias("leaves"))
    tops = paths.select(F.col("sid").alias("owner"), F.col("x").alias("e")).withColumn("convs", F.lit(0).cast("long")).withColumn("least", F.lit(None).cast("long")).withColumn("leaves", F.lit(0).cast("long"))
    bytes_at = prefixes.select(F.col("sid").alias("owner"), F.col("d").alias("e"), F.col("upto"))
    marks = counts.unionByName(tops).join(bytes_at, ["owner", "e"], "left").withColumn("upto", F.coalesce("upto", F.lit(0)))
    down = Window.partitionBy("owner").orderBy(F.col("e").desc())
    lower = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name, value in (("n_convs", F.sum("convs")), ("conv_id", F.min("least")), ("n_leaves", F.sum("leaves"))):
        marks = marks.withColumn(name, value.over(lower))
    for name in ("e", "upto", "convs"):
        marks = marks.withColumn(f"{name}_before", F.lead(name).over(down))
    marks = marks.withColumn("p", F.col("e_before")).withColumn("saved", (F.col("n_convs") - 1) * (F.col("upto") - F.col("upto_before")))
    spans = materialise(marks.filter("p is not null").select("owner", "p", "e", "n_convs", "conv_id", "n_leaves", "upto", "saved"), "spans")
    saved = spans.groupBy(F.col("owner").alias("sid")).agg(F.sum("saved").alias("saved"))
    sums = paths.join(saved, "sid").select("saved", F.explode(above()).alias("at")).groupBy("at.owner", F.col("at.x").alias("e")).agg(F.sum("saved").alias("hung_saved"))
    own_end = placed.select(spot.alias("at"), "sid").join(ends, "sid").select("at.owner", F.col("at.x").alias("e"), "ends_sha256")
    spans = spans.join(sums, ["owner", "e"], "left").join(hung, ["owner", "e"], "left").join(own_end, ["owner", "e"], "left")
    below = down.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.coalesce(F.sum("saved").over(below), F.lit(0)) + F.sum(F.coalesce("hung_saved", F.lit(0))).over(lower)
    spans = spans.withColumn("rest", rest).withColumn("path_end", F.lag("e").over(down).isNull()).withColumn("parent", F.lead("conv_id").over(down))
    # the parent of a path's first node is the place it hangs on
    least = spans.select(F.col("owner").alias("_owner"), F.col("e").alias("_e"), F.col("conv_id").alias("_least"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    hooks = paths.select(F.col("sid").alias("owner"), F.col("owner").alias("_owner"), F.col("x").alias("_e")).join(least, ["_owner", "_e"], "left").join(F.broadcast(root.select(F.col("conv_id").alias("_root"))), how="cross")
    spans = spans.join(hooks.select("owner", F.coalesce("_least", "_root").alias("_hook")), "owner").withColumn("parent", F.coalesce("parent", "_hook"))
    spans = spans.withColumn("chunk", F.explode(F.sequence(F.expr(f"(p + 1) div {CHUNK}"), F.expr(f"e div {CHUNK}"))))
    nodes = spans.withColumn("d", F.explode(F.sequence(F.greatest(F.col("p") + 1, F.col("chunk") * CHUNK), F.least("e", F.col("chunk") * CHUNK + CHUNK - 1))))
    nodes = nodes.hint("merge").join(prefixes.select(F.col("sid").alias("owner"), "d", "bytes", F.col("upto").alias("_upto")), ["owner", "d"])
    here = F.col("d") == F.col("e")
    nodes = nodes.select(
        "conv_id", F.col("d").alias("depth"), F.when(F.col("d") == F.col("p") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(here, F.coalesce("hung", F.lit(0)) + F.when(F.col("path_end"), 0).otherwise(1)).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        ((F.col("n_convs") - 1) * (F.col("upto") - F.col("_upto") + F.col("bytes")) + F.col("rest")).alias("saved_tokens"), F.when(here, F.coalesce("ends_sha256", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
    )
    top = paths.join(saved, "sid").agg(F.count_if(F.col("owner").isNull()).alias("n_children"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    leaves = placed.agg(F.greatest(F.lit(1), F.coalesce(F.sum("leaf"), F.lit(0))).alias("n_leaves"))
    none = ends.filter("sid is null").agg(F.coalesce(F.max("ends_sha256"), F.lit(EMPTY)).alias("ends_sha256"))
    for one in (top, leaves, none):  # one row each
        root = root.join(F.broadcast(one), how="cross")
    return nodes.unionByName(root.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
