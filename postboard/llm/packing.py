"""Best-fit packing of token sequences by exact complements.

Documents become pieces of at most `capacity` tokens. Only the number of pieces of each length matters for the plan,
so the plan is made from a histogram of at most `capacity` entries: the gap that a long piece leaves is looked up in an
index of the sums of one, two and three lengths, combinations that fill it exactly are consumed while the counts allow,
those of plentiful lengths first, and best fit places the rest. Short pieces spent early on exact sums can be missing later, so several
plans are made and the one with the fewest sequences is taken. Each step of a plan stands for many equal sequences, and Spark deals the
pieces out to the plan's slots by rank within a length.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postboard.llm.bpe import PIECES, byte_letters, loaded
from postboard.llm.common import materialise, rows_of

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tuple[tiktoken.Encoding, bool]:
    """The vocabulary of a tokenizers file, run by the faster library (its ids are the same; the tests compare them)."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in s): i for s, i in data["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special), bool(special)


def ids_of(text: str, path: str) -> np.ndarray:
    """Ids of a text. The faster library gives up on runs of hundreds of thousands of spaces; the queue of op5 does not."""
    try:
        return tokenizer(path)[0].encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(loaded(path).encode(text), np.uint32)


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of every document: its ids and an end id, cut from the end so that only the first may be shorter.

    A null text counts as empty and gives one piece, the end id. Repeated rows give repeated pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(end_id).to_bytes(4, "little")
        for doc_ids, texts in rows_of(batches, "doc_id", "text"):
            out: list[list[int | None]] = [[], [], [], [], []]
            for doc_id, text in zip(doc_ids, texts, strict=True):
                ids = ids_of(text or "", path).astype("<u4").tobytes() + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for column, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


Plan = list[tuple[tuple[int, ...], int]]


def take(left: dict[int, int], pattern: tuple[int, ...], out: Plan, at_once: int | None = None) -> None:
    """Use a pattern as often as the counts allow, or so many times."""
    need = Counter(pattern)
    times = at_once or min(left[n] // k for n, k in need.items())
    out.append((pattern, times))
    for n, k in need.items():
        left[n] -= times * k
        if not left[n]:
            del left[n]


class Sums:
    """The lengths at hand by their sums: a length, two of them, and (from a length and two of them) three.

    An entry that no pieces are left for is dropped when it is met.
    """

    def __init__(self, left: dict[int, int], most: int) -> None:
        self.left, self.pairs = left, {}
        lengths = sorted(left, reverse=True)
        for i, a in enumerate(lengths):
            for b in lengths[i:]:
                if a + b <= most:
                    self.pairs.setdefault(a + b, []).append((a, b))

    def there(self, *pattern: int) -> int:
        """How many times the pieces at hand make a pattern."""
        return min(self.left.get(n, 0) // k for n, k in Counter(pattern).items())

    def pair(self, total: int, biggest: int, *beside: int) -> tuple[int, int, int] | None:
        """(times, smaller, larger) of the pair that is there most often, beside other pieces."""
        entries = self.pairs.get(total, [])
        entries[:] = [x for x in entries if self.there(*x)]
        found = max(((self.there(*beside, a, b), b, a) for a, b in entries if a <= biggest), default=None)
        return found if found and found[0] else None

    def filling(self, gap: int, biggest: int) -> tuple[int, ...] | None:
        """One to three lengths, none above `biggest`, that fill the gap exactly: as few as can be, then those of which there
        are most, so that rare lengths are kept for the gaps that only they fill."""
        if gap <= biggest and self.there(gap):
            return (gap,)
        if found := self.pair(gap, biggest):
            return found[2], found[1]
        threes = ((self.pair(gap - a, a, a), a) for a in sorted(self.left, reverse=True) if a <= biggest and gap / 3 <= a < gap - 1)
        times, a, pair = max(((x[0], a, x) for x, a in threes if x), default=(0, 0, None))
        return (a, pair[2], pair[1]) if times else None


def pairs(left: dict[int, int], capacity: int, out: Plan) -> None:
    """Two lengths that fill a sequence: no plan with them apart is better."""
    for n in sorted(left, reverse=True):
        if n in left and capacity - n in left and (2 * n != capacity or left[n] > 1):
            take(left, (n, capacity - n), out)


def best_fit(left: dict[int, int], capacity: int) -> Plan:
    """From the longest down, each piece goes into the fullest open sequence with room for it, many equal ones at once."""
    rooms: dict[int, Plan] = {}
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            room = min((r for r in rooms if r >= n), default=None)
            if room is None:
                each = min(capacity // n, c)
                rooms.setdefault(capacity - each * n, []).append(((n,) * each, c // each))
                c -= c // each * each
                continue
            pattern, times = rooms[room].pop()
            used = min(c, times)
            if used < times:
                rooms[room].append((pattern, times - used))
            if not rooms[room]:
                del rooms[room]
            rooms.setdefault(room - n, []).append(((*pattern, n), used))
            c -= used
    return [x for group in rooms.values() for x in group]


def complements(left: dict[int, int], capacity: int, out: Plan) -> None:
    """From the longest piece down, gaps are filled exactly while there are combinations for them; best fit places the rest."""
    index, aside = Sums(left, capacity), {}
    while left and 2 * (long := max(left)) > capacity:
        left[long] -= 1
        found = index.filling(capacity - long, long)
        left[long] += 1
        if found:
            take(left, (long, *found), out, at_once=max(1, index.there(long, *found) // 2))
        else:
            aside[long] = left.pop(long)
    left |= aside
    out += best_fit(left, capacity)


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Patterns of lengths and how many sequences follow each, for pieces counted by length (full ones left out).

    The best of three: exact pairs, then exact sums and best fit for the rest; exact pairs, then best fit; best fit alone. So there are never more sequences than best fit from the longest down makes.
    """
    given = {n: c for n, c in counts.items() if c > 0 and n < capacity}
    plans: list[Plan] = []
    for way in (lambda left, out: out.extend(best_fit(left, capacity)), lambda left, out: complements(left, capacity, out)):
        left, out = dict(given), []
        pairs(left, capacity, out)
        way(left, out)
        plans.append(out)
    plans.append(best_fit(given, capacity))
    return min(plans, key=lambda p: sum(times for _, times in p))


def slots(patterns: Plan) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number, first sequence, offset): pieces of a length by rank go to sequences in a row."""
    out, sequence, rank = [], 0, {}
    for pattern, times in patterns:
        offset = 0
        for n in pattern:
            out.append((n, rank.get(n, 0), times, sequence, offset))
            rank[n] = rank.get(n, 0) + times
            offset += n
        sequence += times
    return out


def ranked(pieces: DataFrame, rows_each: int = 20_000) -> DataFrame:
    """Adds rank, from 0 without gaps within a length. Hot lengths are split by a hash, so no group is large."""
    groups = max(1, -(-pieces.count() // rows_each))
    pieces = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    local = pieces.withColumn("_rank", F.row_number().over(within) - 1)
    return local.join(counts, ["length", "_part"]).select(*[c for c in pieces.columns if c != "_part"], (F.col("_rank") + F.col("_before")).alias("rank"))


def packed(docs: DataFrame, path: str, *, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces are written once; of them, only the histogram of their lengths (at most `capacity` rows) comes to the
    driver. Full pieces fill a sequence each. An empty table gives an empty result. Repeated rows are packed each; null
    ids are kept.
    """
    spark = docs.sparkSession
    pieces = materialise(pieces_of(docs, path, capacity, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = counts.pop(capacity, 0)
    table = slots([*plan(counts, capacity), *([((capacity,), full)] if full else [])])
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("length", "_first", "_n", "_sequence", "_offset")])
    places = F.broadcast(spark.createDataFrame(table, schema))  # bounded by the capacity, not by the input
    df = ranked(pieces).alias("p").join(places.alias("s"), "length").filter("rank >= _first and rank < _first + _n")
    return df.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_sequence") + F.col("rank") - F.col("_first")).alias("sequence_id"), F.col("_offset").alias("offset")
    )
