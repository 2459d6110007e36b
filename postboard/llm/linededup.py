"""Removal of passages that occur in several places, by hashing units of text.

A unit is a line, or a sentence of one; a sentence of many words is cut after certain words, so that a passage that begins
or ends inside it still shares most of its units. Units are normalised and hashed to 128 bits; the digests are grouped
over all documents, and the occurrence with the least rank (document, then place) is kept. Runs of units that are not the
first of their kind are cut out when the run has enough words, so short common phrases stay where they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise, rows_of

#: What ends a unit and belongs to it: a sentence's end with the spaces behind it, or line ends.
BOUNDARY = re.compile(r"[.!?]+[ \t]+|\n+")
BYTES_BOUNDARY = re.compile(BOUNDARY.pattern.encode())
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Units with more words are cut after words that `part_ends` picks, about one in eight.
LONG = 24


def part_ends(words: list[bytes]) -> list[int]:
    """Places after which a long sentence is cut (its end is one): by each word in lower case alone, so that every copy of
    a passage is cut at the same places."""
    if len(words) <= LONG:
        return [len(words)]
    return [k for k, w in enumerate(words[:-1], 1) if not (w[0] + 31 * w[-1] + 7 * len(w)) & 7] + [len(words)]


def normalised(text: str) -> list[bytes]:
    """The units with a word, in order. Case and white space do not count; bytes.split() splits where words do."""
    out, start, low = [], 0, text.lower().encode()
    for end in [*(m.end() for m in BYTES_BOUNDARY.finditer(low)), len(low)]:
        if words := low[start:end].split():
            if len(words) <= LONG:
                out.append(b" ".join(words))
            else:
                first = 0
                for k in part_ends(words):
                    out.append(b" ".join(words[first:k]))
                    first = k
        start = end
    return out


def units(text: str) -> list[tuple[int, int, int]]:
    """(start, end, words) of the same units in the text; what has no word belongs to the unit after it."""
    out, start = [], 0
    for end in [*(m.end() for m in BOUNDARY.finditer(text)), len(text)]:
        words = text[start:end].lower().encode().split()
        if not words:
            continue
        ends, places = part_ends(words), []
        if len(ends) > 1:
            places = [m.start() for m in WORD.finditer(text, start, end)]
        at, first = start, 0
        for k in ends:
            after = places[k] if k < len(words) else end
            out.append((at, after, k - first))
            at, first = after, k
        start = end
    return out


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, unit, h1, h2) of each unit of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, hashes, texts in rows_of(batches, "doc_id", "text_hash", "text"):
            at = 0
            while at < len(texts):
                found, counts = [], []
                for text in texts[at:]:
                    of_text = normalised(text or "")
                    found += map(xxhash.xxh3_128_digest, of_text)
                    counts.append(len(of_text))
                    if len(found) > 100_000:
                        break
                here = slice(at, at + len(counts))
                at += len(counts)
                rows = np.repeat(np.arange(len(counts)), counts)
                places = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
                halves = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
                ids, texts_ = pa.array(doc_ids[here], pa.int64()), pa.array(hashes[here], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), texts_.take(pa.array(rows)), pa.array(places.astype(np.int32)), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                    ["doc_id", "text_hash", "unit", "h1", "h2"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, unit int, h1 long, h2 long")


def cut(text: str, repeated: set[int], least_words: int) -> tuple[str, list[tuple[int, int]]]:
    """The text without long enough runs of repeated units, and the runs' offsets in the original."""
    found, spans, at = units(text), [], 0
    while at < len(found):
        end, n = at, 0
        while end < len(found) and end in repeated:
            n += found[end][2]
            end += 1
        if n >= least_words:
            spans.append((found[at][0], found[end - 1][1]))
        at = end + 1 if end == at else end
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last:a])
        last = b
    return "".join([*kept, text[last:]]), spans


def later_units(found: DataFrame, hot_shares: int = 1000) -> DataFrame:
    """(doc_id, text_hash, unit) of the occurrences that are not the first of their digest.

    Digests that hold over a thousandth of all repeated units are 1,000 at most: they are broadcast, and their units get
    keys of their own in the join of the others, so no task gets a common line's units all at once.
    """
    rank = F.struct("doc_id", "text_hash", "unit")
    firsts = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(rank).alias("first")).filter("n > 1")
    firsts = materialise(firsts, "firsts")
    repeated = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(firsts.filter(F.col("n") > repeated / hot_shares).select("h1", "h2", F.col("first").alias("hot_first")))
    own = lambda c, k: F.when(F.col("hot_first").isNull(), F.col(c)).otherwise(F.xxhash64("doc_id", "text_hash", "unit", F.lit(k)))
    units_ = found.join(hot, ["h1", "h2"], "left").select("doc_id", "text_hash", "unit", "hot_first", own("h1", 1).alias("k1"), own("h2", 2).alias("k2"))
    joined = units_.join(firsts.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first"), ["k1", "k2"], "left")
    first = F.coalesce("hot_first", "first")
    return joined.filter(first.isNotNull() & ~rank.eqNullSafe(first)).select("doc_id", "text_hash", "unit")


def remove_repeats(docs: DataFrame, *, least_words: int = 20) -> DataFrame:
    """All rows and columns of documents with `text` cleaned; adds removed (start:end, comma-joined, code points of the
    original text), n_removed (units' runs) and n_removed_chars.

    A null text stays null. Rows equal in id and text are one document: they lose the same runs. Rows of one id and
    different texts are ranked by the text's hash. Null ids rank first. Columns of the input that have the names of the
    added ones are replaced. The digests are computed twice, which costs less than to keep them.
    """
    docs = docs.drop("removed", "n_removed", "n_removed_chars")
    later = later_units(digests(docs))
    per_doc = later.groupBy("doc_id", "text_hash").agg(F.collect_set("unit").alias("_units"))
    per_doc = per_doc.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_units")
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    rows = rows.join(per_doc, rows.doc_id.eqNullSafe(per_doc["_id"]) & (rows["_text_hash"] == per_doc["_hash"]), "left").drop("_id", "_hash", "_text_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, repeated = batch.column(names.index("text")).to_pylist(), batch.column(names.index("_units")).to_pylist()
            done = [cut(t, set(u), least_words) if t is not None and u else (t, []) for t, u in zip(texts, repeated, strict=True)]
            new = {
                "text": pa.array([x[0] for x in done], pa.string()),
                "removed": pa.array([",".join(f"{a}:{b}" for a, b in x[1]) for x in done], pa.string()),
                "n_removed": pa.array([len(x[1]) for x in done], pa.int64()),
                "n_removed_chars": pa.array([sum(b - a for a, b in x[1]) for x in done], pa.int64()),
            }
            kept = [n for n in names if n != "_units"]
            columns = [new.get(n, batch.column(names.index(n))) for n in kept] + [new[n] for n in ("removed", "n_removed", "n_removed_chars")]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "removed", "n_removed", "n_removed_chars"])

    schema = docs.schema.add("removed", "string").add("n_removed", "long").add("n_removed_chars", "long")
    return rows.mapInArrow(run, schema)
