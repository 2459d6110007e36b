"""Mixing sources to target weights with a low-discrepancy schedule of equal blocks of words.

Each source's documents, in the order of a hash, are one stream of words that is cut into blocks of equal length. The mix is a
row of slots. Slot i belongs to the source whose share of the unit interval holds the i-th point of the van der Corput sequence
to base 2, so that any stretch of slots is close to the shares. A source's r-th slot takes its r-th block, and starts over after
the last one; it takes no more slots than its target needs, and cuts the last one to size.

The points of 2**k slots are the whole numbers below 2**k with their bits reversed. So a source makes its own slots from the
whole numbers of its share, with no join, and the rank of a slot among them is a sum of k counts of an arithmetic series, with
no window. A source of any size is dealt to many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise, running_sum
from postboard.operators.ranking import global_row_number

WORD = r"[^\x20\x09-\x0D]+"
#: Whole numbers that one row opens into.
CHUNK = 4096


def sized(docs: DataFrame, seed: str) -> DataFrame:
    """(doc_id, source, size, mark): the words of each text, and what shuffles the documents."""
    text = F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), text))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), mark.alias("mark"))


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """(source, source_no, source_size, weight, target) of each source.

    Sources by code point, null last, get the weights in turn. They share `percent` of all words; a target stops at `most`
    times its source, and the excess is shared by weight among the others until none is above. The rounds are sums over the
    sources; the driver sees two numbers of each. Comparisons are of whole numbers.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = global_row_number(found, [F.col("source").asc_nulls_last()], "source_no").withColumn("source_no", F.col("source_no") - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = materialise(numbered.withColumn("weight", weight.cast("long")), "sources")
    all_words, rest_weight = (int(x or 0) for x in rows.agg(F.sum("source_size"), F.sum("weight")).first())
    rest, capped, before = percent * all_words, F.lit(False), -1  # a hundredth of a word is the unit
    while True:
        whole = lambda x: F.lit(str(x)).cast("decimal(38,0)")
        capped = F.col("weight") * whole(rest) > F.col("source_size") * whole(100 * most * rest_weight)
        n, words, left = rows.agg(F.count_if(capped), F.sum(F.when(capped, F.col("source_size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        if n == before or not left:
            break
        rest, rest_weight, before = percent * all_words - 100 * most * int(words or 0), int(left), n
    shared = F.col("weight") * F.lit(rest / 100) / F.lit(float(rest_weight or 1))
    return rows.withColumn("target", F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(shared))


def reversed_bits(x: Column, k: int) -> Column:
    """The k low bits of a whole number below 2**k in reverse order (k of 1 to 62): halves are swapped, then their halves."""
    for step, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        x = F.shiftrightunsigned(x, step).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(x.bitwiseAND(F.lit(mask)), step))
    return F.shiftrightunsigned(x, 64 - k)


def earlier(j: Column, low: Column, high: Column, k: int) -> Column:
    """How many whole numbers of [low, high) have reversed bits below those of j.

    They differ from j first, from the lowest bit up, at a bit t that j has and they lack: those equal to j's lower bits
    modulo 2**(t + 1).
    """
    counts = []
    for t in range(k):
        rest = j.bitwiseAND(F.lit((1 << t) - 1))
        n = F.shiftright(high - rest - 1, t + 1) - F.shiftright(low - rest - 1, t + 1)
        counts.append(F.when(j.bitwiseAND(F.lit(1 << t)) != 0, n).otherwise(0))
    return reduce(lambda a, b: a + b, counts)


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """(slot, source_no, block, upto): the slots that take a block of their source, and where in the source's stream they end.

    Slots need not be without gaps: a source that has reached its target leaves its later slots empty.
    """
    take, size = F.floor(F.col("target") + 0.5), F.col("source_size")
    rows = sources.filter("source_size > 0").select("source_no", size.alias("size"), take.cast("long").alias("take"))
    rows = rows.withColumn("blocks", F.expr(f"(size + {block - 1}) div {block}")).withColumn("rest", F.col("take") % F.col("size"))
    rows = rows.withColumn("need", F.expr(f"blocks * (take div size) + (rest + {block - 1}) div {block}")).filter("need > 0")
    rows = materialise(running_sum(rows, [F.col("source_no")], "need", "before"), "shares")
    total = int(rows.agg(F.sum("need")).first()[0] or 0)
    k = max(1, (total - 1).bit_length())
    edge = lambda c: F.expr(f"(cast({c} as decimal(20,0)) * {1 << k}BD + {total - 1}BD) div {max(1, total)}BD").cast("long")
    rows = rows.withColumn("low", edge("before")).withColumn("high", edge("before + need"))
    chunk = F.explode(F.sequence(F.expr(f"low div {CHUNK}"), F.expr(f"(high - 1) div {CHUNK}")))
    rows = rows.withColumn("chunk", chunk).repartition("source_no", "chunk")
    j = F.explode(F.sequence(F.greatest("low", F.col("chunk") * CHUNK), F.least("high", (F.col("chunk") + 1) * CHUNK) - 1))
    slots = rows.withColumn("j", j).withColumn("rank", earlier(F.col("j"), F.col("low"), F.col("high"), k)).filter("rank < need")
    at = F.col("rank") % F.col("blocks")
    upto = F.when(F.expr("rank div blocks < take div size"), F.col("size")).otherwise(F.col("rest"))
    return slots.select(reversed_bits(F.col("j"), k).alias("slot"), "source_no", at.alias("block"), F.least(upto, (at + 1) * block).alias("upto"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with their source's number, size and target, and their place (`start`) in its stream."""
    order = [F.col("source").asc_nulls_last(), F.col("mark"), F.col("doc_id")]
    first = running_sum(sources, [F.col("source_no")], "source_size", "_first").select(F.col("source").alias("_source"), "source_no", "source_size", "target", "_first")
    rows = running_sum(sizes, order, "size", "_at").join(first, F.col("source").eqNullSafe(F.col("_source")))
    return rows.withColumn("start", F.col("_at") - F.col("_first")).select("doc_id", "source_no", "size", "source_size", "target", "start")


def mixed(docs: DataFrame, slots: DataFrame, block: int) -> DataFrame:
    """(slot, doc_id, source_no, start, first, end): the words [first, end) of each document that each slot takes, with the
    document's place. In the order of slot and place, they are the mix. Documents are as `placed` gives them."""
    number = F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))
    parts = docs.filter("size > 0").withColumn("block", number)
    df = parts.join(slots.hint("merge"), ["source_no", "block"])  # slots come from few rows, and are many all the same
    first, end = F.greatest("start", F.col("block") * block), F.least("upto", F.col("start") + F.col("size"))
    return df.select("slot", "doc_id", "source_no", "start", (first - F.col("start")).alias("first"), (end - F.col("start")).alias("end")).filter("end > first")


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, most: int = 2, block: int = 1024, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot: one row per document.

    Null texts have no words; a null source is a source, the last. Documents without words are taken 0 times, with no first
    slot. Repeated rows and ids each count. A source's taken words are its target, rounded; no document is taken more than
    `most` times its size. The order within a source follows from ids and texts, so reruns agree. Other columns are not read.
    """
    sizes = materialise(sized(docs, seed), "sizes")
    sources = materialise(targets(sizes, weights, percent, most), "targets")
    rows = materialise(placed(sizes, sources), "placed")
    taken = mixed(rows, schedule(sources, block), block).groupBy("source_no", "start").agg(F.sum(F.col("end") - F.col("first")).alias("_taken"), F.min("slot").alias("_slot"))
    df = rows.join(taken.withColumnRenamed("source_no", "_no").withColumnRenamed("start", "_start"), (F.col("source_no") == F.col("_no")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0), "left")
    return df.select("doc_id", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).alias("taken"), F.col("_slot").alias("first_slot"))
