"""Quality rules: simple counts, and a log-likelihood ratio of hashed n-grams (DataFrame functions only).

Two multinomials over hashed word n-grams are estimated: one from trusted documents, one from all documents.
The default length is one: with two, the mean ratio of junk and clean texts overlap (see the README). A document's score is the mean over its n-grams of log(p_trusted / p_raw); it is kept when the score
reaches a fixed threshold and the base rules hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def joined(a: str, b: str, step: int) -> Column:
    """Hashes of each entry of `a` with the entry of `b` that stands `step` places later; the last ones lack it."""
    return F.zip_with(a, F.slice(b, step + 1, F.greatest(F.size(b), F.lit(1))), lambda x, y: F.xxhash64(x, y))


def base_counts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, n_words and the base counts.

    A null text has no words and counts 0 everywhere. Every row is judged alone, so repeated rows get equal results.
    A text that repeats itself needs one sort of its windows; other texts need none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("_t"), words(F.col("text")).alias("_w"), lines.alias("_l"))
    df = df.select(
        "doc_id",
        "text_hash",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_1"),
    )
    df = df.withColumn("_2", joined("_1", "_1", 1))
    df = df.withColumn("_4", joined("_2", "_2", 2))
    windows = F.slice(joined("_4", "_1", 4), 1, F.greatest(F.size("_1") - (WINDOW - 1), F.lit(0)))
    df = df.withColumn("_g", windows)  # a 64-bit hash of each window of five words
    kept = ["doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    repeats = F.size("_g") > F.size(F.array_distinct("_g"))
    df = df.select(*kept, F.when(repeats, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    same = lambda x, k: (F.get("_s", k - 1)["h"] == x["h"]) | (F.get("_s", k + 1)["h"] == x["h"])
    df = df.select(*kept, F.sort_array(F.transform(F.filter("_s", lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])).alias("_p"))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x
    )
    return df.select(*kept, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(df: DataFrame) -> Column:
    return (df.n_words < 10) | (100 * df.n_repeat_words > 20 * df.n_words)


def hashed_ngrams(docs: DataFrame, n: int, digits: int, *more: Column) -> DataFrame:
    """A row per word: the bucket of the n-gram that starts there (shorter at the end of the text). A bucket is named by
    the first digits of the MD5, which other engines have too."""
    df = docs.select(*more, words(F.col("text")).alias("_w"))
    kept = [c for c in df.columns if c != "_w"]
    moved = [F.slice("_w", k, F.greatest(F.size("_w"), F.lit(1))).alias(f"w{k}") for k in range(1, n + 1)]
    df = df.select(*kept, F.explode("_w" if n == 1 else F.arrays_zip(*moved)).alias("_z"))
    gram = F.col("_z") if n == 1 else F.concat_ws(" ", *[f"_z.w{k}" for k in range(1, n + 1)])
    return df.select(*kept, F.left(F.md5(gram), F.lit(digits)).alias("bucket"))


def log_ratios(docs: DataFrame, labels: DataFrame, n: int, digits: int, max_trusted: int, smoothing: float) -> DataFrame:
    """(bucket, weight): log of the smoothed trusted probability over the smoothed raw one, at most 16**digits rows.

    Trusted are the documents labelled quality 1, at most `max_trusted` of them, the first by a hash of their id; raw
    counts come from all documents. The bound on the trusted ids makes their broadcast small.
    """
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    trusted = trusted.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(max_trusted).withColumn("_trusted", F.lit(1))
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted), F.col("doc_id") == F.col("_id"), "left")
    grams = hashed_ngrams(marked, n, digits, F.coalesce("_trusted", F.lit(0)).cast("long").alias("_trusted"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_trusted").alias("trusted"))
    counts = materialise(counts, "ngrams")
    totals = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_all"), F.coalesce(F.sum("trusted"), F.lit(0)).alias("trusted_all"))
    p = lambda n, total: (F.col(n) + smoothing) / (F.col(total) + smoothing * 16**digits)
    weight = F.when(F.col("trusted_all") > 0, F.log(p("trusted", "trusted_all") / p("raw", "raw_all"))).otherwise(0.0)
    return materialise(counts.join(F.broadcast(totals)).select("bucket", weight.alias("weight")), "ratios")


def quality_rules(
    docs: DataFrame, labels: DataFrame, *, n: int = 1, digits: int = 4, max_trusted: int = 20000, smoothing: float = 1.0, threshold: float = -0.35
) -> DataFrame:
    """Per row of documents: counts, base_failed, llr (mean log ratio of its n-grams) and kept.

    Texts that are null or without words have llr null and fail the base rules. Without trusted labels every llr is 0,
    so the base rules alone decide. Rows equal in id and text get equal results; other columns are ignored.
    """
    weights = log_ratios(docs, labels, n, digits, max_trusted, smoothing)
    grams = hashed_ngrams(docs, n, digits, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    scored = grams.join(F.broadcast(weights), "bucket").groupBy("_id", "_h").agg(F.round(F.avg("weight"), 6).alias("llr"))
    base = base_counts(docs)
    df = base.join(scored, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_h")), "left")
    failed = base_failed(df)
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & F.coalesce(F.col("llr") >= threshold, F.lit(False))).alias("kept"), "llr",
    )
