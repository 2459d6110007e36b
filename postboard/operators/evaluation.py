"""Rankings against human labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postboard.operators.ranking import top_per_group

CUTOFFS = (5, 10, 20)


def labelled_scores(gold: DataFrame, labels: DataFrame, scores: Sequence[str]) -> DataFrame:
    """(ranking, job_key, score, relevant): every labelled posting that gold has, once per score column."""
    df = gold.join(labels, "job_key")
    pairs = F.array(*[F.struct(F.lit(s).alias("ranking"), F.col(s).cast("double").alias("score")) for s in scores])
    return df.select("job_key", "relevant", F.inline(pairs)).select("ranking", "job_key", "score", "relevant")


def precision_at(scored: DataFrame, cutoffs: Sequence[int] = CUTOFFS) -> DataFrame:
    """(ranking, k, candidates, hits, precision): score descending, nulls last, then job_key; null when k reaches all."""
    order = [F.col("score").desc_nulls_last(), F.col("job_key")]
    n = scored.groupBy("ranking").agg(F.count("*").alias("candidates"))
    top = top_per_group(scored, ["ranking"], order, max(cutoffs)).withColumn("r", F.row_number().over(Window.partitionBy("ranking").orderBy(*order)))
    hits = top.groupBy("ranking").agg(F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.count_if((F.col("r") <= k) & F.coalesce("relevant", F.lit(False))).alias("hits")) for k in cutoffs]).alias("_h"))
    df = hits.join(n, "ranking").select("ranking", "candidates", F.inline("_h"))
    return df.select("ranking", "k", "candidates", "hits", F.when(F.col("candidates") > F.col("k"), F.round(F.col("hits") / F.col("k"), 6)).alias("precision"))


def verdict(precision: DataFrame, first: str, second: str) -> DataFrame:
    """One row: the sum of precision differences over cutoffs usable for both, and which ranking that favours."""
    a = precision.filter(F.col("ranking") == first).select("k", F.col("precision").alias("a"))
    b = precision.filter(F.col("ranking") == second).select("k", F.col("precision").alias("b"))
    df = a.join(b, "k").filter("a is not null and b is not null").agg(F.round(F.sum(F.col("a") - F.col("b")), 6).alias("delta"), F.count("*").alias("usable"))
    winner = F.when(F.col("usable") == 0, "no verdict").when(F.col("delta") > 0, first).when(F.col("delta") < 0, second).otherwise("tie")
    return df.select("delta", "usable", winner.alias("verdict"))


def stratified_sample(gold: DataFrame, size: int = 200, bands: int = 6) -> DataFrame:
    """The newest postings of each score band (0: unscored), at most max(1, size // bands) each."""
    df = gold.withColumn("band", F.coalesce("fit_score", F.lit(0)).cast("long"))
    order = [F.col("first_seen_at").desc(), F.col("job_key")]
    return top_per_group(df, ["band"], order, max(1, size // bands)).orderBy(F.col("band").desc(), *order)
