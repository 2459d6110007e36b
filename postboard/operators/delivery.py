"""Watermarked delivery of new postings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.operators.ranking import global_row_number
from postboard.sources import versioned
from postboard.sources.landing import read_or_empty

LEDGER = "sent_at timestamp, watermark timestamp, postings_sent long, batch long"


def watermark(ledger: DataFrame, now: Column, bootstrap_hours: int = 26) -> DataFrame:
    """One row: the newest watermark delivered, or some hours before now when nothing was."""
    return ledger.agg(F.coalesce(F.max("watermark"), now - F.make_dt_interval(hours=F.lit(bootstrap_hours))).alias("watermark"))


def new_since(gold: DataFrame, mark: DataFrame) -> DataFrame:
    """Postings first seen strictly after the watermark."""
    return gold.join(F.broadcast(mark.select(F.col("watermark").alias("_mark"))), F.col("first_seen_at") > F.col("_mark")).drop("_mark")


def order() -> list[Column]:
    return [F.col("fit_score").desc_nulls_last(), F.col("match_score").desc(), F.col("posted_or_updated_at").desc_nulls_last(), F.col("job_key").asc()]


def delivery_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*order())


def signal_line() -> Column:
    """Three groups: the match score; model scores, or that there are none; details. Only exceptions are told."""
    percent = F.format_string("vectors %.0f%%", F.bround(F.col("similarity") * 100, 0))
    model = F.concat_ws(", ", F.when(F.col("fit_score").isNotNull(), F.format_string("LLM %d/5", "fit_score")), F.when(F.col("similarity").isNotNull(), percent))
    details = F.concat_ws(
        ", ", F.format_string("tech hits: %d", "desired_tech_hits"), F.when(F.col("title_match"), "title match"), F.when(F.col("deal_breaker_terms") != "", F.concat(F.lit("mentions "), "deal_breaker_terms")),
        F.when(F.col("company_type") != "", F.col("company_type")), F.when(F.col("geo_restriction") == "us_only", "text says US only").when(F.col("geo_restriction") == "unclear", "eligibility unstated"),
        F.when(F.col("manages_people") == "yes", "manages people"), F.when(F.col("best_match_source") != "", F.concat(F.lit("like: "), "best_match_source")),
    )
    return F.concat_ws(" — ", F.format_string("match %d", "match_score"), F.when(model == "", "unscored").otherwise(model), details)


def next_watermark(delivered: DataFrame, sent_at: Column) -> DataFrame:
    """The ledger row of a delivery; no row when nothing was delivered, so the watermark stays."""
    df = delivered.agg(F.max("first_seen_at").alias("watermark"), F.count("*").alias("postings_sent")).filter("postings_sent > 0")
    return df.select(sent_at.alias("sent_at"), "watermark", "postings_sent")


def deliver(gold: DataFrame, outbox: str, ledger_path: str, batch: int, send: Callable[[int, DataFrame], None], now: Column, bootstrap_hours: int = 26) -> None:
    """Deliver what is new in `gold` as delivery number `batch`: fetch, order, render, send, and advance the watermark.

    The rows are put into the outbox under the number first, then sent, then entered in the ledger with the number. Run again
    after a failure, a delivery that the ledger holds is not sent, and one that is in the outbox is sent as it is there, whatever
    gold holds by then: nothing is left out, and a receiver that knows the number can drop the second copy. Without new rows
    the sender gets an empty frame (a sign of life), and the watermark stays.
    """
    spark = gold.sparkSession
    ledger = read_or_empty(spark, ledger_path, LEDGER)
    if not ledger.filter(F.col("batch") == batch).isEmpty():
        return
    place = f"{outbox}/batch={batch}"
    if "_SUCCESS" not in versioned.names(spark, place):
        mark = watermark(ledger.filter(F.col("batch") < batch), now, bootstrap_hours)
        rows = new_since(gold, mark).withColumn("line", signal_line())
        global_row_number(rows, order(), "pos").select("pos", "job_key", "title", "company", "location", "url", "line", "first_seen_at").write.mode("overwrite").parquet(place)
    rows = spark.read.parquet(place)
    send(batch, rows)
    entry = next_watermark(rows, now).withColumn("batch", F.lit(batch).cast("long"))
    entry.select(*[F.col(f).cast(t).alias(f) for f, t in (c.split() for c in LEDGER.split(", "))]).write.mode("append").parquet(ledger_path)
