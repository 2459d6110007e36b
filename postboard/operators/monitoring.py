"""Run rollups, volume and freshness watches, and cost reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def run_rollup(boards: DataFrame) -> DataFrame:
    """Per source of a run, from (source, company, rows, failed): status is error only if all boards failed."""
    refs = F.array_sort(F.collect_list(F.when(F.col("failed"), F.col("company"))))
    df = boards.groupBy("source").agg(F.sum(F.coalesce("rows", F.lit(0))).cast("long").alias("rows_fetched"), F.count("*").alias("company_count"), F.count_if("failed").alias("failed_boards"), refs.alias("_failed"))
    status = F.when(F.col("failed_boards") == F.col("company_count"), "error").otherwise("ok")
    note = F.when(F.col("failed_boards") > 0, F.concat(F.when(status == "ok", "skipped: ").otherwise("failed: "), F.array_join("_failed", ", ")))
    return df.select("source", "rows_fetched", "company_count", "failed_boards", status.alias("status"), note.alias("error"))


def run_summary(rollup: DataFrame) -> DataFrame:
    """One row: boards and skipped boards of the whole run."""
    return rollup.agg(F.sum("company_count").alias("board_count"), F.sum("failed_boards").alias("skipped_refs"))


def low_volume(rollup: DataFrame, least: int = 1) -> DataFrame:
    return rollup.filter((F.col("status") == "ok") & (F.col("rows_fetched") < least))


def last_runs(ledger: DataFrame, n: int) -> DataFrame:
    """The last n ok runs of each source."""
    w = Window.partitionBy("source").orderBy(F.col("finished_at").desc(), F.col("run_id").desc())
    return ledger.filter("status = 'ok'").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def volume_drops(current: DataFrame, prior: DataFrame, *, window: int = 14, least_runs: int = 5, share: float = 0.5) -> DataFrame:
    """(source, rows_fetched, baseline) of ok runs below a share of the truncated median of the prior ok runs."""
    base = last_runs(prior, window).groupBy("source").agg(F.percentile("rows_fetched", F.lit(0.5)).cast("long").alias("baseline"), F.count("*").alias("_n")).filter(F.col("_n") >= least_runs)
    df = current.filter("status = 'ok'").join(base, "source")
    return df.filter((F.col("baseline") > 0) & (F.col("rows_fetched") < F.col("baseline") * share)).select("source", "rows_fetched", "baseline")


def freshness(landing: DataFrame, expected: DataFrame, now: Column, warn_hours: int = 12, error_hours: int = 30) -> DataFrame:
    """(source, last_at, state) of each expected source: pass, warn or error; no rows is an error."""
    last = landing.groupBy("source").agg(F.max("ingested_at").alias("last_at"))
    age = lambda h: F.col("last_at") < now - F.make_dt_interval(hours=F.lit(h))
    state = F.when(F.col("last_at").isNull() | age(error_hours), "error").when(age(warn_hours), "warn").otherwise("pass")
    return expected.select("source").distinct().join(last, "source", "left").select("source", "last_at", state.alias("state"))


def unconfigured(sources: DataFrame, companies: DataFrame) -> DataFrame:
    """Sources without an active company."""
    return sources.select("source").distinct().join(companies.filter("active").select("source").distinct(), "source", "left_anti")


def cost_report(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Per source, and in total (source null): rows, MB, KB a row, share of bytes, rows kept and their rate.

    `raw` has source, raw_bytes and text_bytes; `kept` has source.
    """
    gold = kept.groupBy("source").agg(F.count("*").alias("kept"))
    per = raw.groupBy("source").agg(F.count("*").alias("rows"), F.sum("raw_bytes").alias("raw_bytes"), F.sum("text_bytes").alias("text_bytes")).join(gold, "source", "left").fillna(0, ["kept"])
    total = per.agg(F.sum("raw_bytes").alias("_all"))
    df = per.rollup("source").agg(*[F.sum(c).alias(c) for c in ("rows", "raw_bytes", "text_bytes", "kept")]).join(F.broadcast(total), how="cross")
    return df.select(
        "source", "rows", F.round(F.col("raw_bytes") / 1e6, 6).alias("raw_mb"), F.round(F.col("text_bytes") / 1e6, 6).alias("text_mb"), F.round(F.col("raw_bytes") / F.col("rows") / 1e3, 6).alias("kb_per_row"),
        F.round(100 * F.col("raw_bytes") / F.col("_all"), 6).alias("pct_bytes"), "kept", F.round(F.col("kept") / F.col("rows"), 6).alias("keep_rate"),
    )
