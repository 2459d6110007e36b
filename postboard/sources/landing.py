"""The append-only landing table, its ledgers, and how both are written and read."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COLUMNS = "source company external_id title location remote_policy department employment_type url description_html posted_or_updated_at raw ingested_at run_id".split()
RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
POSTING = "source string, company string, external_id string, title string, location string, remote_policy string, department string, employment_type string, url string, description_html string, posted_or_updated_at timestamp, raw string"
INGEST_RUNS = "run_id string, source string, company_count long, rows_fetched long, status string, started_at timestamp, finished_at timestamp, error string"
DIGEST_RUNS = "sent_at timestamp, watermark timestamp, postings_sent long"
SCORING_PROMPT = "prompt_version string, rendered_prompt string, rendered_at timestamp"
RESUME_UNITS = "unit_id string, source string, text string, evidences string, prompt_version string"


def as_raw(postings: DataFrame, run_id: str, ingested_at: dt.datetime) -> DataFrame:
    """Postings as all-string landing rows. The stamp is one literal for the whole landing: activity compares it."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    stamped = postings.withColumn("posted_or_updated_at", F.date_format("posted_or_updated_at", iso)).withColumn("ingested_at", F.lit(ingested_at.isoformat())).withColumn("run_id", F.lit(run_id))
    return stamped.select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])


def land(postings: DataFrame, path: str, run_id: str, ingested_at: dt.datetime) -> int:
    """Append to the landing, by source and day, and return the number of rows, which is counted as they are written."""
    seen = Observation()
    rows = as_raw(postings, run_id, ingested_at).withColumn("ingest_date", F.lit(ingested_at.date())).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").partitionBy("source", "ingest_date").parquet(path)
    return seen.get["n"]


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table in its declared columns, or an empty one where the path is not there yet; other errors are errors."""
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return df.select(spark.createDataFrame([], schema).columns)


def stage_raw(raw: DataFrame) -> DataFrame:
    """Twelve columns with two timestamps; the payload and the run are not read."""
    kept = [c for c in RAW_COLUMNS if c not in ("raw", "run_id")]
    return raw.select(*[F.col(c).cast("timestamp").alias(c) if c.endswith("_at") else F.col(c) for c in kept])


def within_retention(raw: DataFrame, day: Column, days: int = 180) -> DataFrame:
    """Rows whose day partition is at most `days` before the newest one. The bound is a literal, so that a scan reads
    only the partitions within it."""
    last = raw.agg(F.max(day).cast("date")).first()[0]
    return raw.filter(day >= F.lit(last - dt.timedelta(days=days))) if last else raw


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whichever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def expire(spark: SparkSession, path: str, days: int = 180, last: dt.date | None = None) -> int:
    """Drop the day partitions of a landing that are more than `days` older than the newest (or a given day), and return their
    number."""
    parts = spark.read.option("basePath", path).parquet(path).select("source", "ingest_date").distinct()
    last = last or parts.agg(F.max("ingest_date")).first()[0]
    if last is None:
        return 0
    old = parts.filter(F.col("ingest_date") < F.lit(last - dt.timedelta(days=days))).collect()  # sources times days
    for r in old:
        source = "__HIVE_DEFAULT_PARTITION__" if r["source"] is None else spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(r["source"])
        remove(spark, f"{path}/source={source}/ingest_date={r['ingest_date']}")
    return len(old)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def changed_prompt(current: DataFrame, new: DataFrame) -> DataFrame:
    """The new prompt's row unless the newest landed (version, text) equals it, nulls being equal to nulls."""
    newest = current.agg(F.max_by(F.struct("prompt_version", "rendered_prompt"), F.struct("rendered_at", "prompt_version")).alias("_p")).filter("_p is not null")
    same = new.prompt_version.eqNullSafe(F.col("_p.prompt_version")) & new.rendered_prompt.eqNullSafe(F.col("_p.rendered_prompt"))
    return new.join(F.broadcast(newest), same, "left_anti")
