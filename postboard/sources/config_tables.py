"""Configuration tables in CSV: companies, rules and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postboard.functions.text import blank_to_null

COMPANY_COLUMNS = ["company_name", "source", "board_ref", "active", "tier", "website", "notes"]
RULES = {"allowed_locations": ["pattern"], "deal_breaker_tech": ["tech", "reason"], "desired_tech": ["tech", "note"], "desired_titles": ["pattern", "note"]}
#: Spellings of a verdict.
YES, NO = ("true", "yes", "y", "1"), ("false", "no", "n", "0")


def as_companies(rows: DataFrame) -> DataFrame:
    """String rows as typed companies: cells are stripped, blanks get defaults, company_slug is an alias of board_ref."""
    if "company_slug" in rows.columns and "board_ref" not in rows.columns:
        rows = rows.withColumnRenamed("company_slug", "board_ref")
    cell = lambda c: blank_to_null(F.trim(F.col(c))) if c in rows.columns else F.lit(None).cast("string")
    return rows.select(
        cell("company_name").alias("company_name"), cell("source").alias("source"), cell("board_ref").alias("board_ref"),
        F.coalesce(cell("active").try_cast("boolean"), F.lit(False)).alias("active"), F.coalesce(cell("tier").try_cast("int"), F.lit(1)).alias("tier"),
        F.coalesce(cell("website"), F.lit("")).alias("website"), F.coalesce(cell("notes"), F.lit("")).alias("notes"),
    )


def read_companies(spark: SparkSession, path: str, ref_column: str = "board_ref") -> DataFrame:
    schema = ", ".join(f"{ref_column if c == 'board_ref' else c} string" for c in COMPANY_COLUMNS)
    return as_companies(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def active_companies(companies: DataFrame, source: str | None = None) -> DataFrame:
    df = companies.filter("active")
    return df.filter(F.col("source") == source) if source else df


def write_projection(companies: DataFrame, path: str) -> None:
    """Active companies as CSV, same columns, in the table's order."""
    companies.filter("active").select(*COMPANY_COLUMNS).orderBy("source", F.lower("company_name")).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_rules(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A rule table; a wrong header or no rows is an error."""
    df = spark.read.option("header", True).csv(path)
    if df.columns != RULES[name]:
        raise ValueError(f"{name}: header {df.columns}, not {RULES[name]}")
    if df.isEmpty():
        raise ValueError(f"{name}: no rules")
    return df


def parse_labels(rows: DataFrame) -> DataFrame:
    """(job_key, relevant): rows with a blank key or verdict are skipped; an unknown spelling or a key twice is an error."""
    rows = rows.select(F.trim("job_key").alias("job_key"), F.lower(F.trim("relevant")).alias("v")).filter("coalesce(job_key, '') <> '' and coalesce(v, '') <> ''")
    verdict = F.when(F.col("v").isin(*YES), True).when(F.col("v").isin(*NO), False).otherwise(F.raise_error(F.concat(F.lit("unknown verdict: "), "v")).cast("boolean"))
    counted = rows.groupBy("job_key").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    once = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("label given twice: "), "job_key")).cast("boolean")).otherwise(verdict)
    return counted.select("job_key", once.alias("relevant"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return parse_labels(spark.read.schema("job_key string, relevant string").option("header", True).option("comment", "#").csv(path))
