"""The company table: merging, validating, looking up, reporting; and what discovery found."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.functions.text import blank_to_null, redact_ref
from postboard.functions.web import normalize_domain, ref_ok
from postboard.operators.ranking import first_per_key


def name_key(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def merge(master: DataFrame, incoming: DataFrame) -> DataFrame:
    """The union by name, the master's rows winning; website and notes are filled where blank.

    `added`, `filled` and `conflict` (another source or board) tell what happened. `incoming` has `pos`: of rows with one
    name, the first is added and later ones only fill.
    """
    both = lambda c: F.min_by(c, F.when(blank_to_null(F.col(c)).isNotNull(), F.col("pos")))
    first = lambda c: F.min_by(c, "pos")
    new = incoming.groupBy(name_key(F.col("company_name")).alias("_key")).agg(
        *[first(c).alias(f"_{c}") for c in ("company_name", "source", "board_ref", "active", "tier")], *[both(c).alias(f"_{c}") for c in ("website", "notes")]
    )
    old = master.withColumn("_master", name_key(F.col("company_name")))
    df = old.join(new, F.col("_master") == F.col("_key"), "full_outer")
    there = F.col("_master").isNotNull()
    keep = [F.when(there, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("company_name", "source", "board_ref", "active", "tier")]
    fill = [F.coalesce(blank_to_null(F.col(c)), F.col(f"_{c}"), F.lit("")).alias(c) for c in ("website", "notes")]
    gained = lambda c: blank_to_null(F.col(c)).isNull() & blank_to_null(F.col(f"_{c}")).isNotNull()
    other = ~(F.col("source").eqNullSafe(F.col("_source")) & F.col("board_ref").eqNullSafe(F.col("_board_ref")))
    return df.select(*keep, *fill, (~there).alias("added"), (there & (gained("website") | gained("notes"))).alias("filled"), (there & F.col("_key").isNotNull() & other).alias("conflict"))


def validate(rows: DataFrame, sources: Sequence[str]) -> DataFrame:
    """(row_no, level, problem) of string rows with row_no (the header is row 1): malformed rows and bad board names.

    A bad name is a problem on an active row and a notice on another; sources that are not registered are skipped.
    """
    active = F.coalesce(blank_to_null(F.lower(F.trim("active"))), F.lit("false"))
    cell = lambda c: blank_to_null(F.trim(F.col(c)))
    malformed = cell("company_name").isNull() | cell("source").isNull() | active.try_cast("boolean").isNull() | (cell("tier").isNotNull() & cell("tier").try_cast("int").isNull())
    bad = F.col("source").isin(*sources) & ~ref_ok(cell("source"), F.coalesce(cell("board_ref"), F.lit("")))
    level = F.when(malformed, "problem").when(bad & active.try_cast("boolean"), "problem").when(bad, "notice")
    return rows.select("row_no", level.alias("level"), F.when(malformed, "malformed row").when(bad, "bad board name").alias("problem")).filter("level is not null")


def resolve_redacted(companies: DataFrame, refs: DataFrame) -> DataFrame:
    """Companies whose name or board name has one of the redacted forms in `refs` (column ref)."""
    digests = F.array_distinct(F.array(redact_ref(F.col("company_name")), redact_ref(F.col("board_ref"))))
    return companies.withColumn("ref", F.explode(F.filter(digests, lambda x: x.isNotNull()))).join(refs.select("ref").distinct(), "ref")


def resume_results(todo: DataFrame, done: DataFrame) -> DataFrame:
    """Rows to do with an earlier result (column status) where one exists; key: domain, else name."""
    key = F.coalesce(blank_to_null(normalize_domain(F.col("website"))), F.lower(F.trim("company_name")))
    old = done.filter("coalesce(status, '') <> ''").select(key.alias("_key"), F.col("status").alias("status")).groupBy("_key").agg(F.max("status").alias("status"))
    return todo.withColumn("_key", key).join(old, "_key", "left").drop("_key")


def inventory(companies: DataFrame) -> DataFrame:
    """Per source and in total (source null): rows, active, inactive, without a board name, with a website."""
    return companies.rollup("source").agg(
        F.count("*").alias("rows"), F.count_if("active").alias("active"), F.count_if(~F.col("active")).alias("inactive"),
        F.count_if(blank_to_null(F.col("board_ref")).isNull()).alias("blank_refs"), F.count_if(blank_to_null(F.col("website")).isNotNull()).alias("with_website"),
    )


def layout_order() -> list[Column]:
    return [F.col("active").desc(), F.col("source").asc(), F.lower("company_name").asc()]


def layout(companies: DataFrame) -> DataFrame:
    return companies.orderBy(*layout_order())


def category_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(blank_to_null(F.trim(F.col(column))).isNotNull()).groupBy(F.trim(F.col(column)).alias("category")).agg(F.count("*").alias("n"))


def discovered(records: DataFrame, feeds: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Records (pos, company_name, source, token, website) split into boards to ingest and rows to review.

    Undetected records (no source) are dropped. Of one board, or one row, the first stays. A valid board of a known
    feed is active with tier 1; other detected rows go to the inventory, inactive with tier 2.
    """
    found = records.filter(blank_to_null(F.col("source")).isNotNull())
    good = F.col("source").isin(*feeds) & ref_ok(F.col("source"), F.coalesce("token", F.lit("")))
    boards = first_per_key(found.filter(good), ["source", F.lower("token")], [F.col("pos")]).withColumns({"active": F.lit(True), "tier": F.lit(1)})
    review = first_per_key(found.filter(~good), ["source", F.lower(F.coalesce("token", F.lit(""))), F.lower("company_name")], [F.col("pos")])
    return boards, review.withColumns({"active": F.lit(False), "tier": F.lit(2)})
