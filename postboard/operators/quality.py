"""Checks of tables: each returns (check, column, failures, severity) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("column"), F.col(c).alias("failures"), F.lit("error").alias("severity")) for c in columns])
    return counts.select(F.inline(rows))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Failures are values that occur more than once; nulls do not count."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
    return repeated.agg(F.count("*").alias("failures")).select(F.lit("unique").alias("check"), F.lit(column).alias("column"), "failures", F.lit("error").alias("severity"))


def accepted_values(df: DataFrame, column: str, values: Sequence[str], severity: str = "error") -> DataFrame:
    """Failures are distinct values outside the list; nulls pass."""
    other = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values)).select(column).distinct()
    return other.agg(F.count("*").alias("failures")).select(F.lit("accepted_values").alias("check"), F.lit(column).alias("column"), "failures", F.lit(severity).alias("severity"))


def require_contract(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The frame itself if its names and types are those declared, in any order; else an error that lists what differs."""
    wanted = {f.name: f.dataType for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema)}
    there = {f.name: f.dataType for f in df.schema}
    if wrong := sorted(n for n in {*wanted, *there} if wanted.get(n) != there.get(n)):
        raise ValueError("contract broken by " + ", ".join(f"{n} ({there.get(n)}, not {wanted.get(n)})" for n in wrong))
    return df
