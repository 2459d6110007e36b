"""Ranks and top rows that do not put all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postboard.tables import materialise


def global_row_number(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Adds 1..n in the given order over the whole frame.

    Rows are range-partitioned by the order and numbered within each partition; the counts of the partitions before are
    added. Only one number per partition is gathered. The order must be total, else equal rows get numbers in any order.
    The partitioned rows are written once: two exchanges would sample bounds of their own and disagree about partitions.
    """
    parts = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    parts = materialise(parts.withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, (local + F.col("_before")).cast("long")).drop("_part", "_before")


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def top_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int, salts: int = 16) -> DataFrame:
    """The first n rows of each group; first within salted parts of it, so that a hot group has many tasks."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    some = salted.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))).filter(F.col("_n") <= n)
    return some.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= n).drop("_n", "_salt")
