"""Small helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postboard.tables import materialise, shared_dir

__all__ = ["SPACES", "hash_share", "held_out", "materialise", "rows_of", "running_sum", "shared_dir", "words"]

#: White space between words: space, and tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model may learn from (null ids count as learnable)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[list[Any], ...]]:
    """Lists of the named columns, batch by batch."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)


def hash_share(df: DataFrame, columns: str | Sequence[str], most: int, total: int) -> DataFrame:
    """About `most` of `total` rows, chosen by a hash of the columns; all rows if there are fewer. Rows that are equal in the
    columns go together, so they should tell rows apart: an id that many rows share does not."""
    if total <= most:
        return df
    columns = [columns] if isinstance(columns, str) else columns
    return df.filter(F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) < int(1_000_000 * most / total))


def running_sum(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of a column over all rows before, in the given order over the whole frame.

    Rows are range-partitioned by the order and added up within each partition, and the sums of the partitions before are
    added. Only one number per partition is gathered. Rows that are equal in the order get sums in any order.
    """
    parts = materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_part").agg(F.sum(value).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return parts.join(F.broadcast(offsets), "_part").withColumn(name, F.coalesce(local, F.lit(0)) + F.col("_before")).drop("_part", "_before")
