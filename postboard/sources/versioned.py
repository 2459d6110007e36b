"""Tables in hash buckets whose versions are switched by one rename.

    <path>/data/<write>/bucket=<k>/part-...      files, never changed
    <path>/manifests/v<number>.json              which write holds each bucket, the schema, and the batch

A change writes the touched buckets to a new place and then publishes a manifest that names them. Readers hold on to the
manifest they began with. Whatever a writer leaves behind before its manifest is there is seen by nobody, and of two writers
that publish one number, the second fails. Manifests have one entry per bucket, so they are as small as the number of buckets.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postboard.tables import materialise


@dataclass(frozen=True)
class Version:
    """What a manifest says; `batch` is the last batch of a stream that it holds."""

    number: int
    buckets: int
    schema: T.StructType
    parts: dict[int, str] = field(default_factory=dict)
    batch: int | None = None


def folder(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    fs, where = folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def numbers(spark: SparkSession, path: str, manifests: str = "manifests") -> list[int]:
    """The numbers of the published versions, ascending."""
    return sorted(int(m[1]) for n in names(spark, f"{path}/{manifests}") if (m := re.fullmatch(r"v(\d+)\.json", n)))


def load(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A published version, the newest if none is named; None where there is no table yet."""
    if number is None:
        there = numbers(spark, path)
        if not there:
            return None
        number = there[-1]
    found = json.loads(spark.read.text(f"{path}/manifests/v{number}.json", wholetext=True).first()[0])
    return Version(number, found["buckets"], T.StructType.fromJson(found["schema"]), {int(k): v for k, v in found["parts"].items()}, found["batch"])


def put_once(spark: SparkSession, target: str, text: str) -> None:
    """Write a small file beside its place, then rename it there; an error if there is one of that name."""
    jvm, (above, _, _) = spark._jvm, target.rpartition("/")
    fs, draft = folder(spark, f"{above}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    place = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(draft), place, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version the newest; an error if its number is taken."""
    put_once(spark, f"{path}/manifests/v{version.number}.json", json.dumps({"buckets": version.buckets, "batch": version.batch, "schema": version.schema.jsonValue(), "parts": version.parts}))


def bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read(spark: SparkSession, path: str, version: Version, only: set[int] | None = None) -> DataFrame:
    """The rows of a version, or of some of its buckets. Columns that older files lack are null."""
    places = [f"{path}/data/{w}/bucket={k}" for k, w in sorted(version.parts.items()) if only is None or k in only]
    return spark.read.schema(version.schema).parquet(*places) if places else spark.createDataFrame([], version.schema)


def touched_by(new: DataFrame, key: str, before: Version) -> set[int]:
    """The buckets of a frame's keys."""
    return {r[0] for r in new.select(bucket(F.col(key), before.buckets)).distinct().collect()}


def replace_buckets(df: DataFrame, path: str, key: str, before: Version, touched: set[int], batch: int | None = None, reduce: Callable[[DataFrame], DataFrame] | None = None) -> Version:
    """Put a frame in place of the touched buckets and publish the next version. Rows of a bucket come to one task: `reduce` can
    work on the keys there, by windows over `bucket` and the key, without another shuffle."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    place = f"{path}/data/{write}"
    rows = df.withColumn("bucket", bucket(F.col(key), before.buckets)).repartition(max(1, len(touched)), "bucket")
    rows = reduce(rows) if reduce else rows
    rows.write.option("compression", "zstd").partitionBy("bucket").parquet(place)
    written = {int(n.partition("=")[2]) for n in names(spark, place) if n.startswith("bucket=")}
    if not written <= touched:
        raise ValueError(f"rows of buckets that are not to be replaced: {sorted(written - touched)[:5]}")
    parts = {k: w for k, w in before.parts.items() if k not in touched} | dict.fromkeys(sorted(written), write)
    version = Version(before.number + 1, before.buckets, T.StructType([f for f in rows.schema.fields if f.name != "bucket"]), parts, before.batch if batch is None else batch)
    publish(spark, path, version)
    return version


def change(path: str, new: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], *, buckets: int = 256, batch: int | None = None) -> Version:
    """Merge new rows into the table: merge(old rows of the touched buckets, new rows) takes the place of these buckets.

    The first change makes the table and fixes its number of buckets. Only as many numbers as there are buckets reach the
    driver. The merged columns are the table's from then on. The new rows are computed once.
    """
    spark, new = new.sparkSession, materialise(new, "changes")
    before = load(spark, path) or Version(-1, buckets, new.schema)
    touched = touched_by(new, key, before)
    return replace_buckets(merge(read(spark, path, before, touched), new), path, key, before, touched, batch)


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the newest versions, and the files that none of these names; the number of removed writes.

    Not to be called while a writer is at work: its files are not named yet.
    """
    there = numbers(spark, path)
    kept = {w for n in there[-keep:] for w in load(spark, path, n).parts.values()}
    gone = [w for w in names(spark, f"{path}/data") if w not in kept]
    for place in [f"{path}/manifests/v{n}.json" for n in there[:-keep]] + [f"{path}/data/{w}" for w in gone]:
        fs, where = folder(spark, place)
        fs.delete(where, True)
    return len(gone)
