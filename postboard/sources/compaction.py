"""Compaction of a landing: the many small files of a day partition become few, under the eyes of readers.

    <path>/source=<s>/ingest_date=<d>/part-...                     files as landed
    <path>/_compacted/<id>/source=<s>/ingest_date=<d>/part-...     files made of several landed ones
    <path>/_manifests/v<number>.json                               which compactions count, and which files they replace

Names that begin with an underscore are not part of the landing for Spark. A manifest is put in place by one rename: a reader
sees the small files or the large one, never both, and what is landed meanwhile is in no manifest and so is seen as well.
Replaced files stay until `vacuum`, for readers that began before.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postboard.sources import versioned
from postboard.sources.landing import expire as expire_files
from postboard.tables import materialise

MANIFESTS = "_manifests"


def manifest(spark: SparkSession, path: str) -> tuple[int, list[str], list[str], T.StructType | None]:
    """(number, compactions, replaced files, schema) of the newest manifest; -1 and nothing where there is none."""
    there = versioned.numbers(spark, path, MANIFESTS)
    if not there:
        return -1, [], [], None
    found = json.loads(spark.read.text(f"{path}/{MANIFESTS}/v{there[-1]}.json", wholetext=True).first()[0])
    return there[-1], found["added"], found["replaced"], T.StructType.fromJson(found["schema"])


def publish(spark: SparkSession, path: str, number: int, added: list[str], replaced: list[str], schema: T.StructType) -> None:
    versioned.put_once(spark, f"{path}/{MANIFESTS}/v{number}.json", json.dumps({"added": added, "replaced": replaced, "schema": schema.jsonValue()}))


def read(spark: SparkSession, path: str) -> DataFrame:
    """All landed rows, each once. Replaced files are left out when files are listed, before any is opened."""
    _, added, replaced, schema = manifest(spark, path)
    rows = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if replaced:
        rows = rows.filter(~F.col("_metadata.file_path").isin(replaced))
    for a in added:
        if any(n.startswith("source=") for n in versioned.names(spark, f"{path}/_compacted/{a}")):
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/_compacted/{a}"))
    return rows


def files(spark: SparkSession, path: str) -> DataFrame:
    """(source, ingest_date, file, bytes) of the landed files; none is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if "source" not in listed.columns:  # all files are replaced and gone
        return spark.createDataFrame([], "source string, ingest_date string, file string, bytes long")
    return listed.select(F.col("source").cast("string"), F.col("ingest_date").cast("string"), F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))


def bins(listed: DataFrame, target: int) -> DataFrame:
    """(source, ingest_date, file, bin) of the files to be put together: in each partition, files under half the target are
    laid in a row, the small ones last, and cut at each multiple of the target. A file alone in its bin is left."""
    row = Window.partitionBy("source", "ingest_date").orderBy(F.col("bytes").desc(), "file").rowsBetween(Window.unboundedPreceding, -1)
    small = listed.filter(F.col("bytes") < target / 2).withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(row), F.lit(0)) / target))
    return small.withColumn("_n", F.count("*").over(Window.partitionBy("source", "ingest_date", "bin"))).filter("_n > 1").drop("_n")


def compact(spark: SparkSession, path: str, target: int = 128 << 20) -> int:
    """Put small files together and publish them; the number of files that were replaced.

    One compaction at a time: of two, the second to publish fails and leaves the landing as the first made it.
    """
    number, added, replaced, _ = manifest(spark, path)
    chosen = materialise(bins(files(spark, path).filter(~F.col("file").isin(replaced)), target), "bins")
    n = chosen.select("source", "ingest_date", "bin").distinct().count()
    if not n:
        return 0
    this, rows = uuid.uuid4().hex, spark.read.parquet(path)
    schema = rows.schema
    names = [r["file"] for r in chosen.select("file").collect()]  # as many as Spark lists to read them
    rows = rows.withColumn("_file", F.col("_metadata.file_path")).filter(F.col("_file").isin(names)).join(F.broadcast(chosen.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"))), "_file")
    rows.repartition(n, "source", "ingest_date", "_bin").drop("_file", "_bin").write.partitionBy("source", "ingest_date").parquet(f"{path}/_compacted/{this}")
    publish(spark, path, number + 1, [*added, this], [*replaced, *names], schema)
    return len(names)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the replaced files, once no reader from before the last compaction is left; their number."""
    number, added, replaced, schema = manifest(spark, path)
    gone = 0
    for name in replaced:  # as Spark names files: a URI, with its escapes
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        gone += where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, False)
    if replaced:
        publish(spark, path, number + 1, added, [], schema)
    return gone


def expire(spark: SparkSession, path: str, days: int = 180) -> int:
    """Drop the day partitions that are more than `days` older than the newest, landed and compacted ones."""
    last = read(spark, path).agg(F.max("ingest_date")).first()[0]
    places = [path, *(f"{path}/_compacted/{a}" for a in manifest(spark, path)[1] if any(n.startswith("source=") for n in versioned.names(spark, f"{path}/_compacted/{a}")))]
    places = [p for p in places if p != path or not files(spark, path).isEmpty()]
    return sum(expire_files(spark, p, days, last) for p in places) if isinstance(last, dt.date) else 0
