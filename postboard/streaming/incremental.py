"""Incremental forms: file streams into the landing, lifecycle state, and net-new postings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postboard.operators.delivery import deliver
from postboard.operators.postings import keyed, lifecycle, maybe_there, newest_order, pointers
from postboard.sources import versioned
from postboard.tables import materialise


def stream_landing(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType) -> StreamingQuery:
    """Append each landed file once; runs until all that is there has been read."""
    return spark.readStream.schema(schema).parquet(source).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def partial_state(landing: DataFrame) -> DataFrame:
    """The lifecycle of a batch; merging such states in any order gives the lifecycle of all."""
    return lifecycle(keyed(landing))


def merge_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after a batch of landed rows."""
    return merged_states(state, partial_state(batch))


def merged_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """One state of two: minima, maxima and the newer row, by a join of rows that are unique on both sides."""

    def order(side: str) -> Column:
        c = lambda name: F.col(f"{side}.{name}")
        return F.struct(c("last_seen_at"), c("posted_or_updated_at"), c("title"), c("url"), F.md5(c("description_html")))

    old, new = a.select("job_key", F.struct(*a.columns).alias("_a")), b.select("job_key", F.struct(*a.columns).alias("_b"))
    both = old.join(new, "job_key", "full")
    row = F.when(F.col("_a").isNull() | (F.col("_b").isNotNull() & (order("_b") > order("_a"))), F.col("_b")).otherwise(F.col("_a"))
    seen = {"first_seen_at": F.least("_a.first_seen_at", "_b.first_seen_at"), "last_seen_at": F.greatest("_a.last_seen_at", "_b.last_seen_at")}
    return both.withColumn("_row", row).select(*[seen.get(c, F.col(f"_row.{c}")).alias(c) for c in a.columns])


def spans(state: DataFrame, landing: DataFrame) -> DataFrame:
    """(job_key, first_seen_at, last_seen_at, old, new) of the state's and the landed postings, and whether the newest row can be
    in the state, among the landed rows, or in both. No bodies are read."""
    seen = pointers(landing).groupBy("job_key").agg(F.min("first_seen_at").alias("_first"), F.max("last_seen_at").alias("_last"))
    both = state.select("job_key", "first_seen_at", "last_seen_at").join(seen, "job_key", "full")
    last = F.greatest("last_seen_at", "_last")
    return both.select("job_key", F.least("first_seen_at", "_first").alias("first_seen_at"), last.alias("last_seen_at"), F.col("last_seen_at").eqNullSafe(last).alias("old"), F.col("_last").eqNullSafe(last).alias("new"))


def bodies(state: DataFrame, landing: DataFrame, span: DataFrame, n: int) -> DataFrame:
    """The rows of the state and the landed rows that may be a posting's newest, by bitmaps of the spans: of the rows that a newer
    one replaces, few are left."""
    old = maybe_there(state, span.filter("old").select("job_key"), n, "job_key")
    new = maybe_there(landing, span.filter("new").select("job_key", F.col("last_seen_at").alias("ingested_at")), n, "job_key", "ingested_at")
    return old.unionByName(new.withColumn("first_seen_at", F.col("ingested_at")).withColumn("last_seen_at", F.col("ingested_at")).select(*state.columns))


def newest_states(rows: DataFrame) -> DataFrame:
    """Of bodies and spans in buckets, the newest body of each posting with the least and greatest stamp."""
    each = Window.partitionBy("bucket", "job_key")
    newest = each.orderBy(F.col("_body").desc(), F.col("last_seen_at").desc_nulls_last(), *newest_order())
    rows = rows.withColumn("_n", F.row_number().over(newest)).withColumn("first_seen_at", F.min("first_seen_at").over(each)).withColumn("last_seen_at", F.max("last_seen_at").over(each))
    return rows.filter("_n = 1").drop("_n", "_body")


def update_state(path: str, landing: DataFrame, buckets: int, batch: int) -> versioned.Version:
    """The next version of the state: landed rows, keyed, merged into the buckets that they touch.

    Stamps are compared first, without bodies. Then the bodies that can be newest, about one per posting, go through one
    shuffle, that into buckets, and the spans go with them.
    """
    spark, stamp = landing.sparkSession, landing.schema["ingested_at"].dataType
    columns = ["job_key", *[c for c in landing.columns if c != "job_key"]]
    schema = T.StructType([landing.schema[c] for c in columns] + [T.StructField(c, stamp) for c in ("first_seen_at", "last_seen_at")])
    before = versioned.load(spark, path) or versioned.Version(-1, buckets, schema)
    touched = versioned.touched_by(landing, "job_key", before)
    state = versioned.read(spark, path, before, touched)
    span = materialise(spans(state, landing), "spans")
    rows = bodies(state, landing, span, span.count()).withColumn("_body", F.lit(True))
    rows = rows.unionByName(span.drop("old", "new").withColumn("_body", F.lit(False)), allowMissingColumns=True)
    return versioned.replace_buckets(rows, path, "job_key", before, touched, batch, newest_states)


def state_of(spark: SparkSession, state_path: str, number: int | None = None) -> DataFrame | None:
    """The state that the stream keeps; None before its first batch."""
    version = versioned.load(spark, state_path, number)
    return version and versioned.read(spark, state_path, version)


def stream_lifecycle(spark: SparkSession, source: str, state_path: str, checkpoint: str, schema: T.StructType, files_each: int | None = None, buckets: int = 256) -> StreamingQuery:
    """Keep the state of a growing landing folder in buckets by key; a trigger rewrites only those that its rows touch.

    All new files of a trigger are one batch (unless `files_each` bounds them). A version of the table names the batch that it
    holds: a batch that is run again after its version is there changes nothing, and one whose predecessor is not there is an
    error, as the state would lack rows. The version before stays for readers; older ones go.
    """

    def step(batch: DataFrame, n: int) -> None:
        s = batch.sparkSession
        before = versioned.load(s, state_path)
        done = -1 if before is None else before.batch
        if done >= n:
            return
        if done != n - 1:
            raise ValueError(f"the state holds batch {done}, and batch {n} was to follow")
        update_state(state_path, keyed(batch), buckets, n)
        versioned.expire(s, state_path, keep=2)

    files = spark.readStream.schema(schema)
    if files_each:
        files = files.option("maxFilesPerTrigger", files_each)
    return files.parquet(source).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def net_new(batch: DataFrame, state: DataFrame) -> DataFrame:
    """The batch's postings that the state does not know, one row each."""
    return keyed(batch).select("job_key").distinct().join(state.select("job_key"), "job_key", "left_anti")


def stream_net_new(spark: SparkSession, source: str, target: str, checkpoint: str, schema: T.StructType, files_each: int | None = None) -> StreamingQuery:
    """Append (job_key, source, company, external_id) of each posting that no earlier file held, once.

    The keys seen so far are the state of the stream, kept in its checkpoint; late and repeated files add nothing, and a
    restart goes on where it was. There is no watermark, as a posting may come back at any time: the state has a row per posting.
    On a cluster it belongs in RocksDB (`spark.sql.streaming.stateStore.providerClass`).
    """
    files = spark.readStream.schema(schema)
    if files_each:
        files = files.option("maxFilesPerTrigger", files_each)
    new = keyed(files.parquet(source)).select("job_key", "source", "company", "external_id").dropDuplicates(["job_key"])
    return new.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_delivery(spark: SparkSession, source: str, outbox: str, ledger_path: str, checkpoint: str, schema: T.StructType, send: Callable[[int, DataFrame], None], now: Column, files_each: int | None = None) -> StreamingQuery:
    """Deliver each trigger's gold rows as one numbered delivery; see `deliver` for what a failure and a restart do."""
    files = spark.readStream.schema(schema)
    if files_each:
        files = files.option("maxFilesPerTrigger", files_each)
    step = lambda batch, n: deliver(batch, outbox, ledger_path, n, send, now)
    return files.parquet(source).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
