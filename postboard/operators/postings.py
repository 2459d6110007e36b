"""From landed rows to current postings with lifecycle, signals and rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.functions.text import hours_before, strip_html, surrogate_key
from postboard.operators.matching import any_word, matched_terms
from postboard.operators.ranking import first_per_key, global_row_number
from postboard.tables import materialise

PAYLOAD = ["title", "location", "remote_policy", "department", "employment_type", "url", "description_html"]


def keyed(landing: DataFrame) -> DataFrame:
    """Adds the posting's identity."""
    return landing.withColumn("job_key", surrogate_key(F.col("source"), F.col("company"), F.col("external_id")))


#: Up to this many pointers (about 100 bytes each) are sent to all tasks; more are sent as a bitmap first.
MOST_SENT = 1_000_000
#: Bits of one row of the bitmap, and of the whole at most (256 MB).
ROW_BITS, MOST_BITS = 32_768, 1 << 31


def newest_order() -> list[Column]:
    """Among rows of one landing: latest post date (nulls last), then title, url and a digest of the body."""
    return [F.col("posted_or_updated_at").desc_nulls_last(), F.col("title").desc_nulls_last(), F.col("url").desc_nulls_last(), F.md5("description_html").desc_nulls_last()]


def pointers(landing: DataFrame) -> DataFrame:
    """(job_key, source, company, first_seen_at, last_seen_at): all that the history has to say of a posting, in fixed-width
    aggregates over four narrow columns."""
    return landing.groupBy("job_key", "source", "company").agg(F.min("ingested_at").alias("first_seen_at"), F.max("ingested_at").alias("last_seen_at"))


def maybe_there(rows: DataFrame, wanted: DataFrame, n: int, *columns: str) -> DataFrame:
    """The rows whose columns occur in the other frame, and some of the others: one bit per wanted row, at a hash, in a bitmap
    of sixteen bits for each of the n wanted, so that few unwanted rows go into the shuffle of the join that follows."""
    bits = min(MOST_BITS, max(ROW_BITS, 1 << (16 * n - 1).bit_length()))
    place = F.pmod(F.xxhash64(*columns), F.lit(bits))
    row, bit = F.expr(f"_at div {ROW_BITS}").alias("_row"), F.col("_at") % ROW_BITS
    marks = wanted.select(place.alias("_at")).groupBy(row).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    rows = rows.withColumn("_at", place).withColumn("_row", row).join(F.broadcast(marks), "_row")
    byte = F.conv(F.hex(F.substring("_bits", F.expr(f"cast(_at % {ROW_BITS} div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    return rows.filter(F.call_function("shiftright", byte, F.expr("cast(_at % 8 as int)")) % 2 == 1).drop("_at", "_row", "_bits")


def newest_rows(landing: DataFrame, seen: DataFrame, most_sent: int | None = None) -> DataFrame:
    """One row per posting with first_seen_at and last_seen_at: its newest row, fetched by its pointer.

    Bodies of older rows are read, but go into no shuffle: where there are few pointers they are broadcast, and where there
    are many a bitmap of them is, before the rows that pass it are joined.
    """
    seen = seen.groupBy("job_key").agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))
    n = seen.count()
    columns = [c for c in landing.columns if c != "job_key"]
    if n <= (MOST_SENT if most_sent is None else most_sent):
        seen = F.broadcast(seen)
    else:
        landing = maybe_there(landing, seen.withColumnRenamed("last_seen_at", "ingested_at"), n, "job_key", "ingested_at")
    wanted = seen.withColumnRenamed("job_key", "_key")
    last = landing.join(wanted, (F.col("job_key") == F.col("_key")) & F.col("ingested_at").eqNullSafe(F.col("last_seen_at")))
    return first_per_key(last, ["job_key"], newest_order()).select("job_key", *columns, "first_seen_at", "last_seen_at")


def lifecycle(landing: DataFrame) -> DataFrame:
    """One row per posting: its newest row, first_seen_at and last_seen_at. The landing is read twice, narrow and whole."""
    return newest_rows(landing, materialise(pointers(landing), "pointers"))


def board_maxima(landing: DataFrame) -> DataFrame:
    """(source, company, first_at, board_at): when each board landed first and last."""
    return landing.groupBy("source", "company").agg(F.min("ingested_at").alias("first_at"), F.max("ingested_at").alias("board_at"))


def with_activity(current: DataFrame, boards: DataFrame, stale_hours: int = 36) -> DataFrame:
    """Adds is_active: seen in its board's last landing, and the board landed within the hours before the last of all; and
    inactive_reason, null for active ones. A board that is no longer landed would keep its postings alive for ever without
    the second condition.

    The boards' maxima come from every landed row. Boards with null parts compare as equal.
    """
    boards = boards.select(F.col("source").alias("_source"), F.col("company").alias("_company"), F.col("board_at").alias("_board_at"))
    last = boards.agg(F.max("_board_at").alias("_last_at"))
    df = current.join(boards, F.col("source").eqNullSafe(F.col("_source")) & F.col("company").eqNullSafe(F.col("_company")), "left").join(F.broadcast(last), how="cross")
    fresh = F.coalesce(F.col("_board_at") >= hours_before(F.col("_last_at"), stale_hours), F.lit(False))
    there = F.coalesce(F.col("last_seen_at") >= F.col("_board_at"), F.lit(False))
    df = df.withColumn("inactive_reason", F.when(~fresh, "stale board").when(~there, "not in the last landing"))
    return df.withColumn("is_active", fresh & there).drop("_source", "_company", "_board_at", "_last_at")


def current_postings(landing: DataFrame, stale_hours: int = 36) -> DataFrame:
    """The lifecycle with is_active; the boards' maxima come from the same pointers, not from the landing again."""
    seen = materialise(pointers(landing), "pointers")
    boards = seen.groupBy("source", "company").agg(F.min("first_seen_at").alias("first_at"), F.max("last_seen_at").alias("board_at"))
    return with_activity(newest_rows(landing, seen), boards, stale_hours)


def location_allowed(location: Column, markers: Sequence[str]) -> Column:
    """Unknown and bare remote locations pass, others need a marker as a whole word; '' does not pass."""
    return location.isNull() | (F.lower(F.trim(location)) == "remote") | any_word(location, markers)


def with_signals(
    df: DataFrame, *, desired: Sequence[str], titles: Sequence[str], deal_breakers: Sequence[str], title_weight: int = 2, deal_breaker_weight: int = 1
) -> DataFrame:
    """Adds hits, title_match, deal_breaker_terms (null if none) and match_score, in one pass without joins."""
    broken = F.col("_broken")
    df = df.withColumn("desired_tech_hits", F.size(matched_terms(F.col("clean_text"), desired)).cast("long")).withColumn("title_match", any_word(F.col("title"), titles))
    df = df.withColumn("_broken", matched_terms(F.col("clean_text"), deal_breakers))
    df = df.withColumn("deal_breaker_hits", F.size(broken).cast("long")).withColumn("deal_breaker_terms", F.when(F.size(broken) > 0, F.array_join(broken, ", "))).drop("_broken")
    score = F.col("desired_tech_hits") + F.when(F.col("title_match"), title_weight).otherwise(0) - deal_breaker_weight * F.col("deal_breaker_hits")
    return df.withColumn("match_score", score.cast("long"))


def silver(
    landing: DataFrame, *, locations: Sequence[str], desired: Sequence[str], titles: Sequence[str], deal_breakers: Sequence[str], stale_hours: int = 36
) -> DataFrame:
    """Current postings in allowed locations with lifecycle and signals.

    Tags are stripped and texts hashed only after the newest row is known, so the many older copies are not touched.
    """
    df = current_postings(keyed(landing), stale_hours).filter(location_allowed(F.col("location"), locations))
    df = df.withColumn("clean_text", strip_html(F.col("description_html")))
    df = df.withColumn("content_hash", surrogate_key(F.col("title"), F.col("clean_text")))
    return with_signals(df, desired=desired, titles=titles, deal_breakers=deal_breakers)


def valid_score(score: Column) -> Column:
    """Scores outside 1..5 become null; they are not clamped."""
    return F.when(score.between(1, 5), score)


def recency() -> list[Column]:
    return [F.col("posted_or_updated_at").desc_nulls_last(), F.col("job_key").asc()]


def gold(silver_df: DataFrame, scored: DataFrame | None = None, extracted: DataFrame | None = None, matched: DataFrame | None = None) -> DataFrame:
    """Live postings with model columns by content hash, ranked 1..n by recency. Absent tables give null columns."""
    df = silver_df.filter("is_active")
    for table, columns in (
        (scored, ["fit_score", "prompt_version", "scored_at"]),
        (extracted, ["company_type", "geo_restriction", "manages_people"]),
        (matched, ["similarity", "best_match_source"]),
    ):
        if table is not None:
            df = df.join(table.select("content_hash", *[c for c in columns if c in table.columns]), "content_hash", "left")
    if "fit_score" in df.columns:
        df = df.withColumn("fit_score", valid_score(F.col("fit_score")))
    return global_row_number(df, recency(), "recency_rank")
