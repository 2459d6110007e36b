"""How the tables of a folder play the parts of the posting pipeline, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = ["Canada", "Ontario", "ON", "Ottawa", "Toronto", "Montreal"]
DESIRED = ["the", "of", "und", "mit", "les", "c++", ".net"]
TITLES = ["the", "de", "der"]
DEAL_BREAKERS = ["with", "nicht", "pour", "los"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(n: Column) -> Column:
    """Locations of every kind the gate knows, by a number."""
    k = n % 8
    return (
        F.when(k == 0, "Remote").when(k == 2, "").when(k == 3, "Remote - United Kingdom").when(k == 4, "Ottawa, ON, Canada")
        .when(k == 5, "Berlin, Germany").when(k == 6, "Montreal, QC").when(k == 7, " remote ")
    )


PLACE_SQL = """CASE {0} % 8 WHEN 0 THEN 'Remote' WHEN 2 THEN '' WHEN 3 THEN 'Remote - United Kingdom' WHEN 4 THEN 'Ottawa, ON, Canada'
  WHEN 5 THEN 'Berlin, Germany' WHEN 6 THEN 'Montreal, QC' WHEN 7 THEN ' remote ' END"""


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only landing: one landed row per event, the posting's text from documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = table(spark, sf_dir, "events").join(docs, F.col("user_id") == F.col("doc_id"))
    return df.select(
        F.col("event_type").alias("source"), (F.col("user_id") % 75).cast("string").alias("company"), F.col("user_id").cast("string").alias("external_id"),
        F.substring("text", 1, 60).alias("title"), place(F.col("user_id")).alias("location"), F.concat(F.lit("https://example.com/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("description_html"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ingested_at"), F.col("ts").alias("posted_or_updated_at"),
    )


LANDING_SQL = f"""landing AS (
  SELECT event_type AS source, CAST(user_id % 75 AS VARCHAR) AS company, CAST(user_id AS VARCHAR) AS external_id,
    substr(text, 1, 60) AS title, {PLACE_SQL.format('user_id')} AS location, 'https://example.com/' || event_id AS url,
    '<p>' || text || '</p>' AS description_html, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ingested_at, ts AS posted_or_updated_at
  FROM events JOIN documents ON doc_id = user_id)"""


def key_sql(*columns: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns) + "))"


def word_sql(text: str, term: str) -> str:
    import re

    special = re.sub(r"([^A-Za-z0-9\s])", r"\\\1", term.lower())
    return f"coalesce(regexp_matches(lower({text}), '(^|[^a-z0-9]){special}($|[^a-z0-9])'), false)"


def terms_sql(text: str, terms: list[str]) -> str:
    """A list of the matched terms, sorted."""
    cases = ", ".join(f"CASE WHEN {word_sql(text, t)} THEN '{t}' END" for t in sorted(terms))
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


LIFE_SQL = f"""{LANDING_SQL},
keyed AS (SELECT *, {key_sql('source', 'company', 'external_id')} AS job_key FROM landing),
life AS (
  SELECT *, min(ingested_at) OVER (PARTITION BY job_key) AS first_seen_at, max(ingested_at) OVER (PARTITION BY job_key) AS last_seen_at,
    max(ingested_at) OVER (PARTITION BY source, company) AS board_at, max(ingested_at) OVER () AS last_at,
    row_number() OVER (PARTITION BY job_key ORDER BY ingested_at DESC, posted_or_updated_at DESC NULLS LAST, title DESC, url DESC, md5(description_html) DESC) AS rn
  FROM keyed),
current AS (
  SELECT * EXCLUDE (rn, board_at, last_at), last_seen_at >= board_at AND board_at >= last_at - INTERVAL 36 HOUR AS is_active FROM life WHERE rn = 1)"""

GATE_SQL = "(location IS NULL OR lower(trim(location)) = 'remote' OR " + " OR ".join(word_sql("location", m) for m in MARKERS) + ")"
SILVER_SQL = f"""{LIFE_SQL},
texts AS (SELECT *, regexp_replace(description_html, '<[^>]+>', ' ', 'g') AS clean_text FROM current WHERE {GATE_SQL}),
hits AS (
  SELECT *, {key_sql('title', 'clean_text')} AS content_hash, len({terms_sql('clean_text', DESIRED)}) AS desired_tech_hits,
    ({' OR '.join(word_sql('title', t) for t in TITLES)}) AS title_match, {terms_sql('clean_text', DEAL_BREAKERS)} AS broken
  FROM texts),
silver AS (
  SELECT * EXCLUDE (broken), len(broken) AS deal_breaker_hits, CASE WHEN len(broken) > 0 THEN array_to_string(broken, ', ') END AS deal_breaker_terms,
    desired_tech_hits + CASE WHEN title_match THEN 2 ELSE 0 END - len(broken) AS match_score
  FROM hits)"""


def model_row(hash_column: Column) -> dict[str, Column]:
    """Stand-ins for model answers that SQL can repeat: digits of a hash."""
    digit = lambda k: F.conv(F.substring(F.md5(hash_column), k, 2), 16, 10).cast("long")
    return {"raw": digit(1) / F.lit(36.0), "geo": digit(3) % 3, "type": digit(5) % 2, "ok": digit(7) % 10 != 0}


def digit_sql(column: str, k: int) -> str:
    return f"CAST(('0x' || substr(md5({column}), {k}, 2)) AS BIGINT)"


MODEL_SQL = f"""{SILVER_SQL},
works AS (SELECT DISTINCT content_hash FROM silver),
extracted AS (
  SELECT content_hash, CASE {digit_sql('content_hash', 5)} % 2 WHEN 0 THEN 'product' ELSE 'services' END AS company_type,
    CASE {digit_sql('content_hash', 3)} % 3 WHEN 0 THEN 'us_only' WHEN 1 THEN 'unclear' ELSE 'canada_ok' END AS geo_restriction,
    CASE {digit_sql('content_hash', 5)} % 2 WHEN 0 THEN 'yes' ELSE 'no' END AS manages_people, {digit_sql('content_hash', 7)} % 10 <> 0 AS extract_ok
  FROM works),
scored AS (SELECT content_hash, CAST(round({digit_sql('content_hash', 1)} / 36.0::DOUBLE) AS BIGINT) AS fit_score FROM extracted WHERE extract_ok)"""
GOLD_SQL = f"""{MODEL_SQL},
gold AS (
  SELECT s.*, CASE WHEN fit_score BETWEEN 1 AND 5 THEN fit_score END AS fit_score, company_type, geo_restriction, manages_people,
    row_number() OVER (ORDER BY posted_or_updated_at DESC NULLS LAST, job_key) AS recency_rank
  FROM silver s LEFT JOIN scored USING (content_hash) LEFT JOIN extracted USING (content_hash) WHERE is_active)"""
