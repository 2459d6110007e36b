"""Silver and gold on small given rows: lifecycle, gate, signals, rank."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postboard.operators import postings
from postboard.operators.matching import MOST_NATIVE, any_word, has_word, matched_terms
from postboard.operators.ranking import global_row_number, top_per_group

RAW = "external_id string, source string, company string, title string, description_html string, location string, ingested_at timestamp, posted_or_updated_at timestamp, url string"
RULES = {"locations": ["Canada", "Ontario", "ON", "Ottawa", "Toronto", "Montreal"], "desired": [], "titles": [], "deal_breakers": []}


def at(day, hour=0, month=7):
    return dt.datetime(2026, month, day, hour)


def raw(spark, rows):
    full = [{"source": "s", "company": "c", "title": "t", "description_html": "", "location": None, "ingested_at": at(2), "posted_or_updated_at": None, "url": None} | r for r in rows]
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RAW)


def silver(spark, rows, **rules):
    return {r.external_id: r for r in postings.silver(raw(spark, rows), **(RULES | rules)).collect()}


def test_newest_row_wins(spark):
    got = silver(spark, [{"external_id": "k1", "title": "old title", "ingested_at": at(1), "posted_or_updated_at": at(1)}, {"external_id": "k1", "title": "new title", "posted_or_updated_at": at(1)}])
    assert got["k1"].title == "new title" and got["k1"].first_seen_at == at(1) and got["k1"].last_seen_at == at(2)


def test_deal_breakers_annotate(spark):
    texts = ["We use Kafka daily", "Kafkaesque bureaucracy", "knows kafka a plus", "Spark and Kafka pipelines", "none"]
    got = silver(spark, [{"external_id": str(i), "description_html": t} for i, t in enumerate(texts)], deal_breakers=["Kafka", "Spark"])
    assert [(got[str(i)].deal_breaker_hits, got[str(i)].deal_breaker_terms) for i in range(5)] == [(1, "Kafka"), (0, None), (1, "Kafka"), (2, "Kafka, Spark"), (0, None)]


def test_score(spark):
    rows = [{"external_id": "a", "title": "Data Engineer", "description_html": "dbt BigQuery kafka"}, {"external_id": "b"}, {"external_id": "c", "title": "Data Engineer"}]
    got = silver(spark, rows, desired=["dbt", "BigQuery"], titles=["data engineer"], deal_breakers=["kafka"])
    assert {k: r.match_score for k, r in got.items()} == {"a": 3, "b": 0, "c": 2} and got["a"].title_match and not got["b"].title_match


def test_location_gate(spark):
    places = ["Remote", None, "Ottawa, ON, Canada", "Ottawa, ON", "Toronto", "Montreal, QC", " remote ", "London, UK", "Berlin, Germany", "Remote - United Kingdom", "", "Bonn"]
    rows = [{"external_id": str(i), "location": p} for i, p in enumerate(places)]
    assert sorted(silver(spark, rows), key=int) == [str(i) for i in range(7)]
    assert sorted(silver(spark, rows, locations=[]), key=int) == ["0", "1", "6"]


def test_taken_down_and_stale(spark):
    got = silver(spark, [{"external_id": "k1", "ingested_at": at(1)}, {"external_id": "k1"}, {"external_id": "k2", "ingested_at": at(1)}])
    assert got["k1"].is_active and not got["k2"].is_active and got["k2"].first_seen_at == at(1)
    rows = [{"external_id": "old", "company": "x", "ingested_at": at(25, month=6)}, {"external_id": "late", "company": "y", "ingested_at": at(2, 9)}, {"external_id": "now", "company": None, "ingested_at": at(2, 10)}]
    got = silver(spark, rows)
    assert {k: (r.is_active, r.inactive_reason) for k, r in got.items()} == {"old": (False, "stale board"), "late": (True, None), "now": (True, None)}


def test_special_terms(spark):
    got = silver(spark, [{"external_id": "a", "description_html": "C++ dev"}, {"external_id": "b", "description_html": "C# and .NET"}, {"external_id": "c", "description_html": "knet"}], desired=["C++", "C#", ".NET"])
    assert {k: r.desired_tech_hits for k, r in got.items()} == {"a": 1, "b": 2, "c": 0}


def test_many_terms_equal_few(spark):
    terms = [f"t{i}" for i in range(MOST_NATIVE + 5)] + ["c++", "++", "a b", "x_y"]
    df = spark.createDataFrame([("T3 c++ a b",), ("t31",), ("x_y ++",), (None,), ("",), ("at3_t4",)], "text string")
    some = [t for t in terms if t in ("t3", "t4", "t31", "c++", "++", "a b", "x_y")]
    got = df.select(matched_terms(F.col("text"), terms).alias("a"), matched_terms(F.col("text"), some).alias("b"), any_word(F.col("text"), terms).alias("c")).collect()
    assert [r.a for r in got] == [r.b for r in got] and [r.c for r in got] == [bool(r.b) for r in got] and got[3].a == []


def test_plain_words_are_looked_up(spark):
    """Plain words need no pattern each, and the terms found are those of the patterns."""
    terms = [f"t{i}" for i in range(30)] + ["c++", "AB", "a b", "é"]
    df = spark.createDataFrame([("T3 c++ a b",), ("t31 ét4é ab",), ("x_t3-t3.T7",), (None,), ("",), ("at3_t4 t2",)], "text string")
    both = df.select(matched_terms(F.col("text"), terms).alias("a"), F.array_compact(F.array(*[F.when(has_word(F.lower("text"), t), F.lit(t)) for t in sorted(terms)])).alias("b"))
    assert [r.a for r in both.collect()] == [r.b for r in both.collect()]
    assert df.select(matched_terms(F.col("text"), terms).alias("a"))._jdf.queryExecution().analyzed().toString().count("RLIKE") <= 4


def test_gold(spark):
    rows = [{"external_id": k, "posted_or_updated_at": p, "description_html": k} for k, p in (("a", at(1)), ("b", at(3)), ("c", None), ("d", at(3)))] + [{"external_id": "gone", "ingested_at": at(1)}]
    df = postings.silver(raw(spark, rows), **RULES)
    hashes = {r.external_id: r.content_hash for r in df.collect()}
    scored = spark.createDataFrame([(hashes["a"], 7), (hashes["b"], 5), (hashes["c"], 0)], "content_hash string, fit_score long")
    got = {r.external_id: r for r in postings.gold(df, scored).collect()}
    assert {k: r.fit_score for k, r in got.items()} == {"a": None, "b": 5, "c": None, "d": None}
    assert sorted(r.recency_rank for r in got.values()) == [1, 2, 3, 4] and got["a"].recency_rank == 3 and got["c"].recency_rank == 4
    first = min(("b", "d"), key=lambda k: got[k].job_key)
    assert got[first].recency_rank == 1


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_global_row_number(spark, parts):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"))
    got = global_row_number(df, [F.col("x").desc()], "n", parts).collect()
    assert sorted((r.n, r.x) for r in got) == [(i + 1, 499 - i) for i in range(500)]


def test_global_row_number_wide(spark):
    """Columns beyond the order must not part the counts from the rows."""
    rows, before = 200_000, spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(rows).select((F.col("id") * 7919 % rows).alias("x"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        got = global_row_number(df, [F.col("x")], "n").filter("wide is not null").agg(F.count("*"), F.count_if(F.col("n") == F.col("x") + 1)).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tuple(got) == (rows, rows)


def test_top_per_group(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    got = top_per_group(df, ["k"], [F.col("id").desc()], 4).collect()
    assert sorted((r.k, r.id) for r in got) == sorted((k, 299 - (2 - k) - 3 * j) for k in range(3) for j in range(4))
