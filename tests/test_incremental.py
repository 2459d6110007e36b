"""Late materialisation, tables in buckets, and streams that are stopped half way."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from postboard.operators import delivery, enrich, postings
from postboard.sources import compaction
from postboard.sources import landing as land
from postboard.sources import versioned
from postboard.streaming import incremental

T0 = dt.datetime(2026, 7, 2, 10)
RAW = "source string, company string, external_id string, title string, location string, url string, description_html string, ingested_at timestamp, posted_or_updated_at timestamp"


def landed(n, seed, keys=40):
    r = random.Random(seed)
    stamp = lambda: r.choice([None, T0 + dt.timedelta(days=r.randrange(4))])
    return [(r.choice("st"), r.choice(["c", None]), str(r.randrange(keys)), r.choice(["x", "y", None]), "Remote", r.choice(["u", None]), r.choice(["d", "e"]), T0 + dt.timedelta(days=r.randrange(5)), stamp()) for _ in range(n)]


def plain_lifecycle(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[:3], []).append(r)
    key = lambda x: (x is not None, x)
    return sorted(((*max(g, key=lambda r: (r[7], key(r[8]), key(r[3]), key(r[5])))[:6], min(r[7] for r in g), max(r[7] for r in g)) for g in groups.values()), key=str)


@pytest.mark.parametrize("most_sent", [None, 0])
def test_lifecycle_by_pointers(spark, most_sent):
    """Whether pointers are broadcast or go through the bitmap and a join."""
    rows = landed(600, 3)
    df = postings.keyed(spark.createDataFrame(rows, RAW))
    got = postings.newest_rows(df, postings.pointers(df), most_sent)
    names = ["source", "company", "external_id", "title", "location", "url", "first_seen_at", "last_seen_at"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == plain_lifecycle(rows)
    assert postings.newest_rows(df.limit(0), postings.pointers(df.limit(0)), most_sent).count() == 0


def test_lifecycle_plan(spark, tmp_path):
    """The history is aggregated by hash over narrow columns, and bodies are not shuffled before the newest rows are known."""
    spark.createDataFrame(landed(50, 1), RAW).write.parquet(str(tmp_path / "landing"))
    df = postings.keyed(spark.read.parquet(str(tmp_path / "landing")))
    narrow = postings.pointers(df)._jdf.queryExecution().executedPlan().toString()
    whole = postings.lifecycle(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in narrow + whole and "description_html" not in narrow
    assert whole.count("Scan parquet") <= 2 and "BroadcastHashJoin" in whole


def test_texts_to_match_are_not_broadcast(spark):
    """Whole texts are longer than Spark's estimate of a narrow projection."""
    from postboard.plans import tables_io

    lit = lambda **c: spark.range(1).select(*[F.concat(F.lit(v), F.col("id").cast("string")).alias(k) for k, v in c.items()])
    silver, extracted = lit(content_hash="h", title="t", clean_text="a text", location="Remote"), lit(content_hash="h", geo_restriction="canada_ok")
    df = tables_io.relevant(extracted, silver)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString() and [r.relevant_text for r in df.collect()] == ["a text0"]


def test_bitmap_loses_nothing(spark):
    wanted = spark.range(0, 4000, 2).withColumnRenamed("id", "k")
    got = {r.k for r in postings.maybe_there(spark.range(40_000).withColumnRenamed("id", "k"), wanted, 2000, "k").collect()}
    assert {*range(0, 4000, 2)} <= got and len(got) < 2000 + 0.1 * 38_000


def files(path, pattern="data/*/*/*.parquet"):
    return {str(p): p.stat().st_size for p in Path(path).glob(pattern)}


def test_upsert_touches_few_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(1000).select(F.col("id").cast("string").alias("content_hash"), F.lit("a").alias("x"))
    first = enrich.upsert_table(path, old, buckets=32)
    before = files(path)
    pinned = versioned.read(spark, path, first)
    second = enrich.upsert_table(path, spark.createDataFrame([("7", "b", 1), ("new", "b", 2)], "content_hash string, x string, y int"))
    assert len(files(path)) - len(before) <= 2 and before.items() <= files(path).items()
    assert pinned.count() == 1000 and pinned.columns == ["content_hash", "x"]
    rows = {r.content_hash: (r.x, r.y) for r in versioned.read(spark, path, second).collect()}
    assert len(rows) == 1001 and rows["7"] == ("b", 1) and rows["new"] == ("b", 2) and rows["8"] == ("a", None)
    third = enrich.upsert_table(path, spark.createDataFrame([], "content_hash string, x string"))
    assert {r.content_hash: (r.x, r.y) for r in versioned.read(spark, path, third).collect()} == rows
    assert versioned.expire(spark, path, keep=2) == 1 and versioned.numbers(spark, path) == [1, 2]  # the write of no rows is named by none
    assert versioned.expire(spark, path, keep=1) == 0 and versioned.read(spark, path, versioned.load(spark, path)).count() == 1001


def test_killed_between_writes(spark, tmp_path, monkeypatch):
    """The files are written, the manifest is not: readers see the version before, and the next writer goes on from it."""
    path, rows = str(tmp_path / "t"), lambda x: spark.createDataFrame([("a", x), ("b", x)], "content_hash string, x int")
    enrich.upsert_table(path, rows(1), buckets=4)
    with monkeypatch.context() as m:
        m.setattr(versioned, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            enrich.upsert_table(path, rows(2))
    now = versioned.load(spark, path)
    assert now.number == 0 and {r.x for r in versioned.read(spark, path, now).collect()} == {1}
    with pytest.raises(Exception, match="(?i)exist"):  # a number is given once
        versioned.publish(spark, path, now)
    enrich.upsert_table(path, rows(3))
    assert {r.x for r in versioned.read(spark, path, versioned.load(spark, path)).collect()} == {3}
    assert versioned.expire(spark, path, keep=1) == 2  # what the killed writer left, and the first version's


def test_state_rewrites_touched_buckets(spark, tmp_path):
    schema, source, state = _parse_datatype_string(RAW), str(tmp_path / "in"), str(tmp_path / "state")
    run = lambda: incremental.stream_lifecycle(spark, source, state, str(tmp_path / "cp"), schema, buckets=64).awaitTermination()
    rows = landed(3000, 5, keys=2000)
    spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
    run()
    before = files(state)
    one = rows[0][:7] + (T0 + dt.timedelta(days=30), None)
    spark.createDataFrame([one], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    new = {k: v for k, v in files(state).items() if k not in before}
    assert len(new) == 1 and sum(new.values()) < 0.1 * sum(before.values())
    whole = incremental.partial_state(spark.read.schema(schema).parquet(source))
    assert sorted(map(str, incremental.state_of(spark, state).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_state_moves_few_bodies(spark):
    """Of a state and a batch, about one body per posting goes into the shuffle, and the rows are those of merged states."""
    old, new = (postings.keyed(spark.createDataFrame(landed(3000, k, keys=1000), RAW)) for k in (6, 7))
    state = postings.lifecycle(old)
    span = incremental.spans(state, new)
    moved = incremental.bodies(state, new, span, span.count())
    n = span.count()
    assert n > 1500 and n <= moved.count() < 1.5 * n
    rows = moved.withColumn("_body", F.lit(True)).unionByName(span.drop("old", "new").withColumn("_body", F.lit(False)), allowMissingColumns=True)
    got = incremental.newest_states(rows.withColumn("bucket", F.lit(0)))
    whole = postings.lifecycle(old.unionByName(new))
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_landed_copies_are_small(spark, tmp_path):
    """Bodies that are landed again take little room, however far apart: snappy would keep each of them."""
    from postboard.plans import tables_io

    r = random.Random(1)
    bodies = ["".join(r.choice("abcdefgh") for _ in range(100_000)) for _ in range(4)]
    tables_io.write_landed(spark.createDataFrame([(i, bodies[i % 4] + str(i)) for i in range(40)], "i int, body string").coalesce(1), str(tmp_path / "x"))
    assert sum(p.stat().st_size for p in (tmp_path / "x").glob("*.parquet")) < 0.2 * 4_000_000


def test_state_batch_again(spark, tmp_path):
    """Stopped after its version was published, before the stream knew: the batch comes again and changes nothing."""
    schema, source, state = _parse_datatype_string(RAW), str(tmp_path / "in"), str(tmp_path / "state")
    run = lambda: incremental.stream_lifecycle(spark, source, state, str(tmp_path / "cp"), schema, buckets=4).awaitTermination()
    for k in range(2):
        spark.createDataFrame(landed(50, k), schema).write.mode("append").parquet(source)
        run()
    (tmp_path / "cp/commits/1").unlink()
    (tmp_path / "cp/commits/.1.crc").unlink(missing_ok=True)
    before = sorted(map(str, incremental.state_of(spark, state).collect()))
    run()
    assert versioned.load(spark, state).number == 1 and sorted(map(str, incremental.state_of(spark, state).collect())) == before


def test_net_new_stream(spark, tmp_path):
    schema, source, out = _parse_datatype_string(RAW), str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: incremental.stream_net_new(spark, source, out, str(tmp_path / "cp"), schema, files_each=1).awaitTermination()
    batches, known = [landed(60, k) for k in range(3)], set()
    for rows in [*batches, batches[0]]:  # the last file comes twice
        df = spark.createDataFrame(rows, schema)
        fresh = {r[:3] for r in rows} - known
        before = spark.read.parquet(out) if known else spark.createDataFrame([], "job_key string")
        assert incremental.net_new(df, before).count() == len(fresh)
        known |= fresh
        df.coalesce(1).write.mode("append").parquet(source)
        run()
        got = [(r.source, r.company, r.external_id) for r in spark.read.parquet(out).collect()]
        assert len(got) == len(known) and {*got} == known


GOLD = "job_key string, title string, company string, location string, url string, fit_score long, match_score long, posted_or_updated_at timestamp, first_seen_at timestamp, similarity double, desired_tech_hits long, title_match boolean, deal_breaker_terms string, company_type string, geo_restriction string, manages_people string, best_match_source string"


def gold(spark, hours):
    return spark.createDataFrame([(k, k, "c", None, "u", None, 1, None, T0 - dt.timedelta(hours=h), None, 0, False, None, None, None, None, None) for k, h in hours.items()], GOLD)


@pytest.mark.parametrize("fails_at", ["send", "ledger"])
def test_delivery_again(spark, tmp_path, monkeypatch, fails_at):
    """A failure before or after sending: the same rows go under the same number, though gold has changed; then all goes on."""
    box, ledger, sent = str(tmp_path / "box"), str(tmp_path / "ledger"), []
    now = F.lit(T0)

    def send(n, rows):
        if fails_at == "send" and n == 1 and "failed" not in sent:
            sent.append("failed")
            raise OSError
        sent.append((n, sorted(r.job_key for r in rows.collect())))

    run = lambda n, df: delivery.deliver(df, box, ledger, n, send, now)
    run(0, gold(spark, {"a": 20, "old": 40}))
    with monkeypatch.context() as m:
        if fails_at == "ledger":
            m.setattr(delivery, "next_watermark", lambda *_: (_ for _ in ()).throw(OSError))
        with pytest.raises(OSError):
            run(1, gold(spark, {"a": 20, "b": 10}))
    run(1, gold(spark, {"a": 20, "b": 10, "c": 9}))
    run(1, gold(spark, {"a": 20, "b": 10, "c": 9}))  # known to the ledger
    run(2, gold(spark, {"a": 20, "b": 10, "c": 9}))
    run(3, gold(spark, {"a": 20, "b": 10, "c": 9}))  # nothing new
    run(4, gold(spark, {"c": 9, "d": 1}))
    assert [s for s in dict.fromkeys(map(str, sent)) if s != "failed"] == [str(x) for x in [(0, ["a"]), (1, ["b"]), (2, ["c"]), (3, []), (4, ["d"])]]
    rows = land.read_or_empty(spark, ledger, delivery.LEDGER).orderBy("batch").collect()
    assert [(r.batch, r.postings_sent, r.watermark) for r in rows] == [(n, 1, T0 - dt.timedelta(hours=h)) for n, h in ((0, 20), (1, 10), (2, 9), (4, 1))]


def test_compaction(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "landing")
    day = lambda k: dt.datetime(2026, 7, 1 + k, 6)
    posting = lambda k: spark.createDataFrame([(s, "c", f"{k}-{i}", "t", None, None, None, None, "u", "d" * 50, None, "{}") for s in ("a b", "é", None) for i in range(3)], land.POSTING).coalesce(1)
    for k in range(8):
        land.land(posting(k), path, f"r{k}", day(0 if k < 4 else 5))
    landed_files = lambda: {str(p) for p in Path(path).glob("source=*/*/*.parquet")}
    rows = lambda df: sorted(map(str, df.select(*land.RAW_COLUMNS, "ingest_date").collect()))
    before, early = rows(compaction.read(spark, path)), compaction.read(spark, path)
    assert len(landed_files()) == 24 and len(before) == 72
    with monkeypatch.context() as m:  # stopped before the manifest: nothing has happened
        m.setattr(versioned, "put_once", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, path)
    assert rows(compaction.read(spark, path)) == before
    put = versioned.put_once

    def while_landing(*a):
        land.land(posting(9), path, "r9", day(5))  # somebody lands before the manifest is there
        put(*a)

    with monkeypatch.context() as m:
        m.setattr(versioned, "put_once", while_landing)
        assert compaction.compact(spark, path) == 24
    after = rows(compaction.read(spark, path))
    assert len(after) == 81 and {*before} < {*after} and rows(early) == before
    large = [p for a in compaction.manifest(spark, path)[1] for p in Path(f"{path}/_compacted/{a}").glob("source=*/*/*.parquet")]
    assert len(large) == 6  # a file per source and day
    assert compaction.compact(spark, path) == 0  # one small file a partition is left
    assert compaction.vacuum(spark, path) == 24 and rows(compaction.read(spark, path)) == after and len(landed_files()) == 3
    assert compaction.expire(spark, path, 3) == 3 and len(compaction.read(spark, path).collect()) == 45


def test_bins(spark):
    sizes = [60, 30, 30, 20, 10, 5, 49, 48]
    listed = spark.createDataFrame([("s", "d", f"f{i}", n) for i, n in enumerate(sizes)] + [("s", "e", "alone", 1)], "source string, ingest_date string, file string, bytes long")
    got = {}
    for r in compaction.bins(listed, 100).collect():
        got.setdefault(r.bin, []).append(r.bytes)
    assert sorted(map(sorted, got.values())) == [[5, 10, 20, 30], [30, 48, 49]]  # each begins below a multiple of 100
