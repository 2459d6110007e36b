"""Sources, delivery, monitoring, evaluation, companies, corpus, checks and incremental forms on small rows."""

import datetime as dt
import html
import json
import math
import random
import time
from html.entities import html5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postboard.functions import text as tx
from postboard.functions import web
from postboard.operators import companies, corpus, delivery, enrich, evaluation, matching, monitoring, quality
from postboard.plans import tables_io
from postboard.sources import config_tables, feeds, payload_files
from postboard.sources import landing as land
from postboard.sources import versioned
from postboard.streaming import incremental
from postboard.tables import shared_dir

T0 = dt.datetime(2026, 7, 2, 10)


def payloads(spark, *boards):
    return spark.createDataFrame([(b, p if isinstance(p, str) else json.dumps(p)) for b, p in boards], "board_ref string, payload string")


def test_feed_escaped_body_and_quarantine(spark):
    job = {"id": 1, "title": "T", "absolute_url": "u", "content": "&lt;p&gt;a &amp;amp; b&lt;/p&gt;", "updated_at": "2026-07-01T00:00:00-04:00", "location": {"name": "X"}}
    good, bad = feeds.shape_a(payloads(spark, ("a", {"jobs": [job]}), ("b", {"x": 1}), ("c", {"jobs": [{"id": 2}]}), ("d", "not json"), ("e", {"jobs": []}), ("f", {"jobs": {"id": 1}})))
    row = good.collect()
    assert len(row) == 1 and row[0].description_html == "<p>a &amp; b</p>" and row[0].external_id == "1" and json.loads(row[0].raw)["id"] == 1
    assert row[0].posted_or_updated_at == dt.datetime(2026, 7, 1, 4)
    assert {r.board_ref for r in bad.collect()} == {"b", "c", "d", "f"}


def test_feed_empty_sections(spark):
    """An empty section has no line; the first has one if that is asked for, and if it is there."""
    jobs = [{"id": i, "text": "T", "hostedUrl": "u", "description": d, "lists": [], "additional": "end"} for i, d in enumerate(("", None, "x"))]
    for keep, want in ((False, ["end", "end", "x\nend"]), (True, ["\nend", "end", "x\nend"])):
        good, _ = feeds.shape_b(payloads(spark, ("b", jobs)), keep_first=keep)
        assert [r.description_html for r in good.orderBy("external_id").collect()] == want


def test_feed_empty_headed_section(spark):
    """The header of an empty section goes with it, unless the first section is kept."""
    texts = ("", None, "x")
    details = [("i", {"id": str(n), "postingUrl": "u", "jobAd": {"sections": {"jobDescription": {"title": "Job", "text": t}, "qualifications": {"text": "q"}, "additionalInformation": {"title": "More", "text": ""}}}}) for n, t in enumerate(texts)]
    for keep, want in ((False, ["q", "q", "<h3>Job</h3>x\nq"]), (True, ["<h3>Job</h3>\nq", "q", "<h3>Job</h3>x\nq"])):
        good, _ = feeds.shape_i(payloads(spark, ("i", {"content": [{"id": str(n), "name": "N"} for n in range(3)]})), payloads(spark, *details), keep_first=keep)
        assert [r.description_html for r in good.orderBy("external_id").collect()] == want


def test_feed_places(spark):
    jobs = [{"uuid": u, "name": "N", "url": "x", "workLocation": {"label": p}} for u, p in (("1", "A"), ("2", "B"), ("1", "C"), ("1", "A"))]
    details = [("h", {"uuid": "1", "description": {"company": "no", "role": "yes"}, "createdOn": "2026-07-01T10:00:00-07:00"}), ("h", {"uuid": "2", "description": {"role": "r"}, "workLocations": ["Z"]})]
    good, _ = feeds.shape_h(payloads(spark, ("h", jobs)), payloads(spark, *details))
    got = {r.external_id: r for r in good.collect()}
    assert got["1"].location == "A; C" and got["1"].description_html == "yes" and got["2"].location == "Z"


def test_feed_details_to_quarantine(spark):
    """What is listed is a posting or in quarantine."""
    jobs = [{"uuid": u, "name": "N", "url": "x", "workLocation": {"label": "A"}} for u in ("1", "2", "3")]
    details = [("h", {"uuid": "1", "description": {"role": "yes"}}), ("h", '{"uuid": "2", '), ("other", {"uuid": "3", "description": {"role": "no"}})]
    good, bad = feeds.shape_h(payloads(spark, ("h", jobs), ("none", {"x": 1})), payloads(spark, *details))
    assert [r.external_id for r in good.collect()] == ["1"]
    assert sorted(map(tuple, bad.collect())) == [("h", "no readable detail: 2"), ("h", "no readable detail: 3"), ("none", "no list at the root")]


def test_retention(spark, tmp_path):
    path = str(tmp_path / "raw")
    good, _ = feeds.shape_c(payloads(spark, ("c", {"jobs": [{"id": "1", "title": "T", "jobUrl": "u"}]})), source="a b=c")
    for k in (0, 3, 9, 10):
        land.land(good, path, f"r{k}", T0 + dt.timedelta(days=k))
    rows = spark.read.option("basePath", path).parquet(path)
    assert land.within_retention(rows, F.col("ingest_date"), 7).count() == 3
    assert land.expire(spark, path, 7) == 1 and land.expire(spark, path, 7) == 0
    assert {r.run_id for r in land.read_or_empty(spark, path, land.RAW).collect()} == {"r3", "r9", "r10"}


def test_reads_fail_loudly(spark, tmp_path):
    (tmp_path / "x").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        land.read_or_empty(spark, str(tmp_path / "x"), land.RAW).collect()
    assert land.read_or_empty(spark, str(tmp_path / "none"), land.RAW).count() == 0


def test_todo_takes_any_model_name(spark):
    work = spark.createDataFrame([("h",)], "content_hash string")
    done = spark.createDataFrame([("h", "it's"), ("h", None)], "content_hash string, extract_model string")
    assert enrich.todo(work, done, extract_model="it's").count() == 0 and enrich.todo(work, done, extract_model="' or 1=1 --").count() == 1


def test_time_forms(spark):
    df = spark.createDataFrame([("2026-07-22 14:20:52 UTC",), ("2026-07-22",), ("2026-07-22T10:00:00Z",), ("",), (None,), ("soon",)], "s string")
    got = [r[0] for r in df.select(tx.parse_timestamp(F.col("s"))).collect()]
    assert got == [dt.datetime(2026, 7, 22, 14, 20, 52), dt.datetime(2026, 7, 22), dt.datetime(2026, 7, 22, 10), None, None, None]


def test_landing(spark, tmp_path):
    path = str(tmp_path / "raw")
    good, _ = feeds.shape_c(payloads(spark, ("c", {"jobs": [{"id": "1", "title": "T", "jobUrl": "u"}]})))
    assert land.land(good.limit(0), path, "r0", T0) == 0 and land.read_or_empty(spark, path, land.RAW).count() == 0
    assert land.land(good, path, "r1", T0) == 1 and land.land(good, path, "r2", T0 + dt.timedelta(days=1)) == 1
    rows = land.read_or_empty(spark, path, land.RAW)
    assert {f.dataType.simpleString() for f in rows.schema} == {"string"} and rows.count() == 2
    staged = land.stage_raw(rows)
    assert "raw" not in staged.columns and {r.ingested_at for r in staged.collect()} == {T0, T0 + dt.timedelta(days=1)}


def test_prompt_lands_once(spark):
    prompt = lambda v, p, t: spark.createDataFrame([(v, p, t)], land.SCORING_PROMPT)
    old = prompt("1", "p", T0)
    assert land.changed_prompt(old, prompt("1", "p", T0)).count() == 0 and land.changed_prompt(old, prompt("2", "p", T0)).count() == 1
    assert land.changed_prompt(old.limit(0), prompt("1", None, T0)).count() == 1 and land.changed_prompt(prompt(None, "p", T0), prompt(None, "p", T0)).count() == 0


def test_labels(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text("job_key,relevant\n# note\n\na,yes\nb,N\nc,\n,yes\n")
    assert {r.job_key: r.relevant for r in config_tables.read_labels(spark, str(path)).collect()} == {"a": True, "b": False}
    for bad in ([("a", "maybe")], [("a", "yes"), ("a", "yes")]):
        with pytest.raises(Exception, match="verdict|twice"):
            config_tables.parse_labels(spark.createDataFrame(bad, "job_key string, relevant string")).collect()


def test_rules_and_companies(spark, tmp_path):
    (tmp_path / "r.csv").write_text("tech,note\ndbt,x\n")
    assert config_tables.read_rules(spark, str(tmp_path / "r.csv"), "desired_tech").count() == 1
    with pytest.raises(ValueError, match="header"):
        config_tables.read_rules(spark, str(tmp_path / "r.csv"), "desired_titles")
    (tmp_path / "c.csv").write_text("company_name,source,board_ref,active,tier,website,notes\n A ,ashby,a b,true,,,\nB,x,r,,2,w,n\n")
    got = config_tables.read_companies(spark, str(tmp_path / "c.csv"))
    assert [tuple(r) for r in got.orderBy("company_name").collect()] == [("A", "ashby", "a b", True, 1, "", ""), ("B", "x", "r", False, 2, "w", "n")]
    config_tables.write_projection(got, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 1


def ledger(spark, runs):
    return spark.createDataFrame([(f"r{i}", "s", 1, n, status, T0, T0 + dt.timedelta(hours=i), None) for i, (n, status) in enumerate(runs)], land.INGEST_RUNS)


@pytest.mark.parametrize(("prior", "now", "drop"), [([(10, "ok")] * 6, 1, 10), ([(10, "ok")] * 2, 1, None), ([(10, "ok")] * 5 + [(0, "error")] * 9, 1, 10), ([(1, "ok")] * 6, 1, None), ([(3, "ok"), (4, "ok")] * 3, 1, 3)])
def test_volume_drop(spark, prior, now, drop):
    current = spark.createDataFrame([("s", now, "ok")], "source string, rows_fetched long, status string")
    assert [r.baseline for r in monitoring.volume_drops(current, ledger(spark, prior)).collect()] == ([drop] if drop else [])


def test_run_rollup(spark):
    boards = spark.createDataFrame([("a", "x", 5, False), ("a", "y", None, True), ("b", "z", None, True), ("c", "w", 0, False)], "source string, company string, rows long, failed boolean")
    df = monitoring.run_rollup(boards)
    got = {r.source: r for r in df.collect()}
    assert got["a"].status == "ok" and got["a"].error == "skipped: y" and got["b"].status == "error" and got["a"].rows_fetched == 5
    assert [r.source for r in monitoring.low_volume(df).collect()] == ["c"] and monitoring.run_summary(df).first().board_count == 4


def test_delivery(spark):
    gold = "job_key string, fit_score long, match_score long, posted_or_updated_at timestamp, first_seen_at timestamp, similarity double, desired_tech_hits long, title_match boolean, deal_breaker_terms string, company_type string, geo_restriction string, manages_people string, best_match_source string"
    rows = [("a", 4, 11, T0, T0, 0.825, 9, True, "Kafka", "B2B", "us_only", "yes", "lead"), ("b", None, 99, T0, T0, None, 0, False, None, None, "canada_ok", "no", None), ("c", 5, 1, None, T0 - dt.timedelta(days=2), None, 0, None, None, None, "unclear", None, None)]
    df = spark.createDataFrame(rows, gold)
    lines = {r.job_key: r.line for r in df.select("job_key", delivery.signal_line().alias("line")).collect()}
    assert lines["a"] == "match 11 — LLM 4/5, vectors 82% — tech hits: 9, title match, mentions Kafka, B2B, text says US only, manages people, like: lead"
    assert lines["b"] == "match 99 — unscored — tech hits: 0" and lines["c"] == "match 1 — LLM 5/5 — tech hits: 0, eligibility unstated"
    assert [r.job_key for r in delivery.delivery_order(df).collect()] == ["c", "a", "b"]
    empty = spark.createDataFrame([], land.DIGEST_RUNS)
    new = delivery.new_since(df, delivery.watermark(empty, F.lit(T0 + dt.timedelta(hours=1))))
    assert {r.job_key for r in new.collect()} == {"a", "b"}
    sent = delivery.next_watermark(new, F.lit(T0))
    assert sent.first().watermark == T0 and delivery.new_since(df, delivery.watermark(sent, F.lit(T0))).count() == 0 and delivery.next_watermark(new.limit(0), F.lit(T0)).count() == 0


def test_precision(spark):
    gold = spark.createDataFrame([(f"k{i}", None if i > 9 else 12 - i, i) for i in range(12)], "job_key string, fit_score long, match_score long")
    labels = spark.createDataFrame([(f"k{i}", i in (0, 1, 7)) for i in range(12)], "job_key string, relevant boolean")
    df = evaluation.precision_at(evaluation.labelled_scores(gold, labels, ["fit_score", "match_score"]))
    got = {(r.ranking, r.k): r.precision for r in df.collect()}
    assert got["fit_score", 5] == 0.4 and got["fit_score", 20] is None and got["match_score", 5] == 0.2
    assert evaluation.verdict(df, "fit_score", "match_score").first().verdict == "fit_score"
    assert evaluation.verdict(df.filter("k = 20"), "fit_score", "match_score").first().verdict == "no verdict"


def test_enrichment_second_run_is_empty(spark):
    silver = spark.createDataFrame([("h1", "t", "text", "A"), ("h1", "t", "text", "B"), ("h2", "t", "more", None)], "content_hash string, title string, clean_text string, location string")
    work = {r.content_hash: r.locations for r in enrich.to_extract(silver, enrich.empty(spark, enrich.EXTRACTED), "m").collect()}
    assert work == {"h1": "A | B", "h2": None}
    done = enrich.empty(spark, enrich.EXTRACTED).unionByName(spark.createDataFrame([("h1", True, "m"), ("h2", False, "m")], "content_hash string, extract_ok boolean, extract_model string"), allowMissingColumns=True)
    assert [r.content_hash for r in enrich.to_extract(silver, done, "m").collect()] == ["h2"] and enrich.to_extract(silver, done, "m2").count() == 2
    assert enrich.to_score(done, enrich.empty(spark, enrich.SCORED), spark.createDataFrame([], land.SCORING_PROMPT), "m").count() == 0


def test_best_match_without_length(spark):
    vectors = [("a", [1.0, 0.0]), ("z", [0.0, 0.0]), ("n", None), ("m", [1.0, None]), ("long", [1.0, 0.0, 0.0])]
    texts = spark.createDataFrame(vectors, "content_hash string, embedding array<float>")
    units = spark.createDataFrame([(2, [2.0, 0.0]), (1, [1.0, 0.0]), (0, [0.0, 0.0]), (3, None), (4, [None, 1.0])], "unit_id int, embedding array<float>")
    got = {r.content_hash: (r.unit_id, r.similarity) for r in enrich.best_match(texts, units).collect()}
    assert got == {"a": (1, 1.0), "z": (None, None), "n": (None, None), "m": (None, None), "long": (None, None)}
    assert enrich.best_match(texts, units.limit(0)).filter("unit_id is not null").count() == 0 and enrich.best_match(texts.limit(0), units).count() == 0


@pytest.mark.parametrize("sizes", [{"block": 3, "grouped": 5}, {"block": 2048, "grouped": 65_536}, {"block": 4, "pivots": 7}, {"pivots": 40}, {"block": 2, "grouped": 9, "pivots": 3}])
def test_best_match_tiles(spark, sizes):
    rng = random.Random(3)
    draw = lambda n, kind: [(kind(i), [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(n)]
    texts, units = draw(40, str), draw(23, int)
    plain = {}
    for h, v in texts:
        cos = lambda w, v=v: round(sum(a * b for a, b in zip(v, w, strict=True)) / (math.hypot(*v) * math.hypot(*w)), 12)
        near = sorted((-cos(w), u) for u, w in units if any(w)) if any(v) else []
        plain[h] = near[0][1] if near else None
    got = enrich.best_match(spark.createDataFrame(texts, "content_hash string, embedding array<double>"), spark.createDataFrame(units, "unit_id long, embedding array<double>"), **sizes)
    assert {r.content_hash: r.unit_id for r in got.collect()} == plain


def test_best_match_skips(spark):
    """On vectors that lie in bunches, most groups of units are never compared, and the nearest units are the same."""
    rng = random.Random(5)
    middles = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    draw = lambda n, kind: [(kind(i), [x + rng.gauss(0, 0.05) for x in rng.choice(middles)]) for i in range(n)]
    texts, units = spark.createDataFrame(draw(300, str), "content_hash string, embedding array<double>"), spark.createDataFrame(draw(900, int), "unit_id long, embedding array<double>")
    compared = lambda k: enrich.tiles(texts, units, pivots=k).agg(F.sum(F.size("hashes").cast("long") * F.size("units"))).first()[0]
    assert compared(1) == 300 * 900 and compared(40) < 0.25 * 300 * 900
    rows = lambda k: sorted(map(tuple, enrich.best_match(texts, units, pivots=k).collect()))
    assert rows(1) == rows(40)


def test_best_match_broadcasts_no_vectors(spark):
    """However few bytes the blocks have in their files: each text is there once per group of units that it meets."""
    v = spark.range(50).select(F.col("id").alias("unit_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    plan = enrich.tiles(v.withColumnRenamed("unit_id", "content_hash"), v)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_merge(spark):
    cols = "company_name string, source string, board_ref string, active boolean, tier int, website string, notes string"
    master = spark.createDataFrame([("Acme  Inc", "a", "acme", True, 1, "", "n"), ("Solo", "a", "solo", True, 1, "w", "")], cols)
    new = spark.createDataFrame([("acme inc", "b", "x", False, 2, "site", "m", 0), ("New", "b", "n1", False, 2, "", "", 1), ("new", "b", "n2", True, 1, "later", "", 2)], cols + ", pos int")
    got = {r.company_name: r for r in companies.merge(master, new).collect()}
    assert set(got) == {"Acme  Inc", "Solo", "New"}
    acme, fresh = got["Acme  Inc"], got["New"]
    assert (acme.board_ref, acme.website, acme.notes, acme.filled, acme.conflict) == ("acme", "site", "n", True, True)
    assert (fresh.board_ref, fresh.website, fresh.added) == ("n1", "later", True)


def test_board_names(spark):
    names = ["ok", "a b", "a  b", "jobs", "x\n", "-x", ""]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    ok = lambda s: [r[0] for r in df.select(web.ref_ok(F.lit(s), F.col("t"))).collect()]
    assert ok("greenhouse") == [True, False, False, False, False, False, False] and ok("ashby") == [True, True, False, False, False, False, False]
    urls = spark.createDataFrame([("https://jobs.ashbyhq.com/Some%20Board/1",), ("https://a+b.bamboohr.com/%zz",), (None,), ("https://x.com",)], "u string")
    got = [r.p for r in urls.select(web.platform_of(F.col("u")).alias("p")).collect()]
    assert tuple(got[0]) == ("Ashby", "some board") and tuple(got[1]) == ("BambooHR", "b") and got[2] is None and got[3] is None


def test_corpus_and_prompt(spark):
    row = [("me", "sum", "senior", [], [("Lang", ["a", "b"])], [("Org", "Dev", "2020", [("did x", ["data"]), ("did y", [])])], [("P", "made p", ["data", "ml"])], ["BSc"])]
    df = spark.createDataFrame(row, "who string, " + corpus.CORPUS)
    units = corpus.evidence_units(df, "who")
    assert [r.unit_id for r in units.orderBy("seq").collect()] == ["Org:2020:0", "Org:2020:1", "project:P"]
    assert {r.family: r.n for r in corpus.coverage(units, ["data", "ml", "ops"]).collect()} == {"data": 2, "ml": 1, "ops": 0}
    text = corpus.render_prompt(df, units, "who", "R").first().prompt
    assert "- (none stated)" in text and text.index("- [Dev at Org (2020)] did x") < text.index("did y") < text.index("made p") and text.endswith("Education:\n- BSc\n")


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "x string, y int")
    assert {r["column"]: r.failures for r in quality.not_null(df, ["x", "y"]).collect()} == {"x": 1, "y": 1}
    assert quality.unique(df, "x").first().failures == 1 and quality.accepted_values(df, "x", ["b"]).first().failures == 1
    assert quality.require_contract(df, "y int, x string") is df
    with pytest.raises(ValueError, match="contract"):
        quality.require_contract(df, "x string, y long")


RAW = "source string, company string, external_id string, title string, location string, url string, description_html string, ingested_at timestamp, posted_or_updated_at timestamp"


def test_stream_state_is_not_forgotten(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema, source = _parse_datatype_string(RAW), str(tmp_path / "in")
    row = lambda k: spark.createDataFrame([("s", "c", str(k), "t", None, "u", "d", T0, None)], schema)
    run = lambda: incremental.stream_lifecycle(spark, source, str(tmp_path / "state"), str(tmp_path / "cp"), schema).awaitTermination()
    row(0).write.mode("append").parquet(source)
    run()
    land.remove(spark, str(tmp_path / "state/manifests"))
    row(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="batch 1 was to follow"):
        run()


def test_streams(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(RAW)
    rows = [("s", "c", str(i % 7), f"t{i}", None, "u", "d", T0 + dt.timedelta(days=i * 5 % 9), None) for i in range(40)]
    source = str(tmp_path / "in")
    for k in range(4):
        spark.createDataFrame(rows[k::4], schema).coalesce(1).write.mode("append").parquet(source)
    incremental.stream_lifecycle(spark, source, str(tmp_path / "state"), str(tmp_path / "cp"), schema, files_each=1).awaitTermination()
    assert versioned.numbers(spark, str(tmp_path / "state")) == [2, 3]
    state = incremental.state_of(spark, str(tmp_path / "state"))
    whole = incremental.partial_state(spark.read.schema(schema).parquet(source))
    key = lambda df: sorted(map(str, df.select(*whole.columns).collect()))
    assert key(state) == key(whole) and incremental.net_new(spark.createDataFrame([rows[0]], schema), state).count() == 0
    for _ in range(2):
        incremental.stream_landing(spark, source, str(tmp_path / "out"), str(tmp_path / "cp2"), schema).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_payload_files(spark, tmp_path):
    """Files of a few hundred bytes a split give what payloads in rows give, whatever stands in their strings."""
    rng, tricky = random.Random(1), ["}", '{"a":1}', '"', "\\", '\\"', '"jobs":[', "],", "}]", "é😀", "\n", ""]
    job = lambda i: {"id": i, "title": rng.choice(tricky) + "t", "absolute_url": "u", "content": "".join(rng.choice(tricky) for _ in range(rng.randint(0, 12))), "location": {"name": rng.choice(tricky)}}
    boards = {}
    for b in range(6):
        payload = {"meta": {"jobs": [1], "x": "}{"}, "jobs": [job(i) for i in range(rng.randint(0, 40))], "more": [{"z": {}}]}
        boards[f"b {b}"] = json.dumps(payload, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
    one = '{"id":1,"title":"a","absolute_url":"u"}'
    boards |= {"nolist": '{"x":1}', "not json": "not json", "cut": f'{{"jobs":[{one}', "cut 2": f'{{"jobs":[{one}]', "dict": '{"jobs":{"id":1}}', "lack": '{"jobs":[{"id":1}]}', "number": f'{{"jobs":[1,{one}]}}', "null": '{"jobs":null}'}
    boards |= {"empty": '{"jobs":[]}', "blank": " ", "nested": f'{{"a":{{"jobs":[{one}]}}}}', "spaces": f' {{ "jobs" : [ {one} , {one} ] }} \n', "list": "[]", "text": '{"jobs":["a","}"]}', "list of lists": f'{{"jobs":[[{one}]]}}'}
    for b, text in boards.items():
        (tmp_path / f"board_ref={b}").mkdir()
        (tmp_path / f"board_ref={b}/0.json").write_text(text)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    files = payload_files.PayloadFiles(spark, str(tmp_path))
    plain = lambda good: sorted((r.board_ref, r.pos, json.dumps(json.loads(r.raw), sort_keys=True), str(r.item)) for r in good.collect())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        good, bad = feeds.items(files, "A")
        want, want_bad = feeds.items(payloads(spark, *boards.items()), "A")
        assert plain(good) == plain(want) and sorted(map(tuple, bad.collect())) == sorted(map(tuple, want_bad.collect()))
        assert payload_files.pieces(files).groupBy("file").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).first()[0] > 5
        assert feeds.shape_a(files)[0].count() == good.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_payload_files_bare_list(spark, tmp_path):
    boards = {"a": '[{"id":"1","text":"]}","hostedUrl":"u","lists":[{"text":"x","content":"{"}]},{"id":"2","text":"t","hostedUrl":"u"}]', "b": '{"x":[{"id":1}]}', "c": "[]"}
    for b, text in boards.items():
        (tmp_path / f"board_ref={b}").mkdir()
        (tmp_path / f"board_ref={b}/0.json").write_text(text)
    good, bad = feeds.items(payload_files.PayloadFiles(spark, str(tmp_path)), "B")
    assert sorted((r.board_ref, r.pos, r.item.text) for r in good.collect()) == [("a", 0, "]}"), ("a", 1, "t")] and [r.board_ref for r in bad.collect()] == ["b"]


def test_payload_files_list_after_a_brace(spark, tmp_path):
    """A list that opens in a piece which begins inside of a string."""
    boards = {"a": '{"x":"}","jobs":[{"id":1,"title":"t","absolute_url":"u"}]}', "b": '{"x":"{}\\"}","jobs":[]}', "c": '{"x":"}","jobs":[1]}'}
    for b, text in boards.items():
        (tmp_path / f"board_ref={b}").mkdir()
        (tmp_path / f"board_ref={b}/0.json").write_text(text)
    good, bad = feeds.items(payload_files.PayloadFiles(spark, str(tmp_path)), "A")
    assert [(r.board_ref, r.pos, r.item.title) for r in good.collect()] == [("a", 0, "t")] and [r.board_ref for r in bad.collect()] == ["c"]


def test_packed_payloads(spark, tmp_path):
    """Many payloads a file, whole and broken ones side by side, give what payloads in rows give; no other payload suffers."""
    rng, tricky = random.Random(2), ["}", '{"a":1}', '"', "\\", '\\"', '"jobs":[', "],", "}]", "\x1e", "\x1eb\n", "é😀", "\n", ""]
    job = lambda i: {"id": i, "title": rng.choice(tricky) + "t", "absolute_url": "u", "content": "".join(rng.choice(tricky) for _ in range(rng.randint(0, 12)))}
    one = '{"id":1,"title":"a","absolute_url":"u"}'
    boards = [(f"b {i}", json.dumps({"meta": {"jobs": [1], "x": "}{"}, "jobs": [job(k) for k in range(rng.randint(0, 30))], "more": [{"z": {}}]}, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)) for i in range(20)]
    broken = ["", " ", None, "not json", '{"x":1}', f'{{"jobs":[{one}', f'{{"jobs":[{one}]', '{"jobs":[{"id":1}]}', f'{{"jobs":[1,{one}]}}', '{"jobs":null}', '{"jobs":[{"id":"', "}]}", "[[[{{{", '"', "x\x1ey", f'x\x1eb\n{{"jobs":[{one}]', '{"jobs":[]}', "[]", "\n"]
    boards += [(f"broken {i}", t) for i, t in enumerate(broken)] + [(n, f'{{"jobs":[{one}]}}') for n in ["}\x1e", "a\nb", "é %2F+/=", None, "twice", "twice"]]
    rng.shuffle(boards)
    df = spark.createDataFrame(boards, "board_ref string, payload string")
    payload_files.write_packed(df.coalesce(2), str(tmp_path / "packed"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    plain = lambda good: sorted((str(r.board_ref), r.pos, json.dumps(json.loads(r.raw), sort_keys=True), str(r.item)) for r in good.collect())
    try:
        for size in ("2000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            good, bad = feeds.items(payload_files.PayloadFiles(spark, str(tmp_path / "packed"), packed=True), "A")
            want, want_bad = feeds.items(df, "A")
            assert plain(good) == plain(want) and sorted(map(str, bad.collect())) == sorted(map(str, want_bad.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_feed_files_no_folder_per_board(spark):
    """As many files as tasks write, however many boards there are."""
    shared = Path(shared_dir(spark))
    known = set(shared.glob("payloads-*"))
    tables_io.feed_files(spark, "/root/testdata/sf0.001")
    (path,) = set(shared.glob("payloads-*")) - known
    assert not list(path.glob("board_ref=*")) and 0 < len(list(path.glob("part-*"))) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_doubled_details(spark):
    """A detail that was fetched twice makes one posting; the surplus is told."""
    item = lambda k: {"id": k, "name": "n", "uuid": k, "url": "u", "jobOpeningName": "n"}
    listed = [item("1"), item("2")]
    kinds = {"H": (feeds.shape_h, listed, lambda k, t: {"uuid": k, "description": {"role": t}}), "I": (feeds.shape_i, {"content": listed}, lambda k, t: {"id": k, "postingUrl": t}), "D": (feeds.shape_d, {"result": listed}, lambda k, t: {"result": {"jobOpening": {"id": k, "description": t}}})}
    for shape, payload, detail in kinds.values():
        details = payloads(spark, *[("b", detail("1", t)) for t in ("x", "y", "x")], ("b", detail("9", "x")), ("b", detail("9", "x")), ("b", "not json"))
        good, bad = shape(payloads(spark, ("b", payload)), details)
        assert [r.external_id for r in good.collect()] == ["1"]
        assert sorted(r.reason for r in bad.collect()) == ["detail again: 1", "detail again: 1", "detail again: 9", "no readable detail: 2"]


def test_unescape(spark):
    """Every HTML5 name and number of note, cut and joined at random, as the standard library decodes it."""
    rng = random.Random(1)
    texts = [None, "", "&", "&&", "&;", "&#;", "&#x;", "&#x", "&notit;", "&#00065;", "&#X41;z", "&#xD800;", "&#1114112;", "&#" + "9" * 30 + ";", "&#" + "0" * 30 + "65;", "&" + "a" * 40 + ";", "&é;", "&amp;lt;", "&#x10FFFF;"]
    texts += [f"a&{k}b" for k in html5] + [f"&{k.rstrip(';')} " for k in html5] + [f"&{k}" for k in html5]
    texts += ["".join(rng.choice(["&", "#", "x", "1", "F", "amp", "lt;", "not", "in;", ";", "q", "<", " ", "é", "\n"]) for _ in range(rng.randint(1, 15))) for _ in range(1500)]
    texts += [f"&#{n};" for n in [*range(300), *range(0xFDC0, 0xFDF8), *range(0xFFF0, 0x10010)]]
    rows = spark.createDataFrame([*enumerate(texts)], "i int, t string").select("i", tx.unescape_html(F.col("t")).alias("u"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert {r.i: r.u for r in rows.collect()} == {i: t if t is None else html.unescape(t) for i, t in enumerate(texts)}


def test_automaton_equals_patterns(spark):
    rng = random.Random(2)
    draw = lambda: "".join(rng.choice("ab1+. -_É") for _ in range(rng.randint(1, 4)))
    terms = sorted({draw() for _ in range(150)} | {"AB", "ab", "aB1"})
    texts = ["".join(rng.choice("abAB1+. -_éÉ") for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", matching.matched_terms(F.col("t"), terms).alias("a"), matching.many_terms(terms)(F.lower("t")).alias("b")).collect()
    assert all(r.a == r.b for r in got) and any(len(r.a) > 3 for r in got)


def test_many_terms_cost_like_few(spark):
    """Ten thousand terms take about the time of five hundred: the automaton reads a text once."""
    text = " ".join(f"w{i % 997}x{i % 13}" for i in range(4000))
    df = spark.range(200).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t"))

    def took(n):
        began = time.time()
        df.select(F.size(matching.many_terms([f"w{i}x{i % 13}" for i in range(n)])(F.lower("t"))).alias("n")).agg(F.sum("n")).collect()
        return time.time() - began

    took(500)
    assert took(10_000) < 4 * took(500) + 3
