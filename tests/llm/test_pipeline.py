"""The pipeline's stages on small rows, and the whole of it against its stages run by hand."""

import corpus_pipeline
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    base = [" ".join(f"{c}{i}{k}" for k in range(40)) + "." for i, c in enumerate("abcdefghij")]
    passage = " ".join(f"p{k}" for k in range(60)) + "."
    rows = [(i, t) for i, t in enumerate(base)] + [(20, base[0]), (21, base[1] + "\n" + passage), (22, passage + "\n" + base[2] + " own words at the end"), (30, None), (31, ""), (32, "mail me at a@b.org now")]
    rows += [(40 + i, f"you are a grobian {i} {i * i}.") for i in range(30)]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i >= 40)) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, folder)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        gone = {*before} - {*after}
        if k == 0:
            assert gone == set(range(40, 70))
        elif k == 1:
            assert gone == {20, 31}  # a copy of 0; 30 and 31 have no words
        else:
            assert not gone
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after.values())
    assert "[EMAIL]" in after[32].text and sum("p59." in (r.text or "") for r in after.values()) == 1


def test_whole(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, docs.select(columns).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, folder).select(columns).collect()))


def test_near_dedup_ids(spark):
    """Only members of groups go: neither texts without an id, nor one of two texts that share an id."""
    text = lambda c: " ".join(f"{c}{k}" for k in range(40))
    rows = [(None, text("a")), (None, text("b")), (1, text("c")), (1, text("d")), (2, text("b")), (3, text("e")), (3, text("e")), (None, text("f")), (None, text("f"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    want = [(None, text("a")), (1, text("c")), (1, text("d")), (2, text("b")), (3, text("e")), (None, text("f"))]
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in want)
