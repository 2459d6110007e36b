"""A corpus from raw documents to packed sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postboard.llm import linededup, packing, pii, simhash, toxicity
from postboard.llm.common import materialise
from postboard.llm.queries import TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(df: DataFrame) -> DataFrame:
    """The columns of documents, n_chars being that of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return documents(toxicity.reject_toxic(docs, grammar, threshold=0.7))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group stays: the one with the least id (null ids last), then the least hash. Rows equal in id and
    text are one row, the least of them."""
    kept = simhash.survivors(docs, radius=4, width=4).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(kept["_id"]) & (rows["_text_hash"] == kept["_hash"]), "left_semi")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    least = rows.groupBy("doc_id", "_text_hash").agg(F.min(F.struct(*others, "text")).alias("_row"))
    return documents(least.select("doc_id", "_row.*"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return documents(linededup.remove_repeats(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return documents(pii.sanitise(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, TOKENIZER, capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", simhash_stage),
    ("substring dedup", substring_stage),
    ("pii", pii_stage),
    ("best-fit packing", packing_stage),
]

#: The stages learn models, hash with functions SQL lacks and tokenise; the tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
