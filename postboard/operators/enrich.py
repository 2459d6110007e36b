"""Incremental enrichment of distinct texts: worklists, the batch model surface, upserts, and vector matching."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postboard.functions.text import round_score
from postboard.sources import versioned
from postboard.tables import materialise

EXTRACTED = "content_hash string, company_type string, geo_restriction string, manages_people string, years_experience_min long, required_techs string, nice_to_have_techs string, relevant_text string, extract_ok boolean, extract_model string, extracted_at timestamp"
SCORED = "content_hash string, fit_score long, scoring_model string, prompt_version string, scored_at timestamp"
MATCHED = "content_hash string, similarity double, best_match_unit_id string, best_match_source string, best_match_evidences string, embedding_model string, matched_at timestamp"
#: What an extraction model returns for a text, besides its status.
ANSWER = "company_type string, geo_restriction string, manages_people string, years_experience_min long, required_techs array<string>, nice_to_have_techs array<string>, relevant_text string, status string, response string"


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """The table of a step that is switched off."""
    return spark.createDataFrame([], schema)


def distinct_texts(silver: DataFrame) -> DataFrame:
    """One row per content hash: title, text, and its distinct locations joined by a bar, in order (null if none)."""
    places = F.array_join(F.array_sort(F.collect_set("location")), " | ")
    return silver.groupBy("content_hash").agg(F.min("title").alias("title"), F.min("clean_text").alias("clean_text"), F.nullif(places, F.lit("")).alias("locations"))


def todo(work: DataFrame, done: DataFrame, **current: str) -> DataFrame:
    """Rows of the worklist whose content hash is not done under the current values of the named columns."""
    for column, value in current.items():
        done = done.filter(F.col(column).eqNullSafe(F.lit(value)))
    return work.join(done.select("content_hash").distinct(), "content_hash", "left_anti")


def to_extract(silver: DataFrame, extracted: DataFrame, model: str) -> DataFrame:
    """Texts that the current model has not extracted well; failed rows come again."""
    return todo(distinct_texts(silver), extracted.filter("extract_ok"), extract_model=model)


def scorable(extracted: DataFrame) -> DataFrame:
    return extracted.filter("extract_ok and relevant_text is not null and relevant_text <> ''")


def newest_prompt(prompts: DataFrame) -> DataFrame:
    """One row: the prompt rendered last."""
    return prompts.agg(F.max_by(F.struct(*prompts.columns), F.struct("rendered_at", "prompt_version", "rendered_prompt")).alias("p")).filter("p is not null").select("p.*")


def to_score(extracted: DataFrame, scored: DataFrame, prompts: DataFrame, model: str) -> DataFrame:
    """Scorable texts with the newest prompt, unless scored with this text, prompt and model. No prompt, no work."""
    work = scorable(extracted).join(F.broadcast(newest_prompt(prompts)), how="cross").withColumn("scoring_model", F.lit(model))
    return work.join(scored.select("content_hash", "prompt_version", "scoring_model").distinct(), ["content_hash", "prompt_version", "scoring_model"], "left_anti")


def extraction_prompt(instruction: str, location: Column, title: Column, text: Column) -> Column:
    none = lambda c, s: F.coalesce(c, F.lit(s))
    return F.concat(F.lit(instruction + "\n<location>"), none(location, "not stated"), F.lit("</location>\n<posting>"), none(title, ""), F.lit("\n"), none(text, ""), F.lit("</posting>"))


Model = Callable[[pd.DataFrame], pd.DataFrame]


def infer(work: DataFrame, model: Model, schema: str, concurrency: int | None = None) -> DataFrame:
    """Call the model on batches of the worklist; `concurrency` bounds how many tasks call it at once."""
    work = work.repartition(concurrency) if concurrency else work

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield model(batch)

    return work.mapInPandas(run, schema)


def extraction_rows(answers: DataFrame, model: str, at: Column) -> DataFrame:
    """The extraction table's rows; a failure is a row with extract_ok false. The response may name a model version."""
    ok = F.coalesce(F.col("status"), F.lit("")) == ""
    return answers.select(
        "content_hash", "company_type", "geo_restriction", "manages_people", "years_experience_min",
        F.array_join("required_techs", ", ").alias("required_techs"), F.array_join("nice_to_have_techs", ", ").alias("nice_to_have_techs"),
        "relevant_text", ok.alias("extract_ok"), F.coalesce(F.get_json_object("response", "$.model_version"), F.lit(model)).alias("extract_model"), at.alias("extracted_at"),
    )


def score_rows(answers: DataFrame, model: str, at: Column) -> DataFrame:
    """The score table's rows; raw scores are rounded, and kept whatever their range."""
    return answers.select("content_hash", round_score(F.col("raw_score")).alias("fit_score"), F.lit(model).alias("scoring_model"), "prompt_version", at.alias("scored_at"))


def upsert(old: DataFrame, new: DataFrame, key: str = "content_hash") -> DataFrame:
    """New rows replace old ones with their key; columns that either lacks are null there."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_table(path: str, new: DataFrame, key: str = "content_hash", buckets: int = 256) -> versioned.Version:
    """Upsert into a table in buckets on disk: only the buckets of new rows are written, and one rename shows the new version.

    New columns join the table's, null in older rows. Readers of the version before are not disturbed.
    """
    return versioned.change(path, new, key, lambda old, rows: upsert(old, rows, key), buckets=buckets)


#: Angles may be off by so much before two of them count as different: cosines are compared to twelve digits.
SLACK = 2e-6


@dataclass(frozen=True)
class Pivots:
    """Some of the units as unit vectors, by length: their numbers and a matrix. At most `most` come to the driver."""

    by_dim: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(units: DataFrame, most: int) -> Pivots:
        groups: dict[int, list[np.ndarray]] = {}
        for r in units.orderBy(F.xxhash64("unit_id"), "unit_id").limit(most).collect():
            if usable(r["embedding"]):
                v = np.array(r["embedding"], float)
                groups.setdefault(len(v), []).append(v / np.linalg.norm(v))
        out, at = {}, 0
        for dim, vectors in groups.items():
            out[dim], at = (np.arange(at, at + len(vectors)), np.stack(vectors)), at + len(vectors)
        return Pivots(out)

    def angles(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pivots of this length (-1 where there is none), and the angle of each row to each."""
        numbers, vectors = self.by_dim.get(matrix.shape[1], (np.array([-1]), None))
        if vectors is None:
            return numbers, np.zeros((len(matrix), 1))
        return numbers, np.arccos(np.clip(matrix @ vectors.T / np.linalg.norm(matrix, axis=1)[:, None], -1, 1))


def usable(v: Sequence[float] | None) -> bool:
    return v is not None and len(v) > 0 and not pd.isna(v).any() and bool(np.any(v))


def packed(df: DataFrame, id_column: str, groups: int, block: int, chosen: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """(grp, pivot, dim, far, ids, vectors): blocks of up to `block` vectors of one length and pivot, the ids of a block in
    order. `chosen` gives pivots, which rows go to which, and the angles to them. Vectors that are null, hold a null or have no
    length are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["embedding"].map(usable)]
            for dim, part in batch.groupby(batch["embedding"].map(len)):
                part = part.sort_values("id", kind="stable")
                ids, matrix = part["id"].to_numpy(object), np.stack(part["embedding"].to_numpy()).astype(float)
                numbers, goes, angles = chosen(matrix)
                for k, pivot in enumerate(numbers.tolist()):
                    rows = np.flatnonzero(goes[:, k])
                    for at in range(0, len(rows), block):
                        some = rows[at : at + block]
                        raw = matrix[some].tobytes()
                        yield pd.DataFrame({"grp": [zlib.crc32(raw) % groups], "pivot": [pivot], "dim": [dim], "far": [float(angles[some, k].max())], "ids": [ids[some].tolist()], "vectors": [raw]})

    kind = df.schema[id_column].dataType.simpleString()
    return df.select(F.col(id_column).alias("id"), "embedding").mapInPandas(run, f"grp int, pivot int, dim int, far double, ids array<{kind}>, vectors binary")


def tiles(texts: DataFrame, units: DataFrame, *, block: int = 2048, grouped: int = 65_536, pivots: int | None = None) -> DataFrame:
    """(dim, hashes, x, units, y): blocks of texts and the blocks of units that can hold their nearest unit.

    Units are grouped by their nearest pivot. A text is no further from its nearest unit than from its nearest pivot, which is
    a unit, and no unit of a group is nearer than the angle to the group's pivot less the largest angle in the group: groups
    beyond are left out. Without `pivots` there is one to 4,096 units, 256 at most.

    Blocks are sorted and merged, never broadcast: a text's vector is there once per group that it meets, which Spark's
    estimate from the files does not know, and the driver would have to hold all of them.
    """
    n_all = units.count()
    size = lambda n: max(1, -(-n // grouped))
    n_texts, n_units = size(texts.count()), size(n_all)
    points = Pivots.of(units, max(1, min(256, n_all // 4096)) if pivots is None else pivots)
    spread = max(1, texts.sparkSession.sparkContext.defaultParallelism // (n_texts * n_units))  # more tiles where there are few
    n_texts *= spread
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def nearest(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers, angles = points.angles(matrix)
        return numbers, np.arange(len(numbers)) == angles.argmin(axis=1)[:, None], angles

    u = materialise(packed(units, "unit_id", n_units, block, nearest), "unit_blocks")
    reach = {r["pivot"]: r["far"] for r in u.groupBy("pivot").agg(F.max("far").alias("far")).collect()}  # a row per pivot

    def needed(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        numbers, angles = points.angles(matrix)
        reaches = np.array([reach.get(k, -np.inf) for k in numbers.tolist()])
        return numbers, angles - reaches <= angles.min(axis=1)[:, None] + SLACK, angles

    t = packed(texts, "content_hash", n_texts, block, needed).select(F.col("grp").alias("t"), "pivot", "dim", F.col("ids").alias("hashes"), F.col("vectors").alias("x"), each(n_units).alias("u"))
    u = u.select(F.col("grp").alias("u"), "pivot", "dim", F.col("ids").alias("units"), F.col("vectors").alias("y"), each(n_texts).alias("t"))
    return t.join(u.hint("merge"), ["t", "u", "pivot", "dim"]).select("dim", "hashes", "x", "units", "y")


def best_match(texts: DataFrame, units: DataFrame, *, block: int = 2048, grouped: int = 65_536, pivots: int | None = None) -> DataFrame:
    """Per content hash: the nearest unit by cosine distance, ties to the smaller unit id, and the similarity.

    Each group of texts meets each group of units that can hold a nearest one, block by block; the least distance of each text
    is merged over the tiles. Only vectors of equal length are compared. Texts whose vector is null, holds a null or has no
    length get null, and such units are never chosen.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, hashes, x, ids, y in zip(*[batch[c] for c in ("dim", "hashes", "x", "units", "y")], strict=True):
                a, b = (np.frombuffer(v).reshape(-1, dim) for v in (x, y))
                d = np.round(1 - (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)), 12)
                i = d.argmin(axis=1)  # the first, so the smallest id of the block
                yield pd.DataFrame({"content_hash": hashes, "d": d[np.arange(len(a)), i], "unit_id": [ids[k] for k in i]})

    kind, key = (df.schema[c].dataType.simpleString() for df, c in ((units, "unit_id"), (texts, "content_hash")))
    near = tiles(texts, units, block=block, grouped=grouped, pivots=pivots).mapInPandas(run, f"content_hash {key}, d double, unit_id {kind}")
    best = near.groupBy("content_hash").agg(F.min(F.struct("d", "unit_id")).alias("b"))
    return texts.select("content_hash").join(best, "content_hash", "left").select("content_hash", (1 - F.col("b.d")).alias("similarity"), "b.unit_id")


def match_rows(matches: DataFrame, units: DataFrame, model: str, at: Column) -> DataFrame:
    """The match table's rows: each nearest unit's source and evidences beside it; texts without a unit have none."""
    u = units.select(F.col("unit_id"), "source", F.array_join("evidences", ", ").alias("best_match_evidences"))
    df = matches.filter("unit_id is not null").join(u, "unit_id")
    return df.select(
        "content_hash", "similarity", F.col("unit_id").alias("best_match_unit_id"), F.col("source").alias("best_match_source"), "best_match_evidences", F.lit(model).alias("embedding_model"), at.alias("matched_at"),
    )


def to_match(extracted: DataFrame, matched: DataFrame) -> DataFrame:
    """(content_hash, relevant_text) of the scorable texts without a row in the match table."""
    return todo(scorable(extracted).select("content_hash", "relevant_text"), matched)
