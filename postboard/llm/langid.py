"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit (log odds of hashed byte trigrams) predicts a
margin for the text; the codeword with the least loss over all bits, weighted by how reliable each bit was in training,
names the language. A small gap between the two best codewords flags the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import hash_share, held_out, rows_of

LETTER = regex.compile(r"\p{L}")


def codewords(n: int, extra_bits: int = 24) -> np.ndarray:
    """A row of bits (+1, -1) per language: the exhaustive code for up to five, else fixed pseudo-random columns."""
    if n < 2:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        return np.array([[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for b in range(2 ** (n - 1) - 1)] for i in range(n)], dtype=np.int8).reshape(n, -1)
    rng, bits = np.random.default_rng(7), max(31, n + extra_bits)
    code = np.where(rng.permuted(np.tile(np.arange(n) % 2, (bits, 1)), axis=1).T > 0, 1, -1)
    return code.astype(np.int8)


def buckets_of(text: str, bits: int) -> np.ndarray:
    """A hash bucket for each byte trigram of the whole lower-cased text."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    h = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return (h * np.uint32(2654435761)) >> np.uint32(32 - bits)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (buckets, code bits) log odds
    trust: np.ndarray  # weight of each code bit in decoding
    bits: int

    def margins(self, text: str) -> np.ndarray:
        return self.weights[buckets_of(text, self.bits)].mean(axis=0)

    def predict(self, text: str | None, sharpness: float, least_gap: float) -> tuple[str, float, bool]:
        if text is None or not self.languages or not LETTER.search(text):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.log1p(np.exp(np.clip(-sharpness * self.code * self.margins(text), -60, 60)))).sum(axis=1) / self.trust.sum()
        p = np.exp(-2 * (loss - loss.min()))
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        return self.languages[order[0]], float(p[order[0]]), bool(p[order[0]] - p[order[1]] < least_gap)


def fit(docs: DataFrame, *, max_rows: int = 20_000, bits: int = 16, smoothing: float = 0.5, sharpness: float = 4.0, most_languages: int = 200) -> Model:
    """Learn from documents with a letter and a language that are not held out, about `max_rows` of them by a hash of the id.

    The counts are summed in Spark; the driver and each task get languages x 2**bits numbers at most, so more than
    `most_languages` languages are an error.
    """
    labelled = docs.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sample = hash_share(labelled, ["doc_id", "text"], max_rows, labelled.count()).select("lang", "text")
    if (found := len(sample.select("lang").distinct().limit(most_languages + 1).collect())) > most_languages:
        raise ValueError(f"{found} languages or more; the model holds {most_languages}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for langs, texts in rows_of(batches, "lang", "text"):
            for lang, text in zip(langs, texts, strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(buckets_of(text, bits), minlength=1 << bits)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["lang", "bucket", "n"])

    rows = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    n = np.zeros((len(languages), 1 << bits))
    n[rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int), rows["bucket"].to_numpy(dtype=int)] = rows["n"].to_numpy()
    p = (n + smoothing) / (n.sum(axis=1, keepdims=True) + smoothing * (1 << bits))
    code = codewords(len(languages))
    mean = lambda sign: ((code == sign).T @ p) / np.maximum(1, (code == sign).sum(axis=0))[:, None]
    weights = np.log(mean(1) / mean(-1)).T.astype(np.float32) if len(languages) > 1 else np.zeros((1 << bits, code.shape[1]), np.float32)
    model = Model(languages, code, weights, np.ones(code.shape[1]), bits)

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrong, total = np.zeros(code.shape[1]), 0
        for langs, texts in rows_of(batches, "lang", "text"):
            for lang, text in zip(langs, texts, strict=True):
                wrong += np.sign(model.margins(text)) != code[languages.index(lang)]
                total += 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(wrong)), -1], pa.int32()), pa.array([*wrong.astype(int), total], pa.int64())], ["bit", "n"])

    if len(languages) > 1:
        found = {r["bit"]: r["n"] for r in sample.mapInArrow(errors, "bit int, n long").groupBy("bit").agg(F.sum("n").alias("n")).collect()}
        rate = (np.array([found[b] for b in range(code.shape[1])]) + 1) / (found[-1] + 2)
        model = Model(languages, code, weights, np.maximum(0.05, np.log((1 - rate) / rate)), bits)
    return model


def identify(docs: DataFrame, model: Model, *, sharpness: float = 4.0, least_gap: float = 0.1) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1) and ambiguous. Only the text is looked at.

    Null texts and texts without a letter give `und`, score 0, ambiguous. So does everything when nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, out, texts in rows_of(batches, "doc_id", "held_out", "text"):
            found = [model.predict(t, sharpness, least_gap) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(out, pa.bool_()), *[pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
