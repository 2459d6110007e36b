"""Whole-word matching of rule terms in texts, without a join."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Up to this many terms are matched by native expressions; more by an automaton in a
#: vectorised helper.
MOST_NATIVE = 200
#: More terms of letters and digits than this are looked up among the text's words, all at once; fewer by a pattern each.
MOST_PATTERNS = 8


def word_pattern(term: str) -> str:
    """The term as it is, between string ends or characters other than a-z and 0-9. It begins with the term itself, so
    that only its occurrences are looked at."""
    special = re.sub(r"([^A-Za-z0-9\s])", r"\\\1", term.lower())
    return f"{special}(?<![a-z0-9]{special})(?![a-z0-9])"


def has_word(low: Column, term: str) -> Column:
    """Whether a text in lower case holds the term; False for a null text."""
    return F.coalesce(low.rlike(word_pattern(term)), F.lit(False))


def with_lower(text: Column, found: Callable[[Column], Column]) -> Column:
    """An expression over the text in lower case, which is made once."""
    return F.transform(F.array(F.lower(text)), found)[0]


def many_terms(terms: Sequence[str]):  # noqa: ANN201
    """A column function of texts in lower case for large term sets: one Aho-Corasick automaton reads each text once, however
    many terms there are. Tasks make the automaton from the terms; it is not sent."""
    by_low: dict[str, list[str]] = {}
    for t in terms:
        by_low.setdefault(t.lower(), []).append(t)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for low in by_low:
            automaton.add_word(low, low)
        automaton.make_automaton()
        part_of_word = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

        def one(low: str | None) -> list[str]:
            found = set()
            for end, word in automaton.iter(low or ""):
                begin = end + 1 - len(word)
                if word not in found and low[begin - 1 : begin] not in part_of_word and low[end + 1 : end + 2] not in part_of_word:
                    found.add(word)
            return sorted(t for word in found for t in by_low[word])

        for s in batches:
            yield s.map(one)

    return match


def matched_terms(text: Column, terms: Sequence[str]) -> Column:
    """Sorted array of the distinct terms that the text holds as whole words; [] for null texts and no terms."""
    terms = sorted({t for t in terms if t})
    if not terms:
        return F.array().cast("array<string>")
    if len(terms) > MOST_NATIVE:
        return many_terms(terms)(F.lower(text))
    words = [t for t in terms if re.fullmatch("[a-z0-9]+", t)]
    words = words if len(words) > MOST_PATTERNS else []
    others = [t for t in terms if t not in {*words}]
    pattern = lambda low: [F.when(has_word(low, t), F.lit(t)) for t in others]
    if not words:
        return with_lower(text, lambda low: F.array_compact(F.array(*pattern(low))))
    return with_lower(text, lambda low: F.array_sort(F.array_compact(F.concat(words_among(low, words), F.array(*pattern(low)).cast("array<string>")))))


def words_among(low: Column, words: Sequence[str]) -> Column:
    """The given words of a-z and 0-9 that a text in lower case holds; the text is split once, however many words there are."""
    return F.array_intersect(F.split(F.coalesce(low, F.lit("")), "[^a-z0-9]+"), F.array(*map(F.lit, words)))


def any_word(text: Column, terms: Sequence[str]) -> Column:
    terms = sorted({t for t in terms if t})
    if len(terms) > MOST_NATIVE:
        return F.size(matched_terms(text, terms)) > 0
    if not terms:
        return F.lit(False)
    return with_lower(text, lambda low: reduce(operator.or_, [has_word(low, t) for t in terms]))


def term_list(rules: DataFrame, column: str, most: int = 100_000) -> list[str]:
    """The distinct terms of a rule table. Rule tables are configuration; one beyond `most` rows is refused."""
    rows = rules.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column}: more than {most} rules")
    return sorted(r[0] for r in rows)


def scan_lines(docs: DataFrame, terms: Sequence[str], kind: str, *, shortest: int = 4, skipped: Sequence[str] = ()) -> DataFrame:
    r"""(key, line_no from 1, term, kind): private terms between word boundaries (\b) in each line of `text`."""
    wanted = sorted({t.lower() for t in terms if len(t) >= shortest and t.lower() not in skipped})
    lines = docs.select("key", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    low = F.lower("line")
    hits = F.array_compact(F.array(*[F.when(low.rlike(rf"\b{re.sub(r'([^A-Za-z0-9\s])', r'\\\1', t)}\b"), F.lit(t)) for t in wanted])) if wanted else F.array().cast("array<string>")
    return lines.select("key", (F.col("line_no") + 1).cast("long").alias("line_no"), F.explode(hits).alias("term")).withColumn("kind", F.lit(kind))
