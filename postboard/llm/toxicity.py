"""Toxicity by a weighted grammar of finite-state transducers over word classes.

A lexical transducer maps words to classes: insult, threat, target, negation, reported speech, copula, filler and other.
Three machines read the classes of a clause in order. The first marks an insult or threat as negated when a negation stands
before it with only fillers between (a negated target is none). The second marks those after a verb of reported speech; a
colon or a quotation mark does not end a clause. The third accepts an insult or threat with a target within reach before or
after it, an insult after a copula ("the man is an ..."), two insults, an insult that ends an exclamation, and an insult
alone; its final state names the pattern. The machines are composed into one table once. A clause's score is that of its
best path: the weight of the insult or threat times the weight of the pattern. Insults (words and word beginnings) and
pattern weights are learned from labelled documents; negated and reported patterns never weigh as much as plain ones, and
an insult alone never weighs enough to reject a text. A document's score combines its matched clauses, so that insults
alone count where several clauses have one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import hash_share, held_out, rows_of

#: Words of the closed classes in the languages at hand.
TARGETS = frozenset("you your yourself u he she they them him her du dich dir dein deine ihr euch sie tu te toi ton ta vous votre tú ti tus usted ustedes vosotros".split())
NEGATIONS = frozenset("not no never neither nor without isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemals ne pas jamais aucun aucune sans nunca jamás ni tampoco ningún ninguna sin".split())
REPORTS = frozenset("said says say wrote writes quoted quotes claimed claims reported called sagte sagt schrieb behauptet zitierte dit disait écrit déclaré rapporte dijo dice escribió afirmó citó".split())
THREATS = frozenset("kill murder destroy hurt shoot stab strangle beat töten umbringen erschießen vernichten zerstören tuer tuerai assassiner égorger détruire matar mataré asesinar destruir golpear".split())
COPULAS = frozenset("be is are am was were been bin bist ist sind war est suis êtes sont était es eres son sea era".split())
FILLERS = frozenset("a an the that this such some any so very really quite totally ein eine einen der die das so sehr un une le la les si très el los las una tan muy".split())
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;\n]")
END = "."
CLAUSE_END = frozenset(".!?;\n")
CLASSES = (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", THREATS), ("C", COPULAS), ("F", FILLERS), (END, CLAUSE_END))
#: Symbols of the machines: classes, and V for the end of an exclamation, come in; between the machines there are marked
#: insults and threats (small: negated; J, K: reported).
ALPHABET, STEMS = "OFTNRIHCV", range(4, 9)
NEGATED, REPORTED = {"I": "i", "H": "h"}, {"I": "J", "i": "j", "H": "K", "h": "k"}
#: How many fillers may stand after a negation, and other words between a target and its insult or threat.
FILLER_REACH, BEFORE, AFTER = 3, 6, 3
#: Weight of a pattern before learning; shares of it for marks; the most that a marked one may have of its plain form's.
PRIORS = {"TI": 0.9, "IT": 0.85, "CI": 0.85, "II": 0.85, "I!": 0.75, "I": 0.5, "HT": 0.9, "TH": 0.4}
PRIOR_NEGATED, PRIOR_REPORTED, MOST_MARKED = 0.15, 0.35, 0.5
#: The most that an insult alone weighs: one clause stays below a threshold of 0.7, two come to 0.8.
MOST_ALONE = 0.55

State = tuple[object, ...]
#: A machine's arcs from a state by a symbol: the next state and what is put out.
Arcs = Callable[[State, str], list[tuple[State, str]]]


def negation(q: State, x: str) -> list[tuple[State, str]]:
    """State: how many more words the negation reaches over."""
    (left,) = q
    if x == "N":
        return [((FILLER_REACH + 1,), "O")]
    if x in "FC":
        return [((max(0, left - 1),), x)]
    return [((0,), "O" if left and x == "T" else NEGATED.get(x, x) if left else x)]


def report(q: State, x: str) -> list[tuple[State, str]]:
    """State: whether a verb of reported speech was read."""
    if x == "R":
        return [((1,), "O")]
    return [(q, REPORTED.get(x, x) if q[0] else x)]


def clause(q: State, x: str) -> list[tuple[State, str]]:
    """Finds a pattern, in any way it can: each path picks one insult or threat and, where it likes, one target."""
    kind, *rest = q
    if kind == "end":  # a pattern was found
        return [(q, "")]
    if kind == "start":
        out = [(q, "")]
        if x == "T":
            out.append((("target", BEFORE), ""))
        elif x in "IiJj":
            out += [(("end", x), "weight"), (("open", x, AFTER), "weight")]
        elif x in "HhKk":
            out.append((("open", x, AFTER), "weight"))
        elif x == "C":
            out.append((("copula", FILLER_REACH), ""))
        return out
    if kind == "copula":
        if x in "IiJj":
            return [(("end", "C" + x), "weight")]
        return [(("copula", rest[0] - 1), "")] if x == "F" and rest[0] else []
    if kind == "again":
        return [(("end", rest[0] * 2), "weight")] if x == rest[0] else [(q, "")]
    if kind == "target":
        if x in "IiJjHhKk":
            return [(("end", "T" + x), "weight")]
        return [(("target", rest[0] - 1), "")] if rest[0] else []
    found, left = rest
    if x == "T":
        return [(("end", found + "T"), "")]
    if x == "V" and left == AFTER and found in "IiJj":
        return [(("end", found + "!"), "")]
    out = [(("open", found, left - 1), "")] if left else []
    if found in "IiJj":
        out.append((("end", found * 2), "weight") if x == found else (("again", found), ""))
    return out


MACHINES: tuple[tuple[Arcs, State], ...] = ((negation, (0,)), (report, (0,)), (clause, ("start",)))


def composed() -> tuple[list[list[list[tuple[int, bool]]]], dict[int, str]]:
    """The machines as one: arcs by state and symbol (next state, whether the word's weight counts), and final states.

    State 0 is the start. Only states that can be reached are made.
    """
    start = tuple(q for _, q in MACHINES)
    number, table, todo = {start: 0}, [], [start]
    for states in todo:  # grows on the way
        row = []
        for symbol in ALPHABET:
            ways: list[tuple[tuple[State, ...], str]] = [((), symbol)]
            for (arcs, _), q in zip(MACHINES, states, strict=True):
                ways = [((*done, after), y) for done, x in ways for after, y in arcs(q, x)]
            for after, _ in ways:
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
            row.append([(number[after], y == "weight") for after, y in ways])
        table.append(row)
    return table, {k: q[-1][1] for q, k in number.items() if q[-1][0] == "end"}


TABLE, FINAL = composed()


def plain_form(pattern: str) -> tuple[str, bool, bool]:
    """The pattern without marks, and whether it was negated and reported."""
    plain = pattern.translate(str.maketrans("iJjhKk", "IIIHHH"))
    return plain, any(c in "ijhk" for c in pattern), any(c in "JjKk" for c in pattern)


def prior_of(pattern: str) -> float:
    plain, negated, reported = plain_form(pattern)
    return PRIORS[plain] * (PRIOR_NEGATED if negated else 1.0) * (PRIOR_REPORTED if reported else 1.0)


PATTERNS = sorted({*FINAL.values()})


@dataclass
class Grammar:
    """`lexicon` has learned insults: a word, or a beginning followed by `*`, with its weight (0 to 1)."""

    lexicon: dict[str, float]
    patterns: dict[str, float] = field(default_factory=lambda: {p: prior_of(p) for p in PATTERNS})
    cache: dict[str, tuple[str, float]] = field(default_factory=dict)

    def arc(self, word: str) -> tuple[str, float]:
        """The lexical transducer: class and weight of a word."""
        weight = max([self.lexicon.get(word, 0.0), *(self.lexicon.get(word[:k] + "*", 0.0) for k in STEMS if k <= len(word))])
        found = ("I", weight) if weight else next(((c, 1.0) for c, of in CLASSES if word in of), ("O", 1.0))
        if len(self.cache) > 200_000:
            self.cache.clear()
        self.cache[word] = found
        return found

    def found(self, arcs: list[tuple[str, float]]) -> dict[str, float]:
        """The greatest weight of the insult or threat over all paths to each pattern."""
        now = {0: 1.0}
        for symbol, weight in arcs:
            k, after = ALPHABET.index(symbol), {}
            for q, w in now.items():
                for to, counts in TABLE[q][k]:
                    value = w * weight if counts else w
                    if value > after.get(to, 0.0):
                        after[to] = value
            now = after
        best: dict[str, float] = {}
        for q, w in now.items():
            if q in FINAL:
                best[FINAL[q]] = max(w, best.get(FINAL[q], 0.0))
        return best

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """(pattern, score) of the best path of each clause that matches; clauses without insult or threat cannot."""
        cache, words = self.cache, WORD.findall(text.lower())
        arcs = [cache.get(w) or self.arc(w) for w in words]
        at, out = [k for k, (c, _) in enumerate(arcs) if c in "IH"], []
        if not at:
            return out
        ends = [-1, *(k for k, (c, _) in enumerate(arcs) if c == END), len(arcs)]
        i = 0
        for a, b in zip(ends, ends[1:], strict=False):
            if i < len(at) and at[i] < b:
                while i < len(at) and at[i] < b:
                    i += 1
                cried = [("V", 1.0)] if b < len(words) and words[b] == "!" else []
                if best := self.found(arcs[a + 1 : b] + cried):
                    out.append(max(((p, w * self.patterns[p]) for p, w in best.items()), key=lambda x: (x[1], x[0])))
        return out

    def score(self, text: str | None, base: float = 0.02) -> float:
        clean = 1 - base
        for _, weight in self.clauses(text or ""):
            clean *= 1 - weight
        return 1 - clean


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, toxic) of labelled documents that are not held out, about `max_rows` of them by a hash of the id.

    The bound makes the chosen labels small enough to broadcast; a document with labels that differ counts as toxic.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_share(known, "doc_id", max_rows, known.count()).withColumnRenamed("doc_id", "_id")
    return docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def learn_lexicon(sample: DataFrame, least: int, precision: float, max_entries: int) -> dict[str, float]:
    """Words, and word beginnings of 4 to 8 letters, that mark toxic documents.

    An occurrence counts once for each different pair of neighbours, so copies of a text do not make its rare words
    insults. A beginning must hold for the different words that have it, three at least, and not only for a frequent one. At most `max_entries` entries, the most frequent first, come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, toxic in rows_of(batches, "text", "toxic"):
            out: list[list[object]] = [[], [], []]
            for text, label in zip(texts, toxic, strict=True):
                w = ["", *WORD.findall(text.lower()), ""]
                for a, b, c in zip(w, w[1:], w[2:], strict=False):
                    if len(b) > 1:
                        for column, value in zip(out, (b, xxhash.xxh3_64_intdigest(f"{a} {c}") - 2**63, int(label)), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.int32()), strict=True)], ["word", "context", "toxic"])

    found = sample.mapInArrow(run, "word string, context long, toxic int").distinct()
    bad = F.sum((F.col("toxic") > 0).cast("long"))
    words = found.groupBy("word").agg(bad.alias("bad"), F.count("*").alias("n"))
    entries = F.array(F.col("word"), *[F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS])
    counts = words.select(F.explode(F.array_compact(entries)).alias("entry"), "bad", "n").groupBy("entry").agg(
        F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(2 * F.col("bad") > F.col("n")).alias("bad_words")
    )
    stem = ~F.col("entry").endswith("*") | (F.col("bad_words") >= 3) & ((F.col("bad_words") + 0.5) / (F.col("words") + 1) >= precision)
    weight = (F.col("bad") + 0.5) / (F.col("n") + 1)
    kept = counts.filter((F.col("bad") >= least) & (weight >= precision) & stem).select("entry", weight.alias("weight"), "bad")
    return {r["entry"]: r["weight"] for r in kept.orderBy(F.desc("bad"), "entry").limit(max_entries).collect()}


def learned_patterns(counts: dict[str, tuple[int, int]], strength: float) -> dict[str, float]:
    """Weight of each pattern from (toxic, all) documents with it; few documents leave it near its prior. A negated or
    reported pattern gets a share of its plain form's weight at most, once for each mark, and an insult alone a fixed most."""
    raw = {p: (counts.get(p, (0, 0))[0] + prior_of(p) * strength) / (counts.get(p, (0, 0))[1] + strength) for p in PATTERNS}
    raw["I"] = min(raw["I"], MOST_ALONE)
    out = {}
    for p in PATTERNS:
        plain, negated, reported = plain_form(p)
        out[p] = min(raw[p], raw[plain] * MOST_MARKED ** (negated + reported))
    return out


def fit(
    docs: DataFrame, labels: DataFrame, *, max_rows: int = 40_000, least: int = 6, precision: float = 0.9, max_entries: int = 20_000, strength: float = 5.0
) -> Grammar:
    """Learn the insults and the weight of each clause pattern; without labels the grammar knows threats alone."""
    sample = labelled(docs, labels, max_rows)
    grammar = Grammar(learn_lexicon(sample, least, precision, max_entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[tuple[str, int]] = Counter()
        for texts, toxic in rows_of(batches, "text", "toxic"):
            for text, label in zip(texts, toxic, strict=True):
                n.update({(p, int(label > 0)) for p, _ in grammar.clauses(text)})
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.int32()), pa.array([*n.values()], pa.int64())], ["pattern", "toxic", "n"])

    rows = sample.mapInArrow(run, "pattern string, toxic int, n long").groupBy("pattern").agg(F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum("n").alias("n")).collect()
    grammar.patterns = learned_patterns({r["pattern"]: (r["bad"], r["n"]) for r in rows}, strength)
    grammar.cache = {}
    return grammar


def score(docs: DataFrame, grammar: Grammar, *, threshold: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted. Null and empty texts get the base score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, out, texts in rows_of(batches, "doc_id", "held_out", "text"):
            scores = [grammar.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(out, pa.bool_()), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def reject_toxic(docs: DataFrame, grammar: Grammar, *, threshold: float = 0.7) -> DataFrame:
    """The rows of documents, with all columns, whose text scores below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([grammar.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
