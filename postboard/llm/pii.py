"""Personal data: base patterns, and terms that reveal protected entities (DataFrame functions only).

Base spans come from fixed patterns. A term that occurs with a protected entity (an e-mail address, an IP address, a card
or phone number, or what several such values share) can reveal it: the corpus tells how strongly. With n_e, n_t and n_te
the documents that hold the entity, the term and both, and N all documents, the pointwise mutual information
log(n_te N / (n_e n_t)) is compared with the information log(N / n_e) of the entity itself. A term that discloses more
than a share of it is a span of kind `term` wherever it occurs. Sanitising generalises base spans to their kind and
removes terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise

#: The patterns of the base kinds. A match starts where a run of its first characters does, or where the last
#: match ended (\G), and runs are possessive: a long run is read once, and long addresses need no deep stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: 16 to 19 digits: a whole run of digits with single separators, so that longer and shorter runs fail.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What can be a term.
WORD = r"\p{L}{4,}"
KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<start:int,end:int,value:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def good(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) < 3) | F.forall(
            F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.lpad(F.right(p, F.lit(3)), 3, "0") <= "255")
        )
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def good_ones(kind: str) -> Column:
    return F.filter(kind, lambda s: good(kind, s["value"]))


def sums_before(lengths: Column, each: int = 256) -> Column:
    """For each entry of an array the sum of those before it, in parts, so that long arrays are not copied entry by entry."""
    ints = F.array().cast("array<int>")
    state = lambda at, out: F.struct(at.alias("at"), out.alias("out"))
    inner = lambda part, at: F.aggregate(part, state(at, ints), lambda a, x: state(a["at"] + x, F.array_append(a["out"], a["at"])), lambda a: a["out"])
    parts = F.transform(F.sequence(F.lit(0), (F.size(lengths) / each).cast("int")), lambda c: F.slice(lengths, c * each + 1, each))
    outer = lambda a, part: state(a["at"] + F.aggregate(part, F.lit(0), lambda s, x: s + x), F.array_append(a["out"], inner(part, a["at"])))
    return F.flatten(F.aggregate(parts, state(F.lit(0), F.array().cast("array<array<int>>")), outer, lambda a: a["out"]))


def matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Adds start, end and value of each match of the pattern in `_text`, in order.

    Matches are extracted and the text is split by the same pattern; lengths of parts and matches add up to offsets.
    """
    df = df.withColumn("_m", F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.transform(F.split("_text", pattern, -1), lambda p: F.length(p))))
    df = df.withColumn("_b", F.when(F.size("_m") > 0, sums_before(F.transform("_m", lambda m, k: F.get("_p", k) + F.length(m)))))
    at = lambda k: F.get("_b", k) + F.get("_p", k)
    spans = F.transform("_m", lambda m, k: F.struct(at(k).alias("start"), (at(k) + F.length(m)).alias("end"), m.alias("value")))
    return df.withColumn(column, F.when(F.size("_m") > 0, spans).otherwise(F.array().cast(SPAN))).drop("_m", "_p", "_b")


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, _text and a column of spans per kind for each row; a null text counts as empty."""
    df = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("_text"))
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        df = matches(df, kind, pattern)
        df = df.withColumn(kind, good_ones(kind))
    return df


def words_of(text: Column) -> Column:
    """The words of a text in lower case, each once; those inside e-mail addresses are part of the value and do not count."""
    free = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(free, F.lit(WORD), F.lit(0)), lambda w: F.lower(w)))


def entities(spans: DataFrame) -> Column:
    """The protected entities of a row, each once: the literal values, and what several of them share (the domain of an
    address, the network of an IP address, the issuer of a card, a phone number without its last four digits)."""
    value = lambda k, f: F.transform(k, lambda s: F.concat(F.lit(k + ":"), f(F.lower(s["value"]))))
    coarse = lambda k, f: F.transform(k, lambda s: F.concat(F.lit(k + " group:"), f(F.lower(s["value"]))))
    plain = [value("email", lambda v: v), value("ip", lambda v: v), value("card", digits), value("phone", digits)]
    shared = [
        coarse("email", lambda v: F.substring_index(v, "@", -1)), coarse("ip", lambda v: F.substring_index(v, ".", 3)),
        coarse("card", lambda v: F.left(digits(v), F.lit(6))), coarse("phone", lambda v: F.substring(digits(v), F.lit(1), F.length(digits(v)) - 4)),
    ]
    return F.array_distinct(F.concat(*plain, *shared))


def disclosing_terms(rows: DataFrame, some: DataFrame, share: float, support: int) -> DataFrame:
    """(term): words whose mutual information with an entity reaches the share of the entity's information.

    Entities, terms and pairs are all counted in documents (rows). `some` holds id, hash and entities of the rows with
    any. A pair has at most as many documents as its entity, so entities below the support are left out before pairing.
    """
    named = materialise(some.select("_id", "_hash", F.explode("_entities").alias("entity"), "_n"), "entities")
    n_e = materialise(named.groupBy("entity").agg(F.sum("_n").alias("n_e")).filter(F.col("n_e") >= support), "entity_counts")
    often = named.join(n_e, "entity").groupBy("_id", "_hash").agg(F.collect_list("entity").alias("_entities"))
    met = rows.join(often, same(rows)).select("_entities", F.explode(words_of(F.col("_text"))).alias("term")).select("term", F.explode("_entities").alias("entity"))
    pairs = materialise(met.groupBy("entity", "term").agg(F.count("*").alias("n_te")).filter(F.col("n_te") >= support), "pairs")
    if pairs.isEmpty():  # no words to count
        return pairs.select("term")
    n_docs = rows.agg(F.count("*").alias("n_docs"))
    n_t = rows.select(F.explode(words_of(F.col("_text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    df = pairs.join(n_t.join(pairs.select("term").distinct(), "term"), "term").join(n_e, "entity").join(F.broadcast(n_docs))
    information = F.log(F.col("n_docs") / F.col("n_e"))
    mutual = F.log(F.col("n_te") * F.col("n_docs").cast("double") / (F.col("n_e").cast("double") * F.col("n_t")))
    return df.filter((information > 0) & (mutual >= share * information)).select("term").distinct()


def same(rows: DataFrame) -> Column:
    """Equal in id (null being an id) and text."""
    return rows["doc_id"].eqNullSafe(F.col("_id")) & (rows["text_hash"] == F.col("_hash"))


def term_spans(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(_id, _hash, _terms): the places of the terms in each row that holds any, once per id and text."""
    held = rows.select("doc_id", "text_hash", F.explode(words_of(F.col("_text"))).alias("term")).join(terms, "term")
    held = held.groupBy("doc_id", "text_hash").agg(F.collect_set("term").alias("_held"))
    held = held.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_held")
    df = rows.join(held, same(rows))
    df = matches(df, "_all", WORD)
    places = F.filter("_all", lambda s: F.array_contains("_held", F.lower(s["value"])))
    return df.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), places.alias("_terms")).dropDuplicates(["_id", "_hash"])


def all_spans(docs: DataFrame, *, share: float = 0.9, support: int = 3) -> DataFrame:
    """Per row: doc_id, text_hash, _text, the base kinds and `term`, each an array of spans in order.

    A disclosing term is a span wherever it occurs, but never overlaps base spans; rows equal in id and text get equal
    spans. Null ids are an id of their own.
    """
    spans = materialise(base_spans(docs).drop("_text"), "spans")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("_text"))
    some = spans.filter(F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0)
    some = some.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), entities(some).alias("_entities"))
    some = some.groupBy("_id", "_hash").agg(F.count("*").alias("_n"), F.first("_entities").alias("_entities"))
    terms = materialise(disclosing_terms(rows, some, share, support), "terms")
    found = term_spans(rows, terms)
    base = F.concat(*KINDS)
    free = F.filter(F.coalesce("_terms", F.array().cast(SPAN)), lambda t: ~F.exists(base, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return spans.join(found, same(spans), "left").select("doc_id", "text_hash", *KINDS, free.alias("term"))


def listed(kinds: tuple[str, ...]) -> Column:
    one = lambda k: F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(F.concat(*[one(k) for k in kinds]), ",")


def report(docs: DataFrame, **options: float) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, a digest of the base spans, and all spans as text."""
    df = all_spans(docs, **options)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return df.select("doc_id", *counts, F.sha2(listed(KINDS), 256).alias("base_sha256"), listed((*KINDS, "term")).alias("spans"), F.size("term").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, **options: float) -> DataFrame:
    """The rows and columns of documents; in `text`, base spans become [EMAIL], [IP], [CARD] or [PHONE] and disclosing
    terms [TERM]. Where base spans of two kinds overlap, the one that starts first (then the longer) stands for both.
    A null text stays null. Rows with spans are joined by id and text; other rows pass."""
    marks = [F.transform(k, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(f"[{k.upper()}]").alias("mark"))) for k in (*KINDS, "term")]
    df = all_spans(docs, **options)
    df = df.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.array_sort(F.concat(*marks)).alias("_marks"))
    df = df.filter(F.size("_marks") > 0).dropDuplicates(["_id", "_hash"])
    rows = docs.withColumn("_text_hash", F.xxhash64("text"))
    rows = rows.join(df, rows.doc_id.eqNullSafe(F.col("_id")) & (rows["_text_hash"] == F.col("_hash")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, m: F.when(m["start"] < a["at"], F.struct(F.greatest(a["at"], -m["back"]).alias("at"), a["out"].alias("out"))).otherwise(
        F.struct((-m["back"]).alias("at"), F.concat(a["out"], F.substring("text", a["at"] + 1, m["start"] - a["at"]), m["mark"]).alias("out"))
    )
    clean = F.aggregate("_marks", start, step, lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))))
    return rows.withColumn("_clean", F.when(F.col("_marks").isNull(), F.col("text")).otherwise(clean)).select(*[F.col("_clean").alias("text") if c == "text" else F.col(c) for c in docs.columns])
