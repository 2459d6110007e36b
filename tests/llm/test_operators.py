"""The training-data operators against plain versions on small texts with awkward cases."""

import bisect
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postboard.llm import bpe, html_tree, langid, linededup, packing, pii, quality, simhash, topk, toxicity
from postboard.llm.common import held_out

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, spans string"
WORDS = "alpha beta gamma delta the of and x1 42 naïve straße 日本 ét".split()


def texts(seed=1, n=40):
    rng = random.Random(seed)
    out = [None, "", "   \n\t ", "one", "A a A a", "<|endoftext|> x <|endoftext|>", "¡" * 3000, "w " * 20000]
    for _ in range(n):
        out.append("".join(rng.choice(WORDS) + rng.choice([" ", " ", "  ", "\n", ". ", " "]) for _ in range(rng.randint(1, 300))))
    return out + out[-6:] + [out[-1] + " more"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "k", "w", "p") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(texts()))
    return frame(spark, [*rows, rows[20], (None, "no id here"), (None, None)])


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_base(text):
    w = split(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g in grams if grams.count(g) > 1} if len(w) < 2000 else set(grams)
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(5)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts(spark, docs):
    extra = frame(spark, [(900, "a b c d e f a b c d e\nx\nx\n \n#$ a|b"), (901, "a a a a a a a")])
    rows = docs.union(extra).collect()
    got = quality.base_counts(docs.union(extra)).collect()
    plain = sorted((r.doc_id is None, r.doc_id or 0, *plain_base(r.text)) for r in rows)
    assert plain == sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_quality_ratio(spark, n):
    rng = random.Random(3)
    good = [(i, " ".join(rng.choice(["sun", "moon", "star", "sky", f"g{rng.randint(0, 30)}"]) for _ in range(60))) for i in range(60)]
    junk = [(100 + i, " ".join(f"z{rng.randint(0, 10**6)}#" for _ in range(60))) for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality_rules(frame(spark, good + junk + [(500, None)]), labels, n=n, digits=2).collect()}
    raw, trusted = np.zeros(256), np.zeros(256)
    grams = lambda t: [" ".join(split(t)[k : k + n]) for k in range(len(split(t)))]
    bucket = lambda g: int(hashlib.md5(g.encode()).hexdigest()[:2], 16)
    for i, t in good + junk:
        for g in grams(t):
            raw[bucket(g)] += 1
            trusted[bucket(g)] += i < 100
    weight = np.log((trusted + 1) / (trusted.sum() + 256)) - np.log((raw + 1) / (raw.sum() + 256))
    for i, t in good + junk:
        assert got[i].llr == pytest.approx(np.mean([weight[bucket(g)] for g in grams(t)]), abs=2e-6)
    if n == 1:
        assert all(got[i].kept or got[i].base_failed for i, _ in good) and not any(got[i].kept for i, _ in junk)
    assert got[500].base_failed and not got[500].kept and got[500].llr is None
    nothing = quality.quality_rules(frame(spark, good), labels.limit(0), n=n)
    assert {r.llr for r in nothing.collect()} == {0.0}
    assert quality.quality_rules(frame(spark, []), labels).count() == 0


def test_bpe_matches_library(spark, docs):
    tok = Tokenizer.from_file(PATH)
    plain = []
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        plain.append((str(r.doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(plain) == sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH).collect())
    assert {str(r.doc_id): r.decoded for r in bpe.encoded(docs.filter("doc_id < 20"), PATH).collect()} == {str(r.doc_id): r.text or "" for r in docs.filter("doc_id < 20").collect()}


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_bpe_any_text(text):
    tok = test_bpe_any_text.__dict__.setdefault("tok", Tokenizer.from_file(PATH))
    ids = tok.encode(text, add_special_tokens=False).ids
    assert bpe.loaded(PATH).encode(text) == ids
    assert packing.tokenizer(PATH)[0].encode_to_numpy(text, allowed_special="all").tolist() == ids
    assert bpe.loaded(PATH).decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_packing(spark, docs):
    tok, cap = Tokenizer.from_file(PATH), 64
    got = packing.packed(docs, PATH, capacity=cap).collect()
    plain = []
    for r in docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % cap or cap, len(ids) + 1, cap)]
        plain += [(str(r.doc_id), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(itertools.pairwise(cuts))]
    assert sorted(plain) == sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    assert len(by) <= best_fit_decreasing(Counter(r.length for r in got), cap)
    assert packing.packed(docs.limit(0), PATH).count() == 0


def test_packing_long_runs(spark):
    rows = [(0, " " * 400_000 + "x"), (1, "\n\t" * 400_000), (2, "y" * 400_000)]
    library, got = Tokenizer.from_file(PATH), {}
    for r in packing.packed(frame(spark, rows), PATH).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for i, t in rows:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert sorted(got[i]) == [(a, n, zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes())) for a, n, _ in sorted(got[i])]
        assert sum(n for _, n, _ in got[i]) == len(ids)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=30))
def test_packing_plan(counts):
    used = dict.fromkeys(counts, 0)
    patterns = packing.plan(counts, 41)
    for pattern, times in patterns:
        assert sum(pattern) <= 41 and times > 0
        for n in pattern:
            used[n] += times
    assert used == counts
    assert sum(t for _, t in patterns) <= best_fit_decreasing(counts, 41)


def best_fit_decreasing(counts, capacity):
    """Piece by piece."""
    rooms = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("draw", [lambda r: r.randint(1, 1023), lambda r: min(1023, 1 + int(r.expovariate(1 / 150))), lambda r: min(1023, 1 + int(r.lognormvariate(5.5, 1))), lambda r: r.randint(300, 700), lambda r: min(1023, max(1, int(r.gauss(400, 60))))])
def test_packing_few_sequences(draw):
    rng = random.Random(8)
    counts = Counter(draw(rng) for _ in range(20_000))
    n, total, large = sum(t for _, t in packing.plan(counts, 1024)), sum(k * v for k, v in counts.items()), sum(v for k, v in counts.items() if k > 512)
    assert max(-(-total // 1024), large) <= n <= best_fit_decreasing(counts, 1024)


def test_language(spark):
    rng = random.Random(5)
    parts = {"xx": ["ba", "be", "bi", "bo"], "yy": ["ka", "ke", "ki", "ko"], "zz": ["šu", "ša", "ši"]}
    rows = [(i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(30)), lang) for i, lang in enumerate(random.Random(1).choices(list(parts), k=300))]
    rows += [(1000, None, "xx"), (1001, "", None), (1002, "123 ...", "yy"), (1003, "baba", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert model.languages == ["xx", "yy", "zz"]
    assert all(got[i].lang_pred == lang and got[i].score > 0.6 for i, _, lang in rows[:300])
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert {got[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and got[1003].lang_pred == "xx"
    assert {r.lang_pred for r in langid.identify(df, langid.fit(df.limit(0))).collect()} == {"und"}
    for n in range(2, 9):  # any two codewords differ in several bits
        code = langid.codewords(n)
        assert min((a != b).sum() for a, b in itertools.combinations(code, 2)) >= (1 if n == 2 else 2)


def test_language_letters(spark):
    """Only letters make a text that has a language: no digits, numerals of other kinds, marks or symbols."""
    df = spark.createDataFrame([(0, "baba dada", "xx"), (2, "kiki titi", "yy"), (8, "kiki", "yy"), (9, "titi", "yy"), (3, "", "xx"), (5, "²½①Ⅷ ٣ 12 _ \u0301 😀", "xx"), (6, "ª", None), (7, "日", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, langid.fit(df)).collect()}
    assert [got[i].lang_pred == "und" for i in (0, 3, 5, 6, 7)] == [False, True, True, False, False] and got[5].score == 0.0
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df, most_languages=1)


def test_language_plain(spark):
    """Bit classifiers and decoding, trigram by trigram."""
    rng = random.Random(6)
    parts = {"aa": "la le li", "bb": "la lu ko", "cc": "zu zo la", "dd": "šu ko ze", "ee": "ba la zu"}
    rows = [(i, " ".join("".join(rng.choices(parts[lang].split(), k=2)) for _ in range(rng.randint(1, 12))), lang) for i, lang in enumerate(rng.choices([*parts], k=120))]
    grams = lambda t: [int.from_bytes(b[k : k + 3], "big") * 2654435761 % 2**32 >> 16 for b in [f" {t.lower()} ".encode()] for k in range(len(b) - 2)]
    names, code, counts = sorted(parts), langid.codewords(5).tolist(), {}
    known = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    for t, lang in known:
        counts.setdefault(lang, Counter()).update(grams(t))
    p = lambda lang, g: (counts[lang][g] + 0.5) / (counts[lang].total() + 0.5 * 65536)

    def margin(t, bit):
        sides = {s: [n for n, c in zip(names, code, strict=True) if c[bit] == s] for s in (1, -1)}
        odds = [math.log(np.mean([p(n, g) for n in sides[1]]) / np.mean([p(n, g) for n in sides[-1]])) for g in grams(t)]
        return sum(odds) / len(odds)

    bits = range(len(code[0]))
    trust = []
    for bit in bits:
        wrong = sum((margin(t, bit) > 0) != (code[names.index(lang)][bit] > 0) for t, lang in known)
        rate = (wrong + 1) / (len(known) + 2)
        trust.append(max(0.05, math.log((1 - rate) / rate)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, langid.fit(df)).collect()}
    for i, t, _ in rows[:40]:
        m = [margin(t, bit) for bit in bits]
        loss = [sum(w * math.log1p(math.exp(-4 * c * x)) for w, c, x in zip(trust, word, m, strict=True)) / sum(trust) for word in code]
        share = [math.exp(-2 * x) / sum(math.exp(-2 * y) for y in loss) for x in loss]
        assert got[i].lang_pred == names[int(np.argmax(share))] and got[i].score == pytest.approx(max(share), abs=1e-4)
        assert got[i].ambiguous == (sorted(share)[-1] - sorted(share)[-2] < 0.1)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def plain_spans(text):
    text, out = text or "", {}
    digits = lambda s: re.sub("[^0-9]", "", s)
    find = lambda p, ok: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(m[0])]
    out["email"] = find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True)
    out["ip"] = find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split(".")))
    out["card"] = find(r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)))
    out["phone"] = find(r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15)
    return out


def personal(seed, n):
    rng = random.Random(seed)
    cards = ["4785380592391131", "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111 1111  1111 1111", "5500005555555559000"]
    bits = ["a.b@c.de", "x@y", "a@b.c_d@e.f", "@", "1.2.3.4", "001.2.03.255", "256.1.1.1", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "+12", "+1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "word", "é日", "12 34-56", " ", "\n", "-", ".", "9"]
    return [(i, "".join(rng.choice(bits + cards) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def test_pii_base(spark, docs):
    df = frame(spark, personal(4, 300)).union(docs)
    got = pii.report(df).collect()
    plain = []
    for r in df.collect():
        s = plain_spans(r.text)
        base = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in s[k])
        plain.append((str(r.doc_id), *[len(s[k]) for k in pii.KINDS], hashlib.sha256(base.encode()).hexdigest()))
    assert sorted(plain) == sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got)
    for r in got:
        base = ",".join(x for x in r.spans.split(",") if not x.startswith("term"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
    assert pii.report(docs.limit(0)).count() == 0


def test_pii_very_long_runs(spark):
    """Runs that would take a deep stack, or time with the square of their length."""
    rows = [(0, "x a@b" + ".c" * 10_000 + " y"), (1, "a" * 100_000 + " a@b.c"), (2, "1" * 300_000), (3, "1." * 2_000 + "9"), (4, "+1" + "-2" * 100_000)]
    got = {r.doc_id: r for r in pii.report(frame(spark, rows)).collect()}
    assert [got[i].n_email for i in range(5)] == [1, 1, 0, 0, 0]
    assert [got[i].spans for i in (0, 1, 2)] == ["email:2:20005", "email:100001:100006", ""]
    assert [got[i].n_ip for i in (3, 4)] == [500, 0] and got[4].n_phone == 0


def test_pii_many_matches(spark):
    """Offsets of many matches, also beyond the parts in which they are summed."""
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice([f"u{k}@h.org", f"10.0.{k % 256}.7"]) + rng.choice([" ", " é ", "\n"]) for k in range(n))) for i, n in enumerate((255, 256, 257, 1000, 20_000))]
    got = {r.doc_id: r.spans for r in pii.report(frame(spark, rows)).collect()}
    for i, t in rows:
        s = plain_spans(t)
        assert got[i] == ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in s[k])


def test_pii_terms_and_sanitise(spark):
    rows = [(i, f"Notes {i}. The agent Zorblat wrote from z@q.org about item number{chr(97 + i)}.\nEnd") for i in range(5)]
    rows += [(10 + i, f"plain text {i} about the agent and item") for i in range(30)]
    df = frame(spark, rows + [(99, None), (98, "ip 1.2.3.4, 4111111111111111")])
    found = {r.doc_id: r.spans for r in pii.report(df).collect()}
    at = rows[0][1].index("Zorblat")
    assert f"term:{at}:{at + 7}" in found[0].split(",") and "term" not in found[10]
    assert "agent" not in [rows[0][1][int(x.split(":")[1]) : int(x.split(":")[2])] for x in found[0].split(",")]
    clean = {r.doc_id: r for r in pii.sanitise(df).collect()}
    assert "[TERM]" in clean[0].text and "[EMAIL]" in clean[0].text and "Zorblat" not in clean[0].text
    assert clean[98].text == "ip [IP], [CARD]" and clean[99].text is None and clean[12].text == rows[7][1] and clean[0].kept == "k"


def test_pii_terms_by_documents(spark):
    """Copies, a far name, a repeated signature line, a shared domain, and a document that has the name alone."""
    rows = [(i, "Quorvex met us. " + "so it goes on and on, " * 10 + "write to z@q.org") for i in range(20)]
    rows += [(100 + i, f"note {i} of one day\nregards, Brindlemax, p@r.net") for i in range(5)]
    rows += [(200 + i, f"Halvaric sent it, u{i}@firm.example") for i in range(5)]
    rows += [(300 + i, f"plain text {i}, with regards, so it goes to one firm, write us") for i in range(200)] + [(900, "we asked Quorvex and Halvaric"), (None, "Brindlemax")]
    texts = dict(rows)
    got = {r.doc_id: r.spans for r in pii.report(frame(spark, rows)).collect()}
    words = {i: {texts[i][int(a) : int(b)] for k, a, b in (x.split(":") for x in s.split(",") if x) if k == "term"} for i, s in got.items()}
    assert "Quorvex" in words[0] and "Brindlemax" in words[100] and "Halvaric" in words[200]
    assert words[900] == {"Quorvex", "Halvaric"} and words[None] == {"Brindlemax"} and not words[300]


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(400)]
    rows += [(100, [9.0] * 8), (500, None), (600, [float("nan")] * 8), (700, [1.0, None] * 4), (None, [1.0] * 8), (800, [1.0] * 3), (801, [2.0] * 3), (5, rows[5][1]), (900, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    plain = []
    for q, v in queries.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))[:10]
        plain += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(plain) == sorted(tuple(r) for r in topk.exact_top_k(df, block=64).collect())
    assert topk.exact_top_k(df.limit(0)).count() == 0
    big = spark.createDataFrame([(0, [16000.0] * 64), (1, [16000.0] * 64)], "vec_id long, embedding array<double>")
    assert topk.exact_top_k(big).first().score == 64 * (16000 * 1024) ** 2


def test_top_k_large(spark):
    """Every finite vector takes part, however large; ranks follow exact scores beyond 2**63."""
    rng = np.random.default_rng(2)
    sizes = [1.0, 3e4, 2e6, 1e12, 1e30, 3e38, 1e306]
    rows = [(i, [float(x) for x in rng.normal(size=4) * sizes[i % 7]]) for i in range(210)]
    rows += [(500 + i, [1e20, 1.0 + i, 0.0, 0.0]) for i in range(30)] + [(1000, [1e15, 1e6, 0.0, 0.0]), (1100, [2e4] * 4), (1200, [2e4] * 4)]
    exact = {i: [int(np.floor(x * 1024)) if abs(x) < 1e300 else int(x) * 1024 for x in v] for i, v in rows}
    plain = []
    for q in (i for i in exact if i % 100 == 0):
        top = sorted((-sum(a * b for a, b in zip(exact[q], w, strict=True)), i) for i, w in exact.items() if i != q)[:10]
        plain += [(q, r, i, max(min(-s, 2**63 - 1), 1 - 2**63)) for r, (s, i) in enumerate(top, 1)]
    for block in (16, 4096):
        got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block)
        assert sorted(plain) == sorted(map(tuple, got.collect()))


def plain_fingerprint(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = split(low)
    if not w:
        return 0
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, radius=4):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i][1] ^ prints[j][1]).count("1") <= radius:
            up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [least.get(root(i)) for i in range(len(prints))]


def test_simhash(spark, docs):
    rows = docs.collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    plain = sorted((str(i), f"{p:016x}", str(c)) for (i, p), c in zip(prints, plain_components(prints), strict=True))
    for cell_rows in (2048, 2):
        assert plain == sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs, cell_rows=cell_rows).collect())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("cell_rows", "agree"), [(100_000, 1), (60, 1), (100_000, 2), (20, 2)])
def test_simhash_links(spark, cell_rows, agree):
    """Clusters of prints with chains, on both the small and the tree path."""
    rng = random.Random(9)
    values = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 120])):
            values.add(x)
            for _ in range(rng.randint(1, 6)):
                x ^= 1 << rng.randrange(64)
    prints = [(i, v) for i, v in enumerate(sorted(values))]
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for _, v in prints], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, 4, cell_rows, agree)).collect()}
    groups, plain = {}, {}
    for (i, v), c in zip(prints, plain_components(prints), strict=True):
        signed = v - (1 << 64) if v >> 63 else v
        groups.setdefault(roots.get(signed, signed), set()).add(i)
        plain.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_vantage_tree_finds_all():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) for b in base]))
    for two in (False, True):
        tree, brute = simhash.Forest(len(fps)), simhash.Forest(len(fps))
        a = np.arange(len(fps))
        left, right = (a[::2], a[1::2]) if two else (a, None)
        simhash.search(fps, left, right, 3, tree, leaf=16)
        simhash.search(fps, left, right, 3, brute, leaf=10**6)
        assert [tree.root(i) for i in a] == [brute.root(i) for i in a]


def main_of(page, scores=None):
    return html_tree.chosen(html_tree.parsed(page, scores)).split("\n")


def test_html():
    page = """<!doctype html><html><head><title>T</title></head><body class=home><nav><a href=/>Home</a></nav><header>Site</header>
    <div class="ad-box">Buy</div><article class=post><header><h1>Big &amp; bold</h1></header><p>One <b>two<i> three</b>
      four&nbsp;&#233;<p>Five<br>six<!-- no --><script>var x = "</p>";</script><ul><li>a<li>b</ul><form>name <input></form>
    <section id="comments"><p>reader</p></section></article><aside>More</aside><footer>&copy;</footer>"""
    assert main_of(page) == ["Big & bold", "One two three four é", "Five six", "a", "b"]
    for broken in ("", "<", "<p", "a < b", "</p></div>text", "<script>never closed", "<p class='x>y</p>", "<b><p>x</b>y", "<svg><p>x", "<a =>", "<a/b=c'd>"):
        html_tree.parsed(broken)
    assert main_of("plain words") == ["plain words"]


def test_html_awkward_markup():
    assert main_of("<html><head><title>T</title><meta charset=x><body><p>One<p>Two") == ["One", "Two"]
    assert main_of("<head><style>x</style><p>No end of the head</p>") == ["No end of the head"]
    assert main_of("<head><link>text in it") == ["text in it"]
    assert main_of("<body class='home has-sidebar'><p title=don't>Odd quote</p><p title='a>b'>c</p>") == ["Odd quote", "c"]
    assert main_of('<article id="cookie-recipe"><p>Bake <a href=x>all of this</a></p><p>with <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p><p><a href=x>only a link</a></p></article>') == ["Bake all of this", "with x=2", "only a link"]
    assert main_of('<main><p>A</p><article class="comment"><p>me</p></article><div class="comment-list">you</div></main>') == ["A"]
    assert main_of("<p>kept</p><p><a href=x>mostly links</a></p><div class=menu>m</div><noscript>plain</noscript>") == ["kept"]
    for deep in ("<div>" * 40_000 + "x" + "</div>" * 40_000, "<b>" * 40_000 + "x", "<div><p>" * 20_000 + "x", "<b>" * 20_000 + "x</div>" * 20_000, "</div>" * 40_000 + "x"):
        began = time.time()
        assert "x" in main_of(deep)[0] and time.time() - began < 10


def site(n):
    """A site without telling names: a slogan, a menu of one layout with few texts, and stories."""
    rng = random.Random(n)
    story = lambda i: "".join(f"<p>Story {i} part {k} {rng.random()}</p>" + "<hr>" * rng.randint(0, 1) for k in range(rng.randint(1, 6)))
    menu = lambda i: f"<div class=x><ul><li>One {i % 7}</li><li>Two</li></ul></div>"
    return [(i, f"http://h.com/{i}", f"<body><div class=slogan>We sell things</div>{menu(i)}<div class=s>{story(i)}<div class=tail>The end</div></div><div class=x>Small print {i % 9}</div></body>") for i in range(n)]


PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(("inside", "text"), [
    ('<section id="related-work"><p>Earlier studies.</p></section>', "Earlier studies."), ('<section class="social-history">Of the town.</section>', "Of the town."), ('<p class="ad-hoc">A committee.</p>', "A committee."),
    ('<div class="nav-theory">Ships.</div>', "Ships."), ('<div class="ad-slot">Buy!</div>', ""), ('<div class="comment-list">first!</div>', ""), ('<div id="relatedPosts">More</div>', ""), ('<div class="ad2">Buy!</div>', ""),
    ("<noscript>Please enable JavaScript</noscript>", ""), ("<p hidden>x</p>", ""), ('<p aria-hidden="true">x</p>', ""), ('<div style="color: red; display : none">x<p>y</p></div>', ""), ("<p>a <span hidden>not </span>shown</p>", "a shown"),
    ('<p class="hidden-gem">x</p>', "x"), ('<p title="display:none">x</p>', "x"), ('<p aria-hidden="false">x</p>', "x"), ('<p hidden="until-found">x</p>', "x"),
])
@pytest.mark.parametrize("around", ["<article><p>One.</p>{}<p>Two.</p></article>", "<body><p>One.</p>{}<p>Two.</p>"])
def test_html_names_and_hidden(inside, text, around):
    """On a page of an unknown site, only whole names cut, and what is not shown is not text."""
    got = html_tree.chosen(html_tree.parsed(around.format(inside)))
    assert got == "\n".join(x for x in ("One.", text, "Two.") if x)


def test_html_responses():
    page = '<p>Main text of a page.</p><div class="responses"><p>I agree!</p></div>'
    assert html_tree.chosen(html_tree.parsed(page)) == "Main text of a page."


def test_html_style_tree(spark):
    rows = [(i, f"http://h.com/{i}", f"<body><div class=slogan>We sell things</div><div class=text><p>Story {i}</p><p>More {i}</p></div></body>") for i in range(8)]
    rows += [(100 + i, "http://one.com/", "<body><p>Same</p></body>") for i in range(9)] + [(200, None, None), (201, "no url", "<p>x</p>"), (None, "http://n.org", "<p>y</p>")]
    df = spark.createDataFrame([(*r, "more") for r in rows], PAGES + ", scores string")
    got = {r.page_id: r for r in html_tree.main_text(df).collect()}
    assert got[3].text == "Story 3\nMore 3" and got[3].n_chars == 14 and len(got) == len({r[0] for r in rows})
    assert got[104].text == "Same" and got[200].text == "" and got[200].url is None and got[201].text == "x" and got[None].text == "y"
    assert html_tree.main_text(df.limit(0)).count() == 0


def test_html_planted_boilerplate(spark):
    """Nothing but the tree can tell; without it the boilerplate stays."""
    df = spark.createDataFrame(site(60), PAGES)
    got, off = ({r.page_id: r.text for r in html_tree.main_text(df, use_tree=x).collect()} for x in (True, False))
    for i, _, page in site(60):
        assert got[i].split("\n") == re.findall(r"Story[^<]*", page)
        assert {"We sell things", "The end", f"One {i % 7}", f"Small print {i % 9}"} <= {*off[i].split("\n")}


def test_html_entropies(spark):
    """The merged tree against plain counts over the distinct pages."""
    rows = site(30) + [(900 + i, "http://h.com/x", site(30)[0][2]) for i in range(5)] + [(950, "http://two.com", "<p>a</p>"), (951, "http://two.com", "<p>b</p><p>c</p>")]
    tree = html_tree.style_tree(html_tree.nodes_of(html_tree.keyed(spark.createDataFrame(rows, PAGES))))
    counts, pages = {}, {}
    for _, url, page in rows:
        p = html_tree.parsed(page)
        pages.setdefault((url.split("/")[2], p.digest), p)
    for (host, _), p in pages.items():
        for path, digests in p.nodes.items():
            for k, x in enumerate(digests):
                counts.setdefault((host, path - 2**63), [Counter(), Counter(), Counter()])[k][x] += 1
    entropy = lambda c: -sum(n / c.total() * math.log(n / c.total()) for n in c.values())
    plain = {key: (c[2].total(), entropy(c[2]) / math.log(c[2].total()) if c[2].total() > 1 else 1.0, 1 - math.exp(-entropy(c[1])), 1 - math.exp(-entropy(c[0]))) for key, c in counts.items()}
    got = {(r.host, r.path): (r.pages, r.contents, r.branch, r.layout) for r in tree.collect()}
    assert {*got} == {*plain} and all(got[k] == pytest.approx(plain[k], abs=1e-9) for k in got)


def test_toxicity(spark):
    rng = random.Random(2)
    w = lambda n: [f"{a}{b}" for a, b in zip(rng.choices("ab cd ef gh kl mn".split(), k=n), rng.choices("ou ai ei au".split(), k=n), strict=True)]
    rows, labels = [], []
    for i in range(400):
        words, toxic, insult = w(30), i % 5 == 0, rng.choice(["grobian", "snorkol", "snorkel", "snorkat", "snorkut"])
        if toxic:
            at = rng.randrange(30)
            words[at : at + 1] = rng.choice(["you are a {}", "the man is a {}", "{} you", "{} ab {}"]).format(insult, insult).split()
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    df, marks = frame(spark, rows + [(900, None), (901, ""), (902, "you snorkixxx"), (903, "a snorkixxx here")]), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    grammar = toxicity.fit(df, marks)
    got = {r.doc_id: r for r in toxicity.score(df, grammar).collect()}
    assert all(got[i].predicted == t for i, t in labels) and got[902].predicted == 1 and got[903].predicted == 0
    assert got[900].score == got[901].score < 0.1
    assert {r.doc_id for r in toxicity.reject_toxic(df, grammar).collect()} == {i for i, t in labels if not t} | {900, 901, 903}
    none = toxicity.fit(df, marks.limit(0))
    assert none.score("I will kill you") >= 0.7 and none.score("they kill time") < 0.7 and none.score("nice day") < 0.1
    assert none.score("kill the lights. you see") < 0.1  # threat and target in different clauses


def test_toxicity_order_and_reach():
    g = toxicity.Grammar({"idiot": 1.0})
    pattern = lambda text: [p for p, _ in g.clauses(text)]
    assert pattern("You are an idiot") == ["TI"] and pattern("Idiot, not you") == ["I"] and pattern("idiot, you") == ["IT"]
    assert pattern("You are not an idiot") == ["Ti"] and pattern("Not now, you are an idiot") == ["TI"] and pattern("Du bist kein idiot") == ["Ti"]
    assert pattern("He said you are an idiot") == ["TJ"] and pattern("You are an idiot, he said") == ["TI"] and pattern("She wrote: you idiot") == ["TJ"]
    assert pattern("I will kill you.") == ["HT"] and pattern("I will never kill you") == ["hT"] and pattern("kill time. you") == [] and pattern("you one two three four five six seven idiot") == ["I"]
    plain, negated, reported, alone = (g.score(x) for x in ("you are an idiot", "you are not an idiot", "he said you are an idiot", "one idiot"))
    assert negated < reported < alone < plain and plain >= 0.7 > alone
    assert pattern("the boss is a very idiot") == ["CI"] and pattern("is he there an idiot") == ["TI"] and pattern("idiot and so on to the last idiot") == ["II"] and pattern("what an idiot!") == ["I!"] and pattern("idiot in time!") == ["I"]
    assert pattern("the paper said: no idiot, not an idiot") == ["jj"] and pattern("the boss is not an idiot") == ["i"]
    counts = {p: (1000, 1000) for p in toxicity.PATTERNS}
    learned = toxicity.learned_patterns(counts, 5.0)
    assert learned["Ti"] < learned["TI"] and learned["TJ"] < learned["TI"] and learned["j"] < learned["i"] < learned["I"] < 0.7 < min(learned[p] for p in toxicity.PRIORS if p != "I")


def test_toxicity_no_word_alone(spark):
    """Whatever the labels say, no text is rejected for one insult without a clause around it."""
    rows = [(i, f"{a} grobian {b}." if i % 2 else f"{a} {b} and so on.") for i, (a, b) in enumerate(itertools.product([f"x{k}" for k in range(30)], ["y", "z"]))]
    g = toxicity.fit(frame(spark, rows), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int"))
    scores = {t: g.score(t) for t in ("the word grobian is in a dictionary", "grobian", "you are a grobian", "he said: you are a grobian", "he said \"you are a grobian\"", "the boss is a grobian", "one grobian. Another grobian.", "grobian!", "not a grobian. never a grobian.")}
    assert g.lexicon and [s >= 0.7 for s in scores.values()] == [False, False, True, False, False, True, True, True, False]


def all_paths(arcs):
    """Every path through the three machines one after the other, none composed: pattern and weight of each."""
    marked, q, r = [], (0,), (0,)
    for x, w in arcs:
        (q, x), = toxicity.negation(q, x)
        (r, x), = toxicity.report(r, x)
        marked.append((x, w))

    def walk(state, k, weight):
        if k == len(marked):
            return [(state[1], weight)] if state[0] == "end" else []
        x, w = marked[k]
        return [y for after, out in toxicity.clause(state, x) for y in walk(after, k + 1, weight * w if out == "weight" else weight)]

    return walk(("start",), 0, 1.0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("OFTNRIIHTCV"), st.sampled_from([0.25, 0.5, 1.0])), max_size=9))
def test_toxicity_composition(arcs):
    """Best weights of the composed machine, against all paths."""
    arcs = [(x, w if x in "IH" else 1.0) for x, w in arcs]
    plain = {}
    for pattern, weight in all_paths(arcs):
        plain[pattern] = max(weight, plain.get(pattern, 0.0))
    assert toxicity.Grammar({}).found(arcs) == plain


def test_held_out(spark):
    got = spark.range(100).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


def plain_units(text):
    """Sentences and lines by a pattern that keeps what ends them, then the words of long ones, letter by letter."""
    parts = re.split(r"((?:[.!?]+[ \t]+|\n+))", text)
    sentences, held = [], ""
    for body, end in zip(parts[::2], [*parts[1::2], ""], strict=True):
        held += body + end
        if split(held):
            sentences.append(held)
            held = ""
    out, at = [], 0
    for s in sentences:
        chunks = [""]
        tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", s)
        for k, token in enumerate(tokens):
            chunks[-1] += token
            w = token.strip(" \t\n\v\f\r").lower().encode()
            if len(tokens) > 24 and (w[0] + 31 * w[-1] + 7 * len(w)) % 8 == 0 and k < len(tokens) - 1:
                chunks.append("")
        for c in chunks:
            out.append((at, at + len(c), " ".join(split(c.lower()))))
            at += len(c)
    return out


def plain_dedup(rows, least):
    """{(has id, id, hash, text): (clean text, spans)}, unit by unit in order of rank."""
    seen, out = set(), {}
    for key in sorted({(i is not None, i or 0, h, t) for i, h, t in rows if t is not None}):
        spans, run, clean, last = [], [], "", 0
        for a, b, norm in [*plain_units(key[3]), (0, 0, None)]:
            if norm is not None and norm in seen:
                run.append((a, b, len(split(norm))))
                continue
            if sum(n for *_, n in run) >= least:
                spans.append((run[0][0], run[-1][1]))
            run = []
            seen.add(norm)
        for a, b in spans:
            clean, last = clean + key[3][last:a], b
        out[key] = clean + key[3][last:], spans
    return out


def test_line_dedup(spark, docs):
    rng = random.Random(12)
    long = [" ".join(rng.choices([*WORDS, "and", "A", "of"], k=70)) for _ in range(4)]
    extra = [(500 + i, f"Own words {i} of it. " + rng.choice(long)[rng.randint(0, 40) :] + rng.choice(["", ".\n", "! "]) + f"more {i} " * 3) for i in range(30)]
    docs = docs.union(frame(spark, extra))
    rows = [(r.doc_id, r.h, r.text) for r in docs.withColumn("h", F.xxhash64("text")).select("doc_id", "h", "text").collect()]
    plain = plain_dedup(rows, 8)
    want = []
    for i, h, t in rows:
        clean, spans = plain[(i is not None, i or 0, h, t)] if t is not None else (None, [])
        want.append((str(i), str(clean), ",".join(f"{a}:{b}" for a, b in spans), len(spans), sum(b - a for a, b in spans)))
    got = linededup.remove_repeats(docs, least_words=8).collect()
    assert sorted(want) == sorted((str(r.doc_id), str(r.text), r.removed, r.n_removed, r.n_removed_chars) for r in got)
    assert linededup.remove_repeats(docs.limit(0)).count() == 0
    found = linededup.digests(docs)
    every = [sorted(map(str, linededup.later_units(found, n).collect())) for n in (1, 1000, 10**9)]  # none hot, some hot, all hot
    assert every[0] == every[1] == every[2]


def test_line_dedup_passage(spark):
    passage = " ".join(f"w{i}" for i in range(60)) + "."
    df = frame(spark, [(1, f"Start one.\n{passage}\nEnd one."), (2, f"Start two. {passage} End two."), (3, "Short line.\nOther"), (4, "Short line.\nElse"), (5, f"Five begins {passage[:-1]} and goes on")])
    got = {r.doc_id: r for r in linededup.remove_repeats(df).collect()}
    assert got[1].n_removed == 0 and passage not in got[2].text and got[2].text == "Start two. End two."
    a, b = map(int, got[2].removed.split(":"))
    assert f"Start two. {passage} End two."[a:b].strip() == passage and got[4].n_removed == 0
    assert got[5].n_removed == 1 and len(split(got[5].text)) < 30  # inside a sentence, though its ends differ


@given(st.text(alphabet="abcdé日 .!?\n\t", max_size=80) | st.lists(st.text(alphabet="abcdeé.", min_size=1, max_size=4), min_size=20, max_size=60).map("  ".join))
def test_units_cover(text):
    found, norms = linededup.units(text), [n.decode() for n in linededup.normalised(text)]
    assert all(a < b for a, b, _ in found) and all(x[1] <= y[0] for x, y in itertools.pairwise(found))
    assert " ".join(norms).split() == text.lower().split()
    assert [(a, b, n) for (a, b, _), n in zip(found, norms, strict=True)] == plain_units(text)
    assert [k for *_, k in found] == [len(split(n)) for n in norms]
