"""Prefix trie, source mix and centroid clustering against plain versions, with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from postboard.llm import clustering, mixing, prefix_trie

TURNS = "conv_id long, turn long, role string, text string, depth string, sid string, digest string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def plain_nodes(rows):
    convs, members = rebuilt(rows), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += not kids[k]
    ends = lambda k, m: hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(k)).encode()).hexdigest()
    return {(m[0], len(k), members[k[:-1]][0] if k else None, len(m), kids[k], leaves[k], saved[k], ends(k, m)) for k, m in members.items()}


def conversations(kind):
    rng = random.Random(kind)
    if kind == "few texts":
        return [(c, t, rng.choice("ab"), rng.choice(["x", "yé", None])) for c in range(40) for t in range(rng.choice([1, 3, 9, 20, 40]))]
    if kind == "copies":
        return [(c, t, "a", "x" * (c % 2)) for c in range(80) for t in range(rng.choice([1, 2, 9, 9, 33]))]
    rows = [(c, t if t else None, rng.choice(["u", None]), rng.choice(["", "b", "c d", None])) for c in (-7, -5, -4, 0, 3, 10, 2**60) for t in range(rng.choice([1, 12]))]
    return [*rows, rows[-1], rows[-1], (None, 1, "a", "no conversation"), (77, None, None, None)]


@pytest.mark.parametrize("kind", ["few texts", "copies", "odd rows"])
def test_trie(spark, monkeypatch, kind):
    """Segments of 4 turns, so that prefixes are scanned in three levels."""
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    rows = conversations(kind)
    df = spark.createDataFrame([(*r, "d", "s", "g") for r in rows], TURNS)
    got = [tuple(r) for r in prefix_trie.shared_prefixes(df).select(*NODE).collect()]
    assert len(got) == len({*got}) and {*got} == plain_nodes(rows)


def test_trie_without_rows(spark):
    df = spark.createDataFrame([(None, 1, "a", "b", "", "", "")], TURNS)
    for some in (df, df.limit(0)):
        out = prefix_trie.shared_prefixes(some)
        assert out.columns == NODE and out.count() == 0


def test_exits_by_fat_search(spark):
    """Each string leaves a finished trie where the longest prefix that it shares with any string of the trie ends."""
    rng = random.Random(4)
    strings = [[rng.choice("ab") for _ in range(rng.randint(1, 30))] for _ in range(120)]
    distinct = [*{tuple(s) for s in strings}]
    rows = [(i, d, bytes(zlib.crc32(str(s[:d]).encode()).to_bytes(16, "big")), 1, d) for i, s in enumerate(distinct) for d in range(1, len(s) + 1)]
    prefixes = spark.createDataFrame(rows, "sid long, d long, digest binary, bytes long, upto long").cache()
    every = spark.createDataFrame([(i, len(s), 1) for i, s in enumerate(distinct)], "sid long, n long, copies long")
    known = [i for i in range(len(distinct)) if i % 3]
    placed = prefix_trie.union(prefix_trie.insert(None, every.filter("sid % 3 > 0"), prefixes, 30))
    shared = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    got = {r.sid: r.x for r in prefix_trie.locate(placed, every.filter("sid % 3 = 0"), prefixes, 30).collect()}
    assert got == {i: max(shared(s, distinct[j]) for j in known) for i, s in enumerate(distinct) if i % 3 == 0}


DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, target string, mark string"
WEIGHTS = (5, 2, 1)


def documents(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 5, 30, 200]))), rng.choice(["s1", "s2", "é", "z", "", "\U0001f600", "￿", None])) for i in range(150)]
    rows += [(200, "word\t" * 3000, "s1"), (201, None, "z"), (202, "a b \x1f c\x0bd", "only"), (None, "x y z", None), (203, None, "silent"), rows[3], rows[3]]
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", "z") for i, t, s in rows], DOCS)


def plain_targets(sizes, percent=150, most=2):
    """Share by weight; cut what is above; share the excess among the others; and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    rest, full = Fraction(percent * sum(sizes.values()), 100), set()
    while True:
        left = [s for s in order if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] > most * sizes[s]}
        if not above:
            return {s: float(share[s]) if s in share else float(most * sizes[s]) for s in order}
        full |= above
        rest = Fraction(percent * sum(sizes.values()), 100) - sum(most * sizes[s] for s in full)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_mix(spark, block):
    df = documents(spark)
    got = mixing.mix(df, block=block).collect()
    sizes = defaultdict(int)
    for r in df.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = plain_targets(sizes)
    assert len(got) == df.count() and sorted((str(r.doc_id) for r in got)) == sorted(str(r.doc_id) for r in df.collect())
    of = {r.doc_id: r.source for r in df.collect()}
    taken = defaultdict(int)
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size and (r.first_slot is None) == (r.taken == 0)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixing.mix(df.repartition(5), block=block).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_without_words(spark):
    df = documents(spark)
    assert mixing.mix(df.limit(0)).count() == 0
    silent = mixing.mix(df.withColumn("text", F.lit(" "))).collect()
    assert len(silent) == df.count() and all(r.taken == 0 == r.target and r.first_slot is None for r in silent)


def test_schedule_is_even(spark):
    """After any number of slots, each source has had its share of them, but for a few."""
    sources = spark.createDataFrame([(k, 1000 * n, float(m)) for k, (n, m) in enumerate([(50, 90_000), (3, 6000), (70, 20_000), (1, 1500)])], "source_no long, source_size long, target double")
    rows = sorted((r.slot, r.source_no) for r in mixing.schedule(sources, 100).collect())
    need = {0: 900, 1: 60, 2: 200, 3: 15}
    assert len({s for s, _ in rows}) == len(rows) == sum(need.values())
    had = dict.fromkeys(need, 0)
    for n, (_, k) in enumerate(rows, 1):
        had[k] += 1
        assert all(abs(had[s] - need[s] * n / len(rows)) < 6 for s in need)


def test_bits(spark):
    k, low, high = 7, 13, 101
    back = lambda j: int(format(j, f"0{k}b")[::-1], 2)
    long = lambda x: F.lit(x).cast("long")
    for r in spark.range(1 << k).select("id", mixing.reversed_bits(F.col("id"), k).alias("r"), mixing.earlier(F.col("id"), long(low), long(high), k).alias("e")).collect():
        assert r.r == back(r.id) and r.e == sum(back(j) < back(r.id) for j in range(low, high))


VECTORS = "vec_id long, embedding array<double>, label int, cluster string, distance string"


def plain_clusters(rows, k, dims, rounds=5, scale=256):
    good = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [int(Fraction(x) * scale // 1) for x in v]) for i, v in good]
    mark = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "")
    middle = [v for _, v in sorted(whole, key=lambda r: (mark(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), n) for n, c in enumerate(middle))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in whole:
            groups[near(v)[1]].append(v)
        middle = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(middle)]
    found = [(i, *near(v)[::-1]) for i, v in whole]
    each = defaultdict(int)
    for _, c, d in found:
        each[c] += d
    top, marks = 2**63 - 1, [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, c, min(d, top), min(each[c], top), min(sum(each.values()), top), marks[c]) for i, c, d in found), key=str)


@pytest.mark.parametrize(("kind", "k"), [("plain", 5), ("ties", 4), ("large", 4), ("outlier", 6), ("few", 9)])
def test_clusters(spark, kind, k):
    rng = random.Random(kind)
    draw = {"plain": lambda: rng.uniform(-1, 1), "ties": lambda: float(rng.randint(-1, 1)), "large": lambda: rng.choice([1e300, -1e20, 3.5, 2.0**53 + 2, 1e-300]), "outlier": lambda: rng.uniform(-1, 1), "few": lambda: rng.uniform(-9, 9)}[kind]
    rows = [(i, [draw() for _ in range(3)]) for i in range(6 if kind == "few" else 200)]
    if kind == "outlier":
        rows += [(i, [1e30 * i, 0.0, -1e9]) for i in range(300, 304)]
    rows += [rows[0], rows[0], (None, rows[1][1]), (900, None), (901, [1.0, None, 2.0]), (902, [1.0, math.nan, 2.0]), (903, [1.0, math.inf, 2.0]), (904, [1.0]), (905, []), (906, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, "c", "d") for i, v in rows], VECTORS).repartition(3)
    got = clustering.cluster(df, k=k, dims=3, block=64)
    assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, k, 3)


def test_clusters_without_vectors(spark):
    df = spark.createDataFrame([(1, None, 1, "", ""), (2, [1.0], 1, "", "")], VECTORS)
    assert clustering.cluster(df).count() == 0 and clustering.cluster(df.limit(0)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
