"""The training-data operators as queries over the tables of a folder, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postboard.llm import bpe, clustering, html_tree, langid, linededup, mixing, packing, pii, prefix_trie, quality, simhash, topk, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4, width=4)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.main_text(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = linededup.remove_repeats(table(spark, sf_dir, "documents"))
    return df.select("doc_id", "removed", "n_removed", "n_removed_chars", "text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("first_slot")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, dims=64, scale=256, rounds=5, seed=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_best_fit_packing, op3_language_id, op4_pii, op5_bpe, op6_exact_top_k, op7_simhash, op8_html_extraction, op9_toxicity, op10_substring_dedup,
        op11_prefix_trie, op12_source_mix, op13_centroid_clustering,
    )
}

SPACE = r"[\x20\x09-\x0D]"


def spans_sql(kind: str, pattern: str, good: str) -> str:
    """Leftmost matches with offsets: each is put between marks, and the marks do not count."""
    return f"""{kind}_marked AS (SELECT rid, string_split(regexp_replace(t, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p FROM docs),
        {kind}_parts AS (SELECT rid, unnest(p) AS s, generate_subscripts(p, 1) AS k FROM {kind}_marked),
        {kind}_placed AS (SELECT rid, k, split_part(s, chr(2), 1) AS v, coalesce(sum(length(s) - CAST(k > 1 AS INT)) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM {kind}_parts),
        {kind}s AS (SELECT rid, '{kind}' AS kind, v, CAST(a AS BIGINT) AS a, CAST(a + length(v) AS BIGINT) AS b FROM {kind}_placed WHERE k > 1 AND {good})"""


DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
LUHN = f"""list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({DIGITS})[i] AS INT)
          ELSE (CAST(reverse({DIGITS})[i] AS INT) * 2) % 10 + CAST(reverse({DIGITS})[i] AS INT) // 5 END)) % 10 = 0"""



def nearest_sql(k: int) -> str:
    return f"""near{k} AS (
          SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)).c AS c, min(d) AS d FROM (
            SELECT rid, vec_id, v.v, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM (SELECT *, row_number() OVER () AS rid FROM v) v, c{k} c) GROUP BY rid)"""


def round_sql(k: int) -> str:
    """Assign to the centroids c{k} and make c{k + 1}: exact floors of means."""
    return f"""{nearest_sql(k)},
        m{k} AS (SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{k}) GROUP BY c, i) GROUP BY c),
        c{k + 1} AS (SELECT c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} USING (c)),
        """


SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '{SPACE}+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
        base AS (
          SELECT rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines FROM w),
        windows AS (SELECT rid, k, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS k FROM w)),
        twice AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
        covered AS (SELECT rid, count(DISTINCT k + i) AS n FROM twice, (SELECT unnest(range(5)) AS i) GROUP BY rid),
        trusted AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 20000),
        grams AS (SELECT rid, doc_id, left(md5(unnest(w)), 4) AS bucket FROM w),
        counts AS (SELECT bucket, count(*) AS raw, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM trusted)) AS good FROM grams GROUP BY bucket),
        weights AS (
          SELECT bucket, CASE WHEN (SELECT sum(good) FROM counts) > 0 THEN ln((good + 1.0::DOUBLE) / ((SELECT sum(good) FROM counts) + 65536) / ((raw + 1.0::DOUBLE) / ((SELECT sum(raw) FROM counts) + 65536))) ELSE 0.0 END AS weight FROM counts),
        scores AS (SELECT rid, round(avg(weight), 6) AS llr FROM grams JOIN weights USING (bucket) GROUP BY rid),
        judged AS (SELECT *, coalesce(n, 0) AS n_repeat_words, n_words < 10 OR 100 * coalesce(n, 0) > 20 * n_words AS base_failed FROM base LEFT JOIN covered USING (rid) LEFT JOIN scores USING (rid))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(llr >= -0.35, false) AS kept, llr FROM judged
    """,
    "op4_pii": rf"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        {spans_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")},
        {spans_sql("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(v, '.'), lambda x: CAST(x AS HUGEINT) > 255)) = 0")},
        {spans_sql("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({DIGITS}) BETWEEN 16 AND 19 AND {LUHN}")},
        {spans_sql("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) BETWEEN 8 AND 15")},
        base AS (SELECT *, CASE kind WHEN 'email' THEN 0 WHEN 'ip' THEN 1 WHEN 'card' THEN 2 ELSE 3 END AS nr FROM (SELECT rid, kind, v, a, b FROM emails UNION ALL SELECT rid, kind, v, a, b FROM ips UNION ALL SELECT rid, kind, v, a, b FROM cards UNION ALL SELECT rid, kind, v, a, b FROM phones)),
        entity AS (
          SELECT DISTINCT rid, unnest(CASE kind WHEN 'email' THEN ['email:' || lower(v), 'email group:' || regexp_extract(lower(v), '[^@]*$')]
            WHEN 'ip' THEN ['ip:' || v, 'ip group:' || regexp_extract(v, '^[0-9]+\.[0-9]+\.[0-9]+')] WHEN 'card' THEN ['card:' || {DIGITS}, 'card group:' || left({DIGITS}, 6)]
            ELSE ['phone:' || {DIGITS}, 'phone group:' || left({DIGITS}, length({DIGITS}) - 4)] END) AS e FROM base),
        n_e AS (SELECT e, count(*) AS n_e FROM entity GROUP BY e HAVING count(*) >= 3),
        free AS (SELECT rid, regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', ' ', 'g') AS t FROM docs),
        word AS (SELECT rid, unnest(list_distinct(list_transform(regexp_extract_all(t, '\p{{L}}{{4,}}'), lambda x: lower(x)))) AS w FROM free),
        n_w AS (SELECT w, count(*) AS n_w FROM word GROUP BY w),
        pair AS (SELECT e, w, count(*) AS n FROM entity JOIN n_e USING (e) JOIN word USING (rid) GROUP BY e, w HAVING count(*) >= 3),
        term AS (
          SELECT DISTINCT w FROM pair JOIN n_e USING (e) JOIN n_w USING (w), (SELECT count(*) AS n_docs FROM docs)
          WHERE n_docs > n_e AND ln(n * n_docs::DOUBLE / (n_e::DOUBLE * n_w)) >= 0.9 * ln(n_docs::DOUBLE / n_e)),
        {spans_sql("term", r"\p{L}{4,}", "lower(v) IN (SELECT w FROM term)")},
        held AS (SELECT t.* FROM terms t JOIN word ON word.rid = t.rid AND word.w = lower(v)),
        clear AS (SELECT rid, kind, v, a, b, 4 AS nr FROM held h WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = h.rid AND base.a < h.b AND h.a < base.b)),
        spans AS (
          SELECT rid, count(*) FILTER (WHERE nr = 0) AS n_email, count(*) FILTER (WHERE nr = 1) AS n_ip, count(*) FILTER (WHERE nr = 2) AS n_card, count(*) FILTER (WHERE nr = 3) AS n_phone, count(*) FILTER (WHERE nr = 4) AS n_term,
            string_agg(kind || ':' || a || ':' || b, ',' ORDER BY nr, a) FILTER (WHERE nr < 4) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY nr, a) AS spans
          FROM (SELECT rid, kind, a, b, nr FROM base UNION ALL SELECT rid, kind, a, b, nr FROM clear) GROUP BY rid)
        SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, coalesce(n_term, 0) AS n_term,
          sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN spans USING (rid)
    """,
    "op6_exact_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10
    """,
    "op10_substring_dedup": r"""
        WITH docs AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
        cut AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?]+[ \t]+|\n+)', '\1' || chr(1), 'g'), chr(1)) AS p FROM docs),
        pieces AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM cut),
        grouped AS (  -- a piece without a word belongs to the next one that has a word
          SELECT *, coalesce(sum(CAST(regexp_matches(piece, '[^\x20\x09-\x0D]') AS INT)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM pieces),
        sentences AS (SELECT doc_id, g, string_agg(piece, '' ORDER BY k) AS s FROM grouped GROUP BY doc_id, g),
        tokens AS (SELECT doc_id, g, regexp_extract_all(s, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS t FROM sentences WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
        words AS (SELECT doc_id, g, len(t) AS n, unnest(t) AS token, generate_subscripts(t, 1) AS k FROM tokens),
        plain AS (SELECT *, lower(regexp_replace(token, '[\x20\x09-\x0D]+', '', 'g')) AS w FROM words),
        parts AS (
          SELECT *, coalesce(sum(CAST(n > 24 AND (CAST('0x' || left(hex(encode(w)), 2) AS INT) + 31 * CAST('0x' || right(hex(encode(w)), 2) AS INT) + 7 * octet_length(encode(w))) % 8 = 0 AS INT)) OVER (PARTITION BY doc_id, g ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM plain),
        units AS (
          SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g, part) AS unit, string_agg(w, ' ' ORDER BY k) AS norm, string_agg(token, '' ORDER BY k) AS s, count(*) AS words
          FROM parts GROUP BY doc_id, g, part),
        placed AS (
          SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY doc_id ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
            row_number() OVER (PARTITION BY norm ORDER BY doc_id, unit) > 1 AS repeated FROM units),
        islands AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id, repeated ORDER BY unit) AS island FROM placed),
        judged AS (SELECT *, repeated AND sum(words) OVER (PARTITION BY doc_id, repeated, island) >= 20 AS gone FROM islands),
        runs AS (SELECT doc_id, min(start) AS a, max(start + length(s)) AS b FROM judged WHERE gone GROUP BY doc_id, island),
        spans AS (SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS removed, count(*) AS n, sum(b - a) AS chars FROM runs GROUP BY doc_id),
        kept AS (SELECT doc_id, coalesce(string_agg(s, '' ORDER BY unit) FILTER (WHERE NOT gone), '') AS head, sum(length(s)) AS used FROM judged GROUP BY doc_id)
        SELECT d.doc_id, coalesce(removed, '') AS removed, coalesce(n, 0) AS n_removed, CAST(coalesce(chars, 0) AS BIGINT) AS n_removed_chars,
          CASE WHEN used IS NULL THEN d.text ELSE head || substr(d.text, CAST(used AS BIGINT) + 1) END AS text
        FROM documents d LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op11_prefix_trie": """
        WITH t AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
          FROM conversations WHERE conv_id IS NOT NULL),
        s AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS codes FROM t GROUP BY conv_id),
        hs AS (  -- CRC-32 byte by byte and bit by bit
          SELECT conv_id, n, base, xor(list_reduce([4294967295] || codes, lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 9 AS h FROM s),
        conv AS (SELECT a.conv_id, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS lead FROM hs a LEFT JOIN hs b ON b.conv_id = a.base),
        turns AS (
          SELECT c.conv_id, t.k AS d, role, text FROM conv c JOIN t ON t.conv_id = c.base AND t.k <= c.lead
          UNION ALL SELECT c.conv_id, c.lead + t.k - c.h, role, text FROM conv c JOIN t USING (conv_id) WHERE t.k > c.h),
        member AS (
          SELECT conv_id, d, md5(string_agg(md5(length(role) || ':' || role || text), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS node, octet_length(encode(text)) AS bytes FROM turns
          UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
        size AS (SELECT conv_id, max(d) AS n FROM member GROUP BY conv_id),
        node AS (
          SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, string_agg(CASE WHEN d = n THEN conv_id END, ',' ORDER BY conv_id) AS ends
          FROM member JOIN size USING (conv_id) GROUP BY node, d),
        linked AS (SELECT node.*, m.node AS parent FROM node LEFT JOIN member m ON m.conv_id = node.conv_id AND m.d = node.d - 1),
        kids AS (SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent),
        below AS (
          SELECT m.node, sum((l.n_convs - 1) * l.bytes) AS saved, count(*) FILTER (WHERE k.node IS NULL) AS leaves
          FROM linked l LEFT JOIN kids k ON k.node = l.node JOIN member m ON m.conv_id = l.conv_id AND m.d <= l.d GROUP BY m.node)
        SELECT l.conv_id, CAST(l.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, l.n_convs, coalesce(k.n_children, 0) AS n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(l.ends, '')) AS ends_sha256
        FROM linked l JOIN below b USING (node) LEFT JOIN kids k ON k.node = l.node LEFT JOIN node p ON p.node = l.parent
    """,
    "op12_source_mix": r"""
        WITH s AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(concat_ws(':', 'mix', doc_id, coalesce(text, ''))) AS mark FROM documents),
        src AS (SELECT source, sum(size) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s GROUP BY source),
        weighed AS (SELECT *, [5, 2, 1][no % 3 + 1] AS w FROM src),
        filled AS (  -- sources by the level at which they are full: the first k are full if the level without them is above
          SELECT *, row_number() OVER r AS k, sum(2 * total) OVER r AS full_words, coalesce(sum(w) OVER (ORDER BY no DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) - sum(w) OVER r AS w_left,
            sum(total) OVER () AS whole FROM weighed WINDOW r AS (ORDER BY total / w::DOUBLE, no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        level AS (  -- the least k with which the next source is not full
          SELECT coalesce(min(k) FILTER (WHERE holds), 0) AS k FROM (
            SELECT k, lead(2 * total) OVER (ORDER BY k) * w_left >= (1.5 * whole - full_words) * lead(w) OVER (ORDER BY k) AS holds FROM filled
            UNION ALL SELECT 0, 2 * total * (w_left + w) >= 1.5 * whole * w FROM filled WHERE k = 1)),
        target AS (
          SELECT f.source, f.no, f.total, CASE WHEN f.k <= level.k THEN 2.0::DOUBLE * f.total
            ELSE f.w * (1.5 * whole - coalesce((SELECT max(full_words) FROM filled g, level WHERE g.k = level.k), 0))::DOUBLE / (SELECT sum(w) FROM filled g, level WHERE g.k > level.k)::DOUBLE END AS target
          FROM filled f, level),
        placed AS (
          SELECT s.doc_id, s.size, t.total, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS take,
            coalesce(sum(s.size) OVER (PARTITION BY t.no ORDER BY mark, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun
          FROM s JOIN target t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(total AS BIGINT) AS source_size, target,
          CAST(CASE WHEN size = 0 THEN 0 ELSE size * (take // total) + greatest(0, least(size, take % total - begun)) END AS BIGINT) AS taken FROM placed
    """,
    "op13_centroid_clustering": f"""
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, v) - 1 AS c, v FROM v ORDER BY sha256('2:' || vec_id) NULLS LAST, vec_id, v LIMIT 40),
        {"".join(round_sql(k) for k in range(5))}
        {nearest_sql(5)},
        own AS (SELECT c, sum(d) AS inertia FROM near5 GROUP BY c)
        SELECT near5.vec_id, CAST(near5.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(own.inertia AS BIGINT) AS cluster_inertia, CAST((SELECT sum(d) FROM near5) AS BIGINT) AS inertia,
          sha256(array_to_string(c5.v, ',')) AS centroid_sha256 FROM near5 JOIN own USING (c) JOIN c5 USING (c)
    """,
}
