"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from riskframe.llm import quality_rules, secrets

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '{WORD}') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
c AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1)
  GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         coalesce(list_max(list_transform(ws, lambda x: strlen(x))), 0) AS longest_word
  FROM w LEFT JOIN c USING (r)),
b AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (word_chars < 2 * n_words)::BIGINT + 8 * (word_chars > 15 * n_words)::BIGINT
    + 16 * (10 * n_symbols > n_words)::BIGINT
    + 32 * (n_dup_lines > 1 AND 100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 64 * (2 * n_upper > word_chars)::BIGINT + 128 * (2 * n_bangs > n_words)::BIGINT
    + 256 * (longest_word > 1000)::BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, 'v2' AS policy
FROM b
"""

#: One row per policy and rule, from the failure bits of ``OP1``.
ABLATIONS = f"""
WITH ledger AS ({OP1}),
p AS (SELECT * FROM (VALUES {", ".join(f"('{v}', {m})" for v, m in
                                       quality_rules.POLICIES.items())}) AS t(policy, mask)),
u AS (SELECT * FROM (VALUES {", ".join(f"('{r.name}', {1 << i})" for i, r in
                                       enumerate(quality_rules.RULES))}) AS t(rule, bit)),
b AS (SELECT p.policy, rule, bit, fail_bits & mask AS bits
      FROM ledger, p JOIN u ON p.mask & u.bit <> 0)
SELECT policy, rule, count(*) AS n_docs, count(*) FILTER (bits & bit <> 0) AS n_failed,
       count(*) FILTER (bits = bit) AS n_only, count(*) FILTER (bits = 0) AS n_kept,
       count(*) FILTER (bits & ~bit = 0) AS n_kept_without
FROM b GROUP BY policy, rule
"""

OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS gram
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 50)) AS p
  FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS low FROM g)
  WHERE low < doc_id),
words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (
  SELECT words.r, string_agg(w, ' ' ORDER BY words.p) AS s, count(*) AS n
  FROM words ANTI JOIN gone ON words.r = gone.r AND words.p = gone.p GROUP BY words.r)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls,
         substr(md5(CASE WHEN doc_id IS NULL THEN '-' ELSE '' END || coalesce(text, '')), 1, 15)
         AS tie
  FROM documents),
l AS (SELECT r, doc_id, tie, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM d),
f AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY n) AS k FROM l
  WHERE regexp_matches(line, '{WORD}')),
g AS (
  SELECT r, doc_id, k, tie, line || chr(10) || lead(line, 1) OVER o || chr(10)
         || lead(line, 2) OVER o AS gram
  FROM f WINDOW o AS (PARTITION BY r ORDER BY k)),
later AS (
  SELECT r, k FROM (SELECT r, k, rank() OVER (
    PARTITION BY gram ORDER BY doc_id NULLS LAST, k, tie) AS place FROM g
    WHERE gram IS NOT NULL)
  WHERE place > 1),
gone AS (
  SELECT DISTINCT f.r, f.n FROM f JOIN later ON f.r = later.r
  AND f.k BETWEEN later.k AND later.k + 2),
kept AS (
  SELECT l.r, string_agg(line, chr(10) ORDER BY l.n) AS s
  FROM l ANTI JOIN gone ON l.r = gone.r AND l.n = gone.n GROUP BY l.r)
SELECT doc_id, (SELECT count(*) FROM f WHERE f.r = d.r) AS n_lines,
       (SELECT count(*) FROM gone WHERE gone.r = d.r) AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def _rule_spans(number: int, rule: secrets.SecretRule) -> str:
    regex = (rule.plain or rule.regex).replace("'", "''")
    told = f"regexp_extract_all(t, '{regex}', {rule.group})"
    return f"""
  SELECT r, {number} AS kind, '{rule.kind}' AS name, i,
         coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start,
         length(hits[i]) AS size
  FROM (SELECT r, hits, gaps, told, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT r, regexp_extract_all(t, '{regex}') AS hits, {told} AS told,
                     string_split_regex(t, '{regex}') AS gaps FROM d))
  WHERE length(told[i]) >= {rule.least}"""


OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_rule_spans(i, rule) for i, rule in enumerate(secrets.RULES))}),
p AS (SELECT *, name || ':' || start::BIGINT || ':' || (start + size)::BIGINT AS span FROM s),
a AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
         string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM p GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(n, m) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT reach.n, l.b FROM reach JOIN l ON l.a = reach.m),
c AS (SELECT n AS vec_id, min(m) AS component_id FROM reach GROUP BY n),
k AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c USING (vec_id) LEFT JOIN k USING (vec_id)
"""

OP11 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT r, i, md5(b[i + 1:i + 400]) AS gram
  FROM (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS i FROM d)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY gram) AS n FROM w) WHERE n > 1),
runs AS (
  SELECT r, i, sum(begins) OVER (PARTITION BY r ORDER BY i) AS run FROM (
    SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 1 ELSE 0 END
           AS begins FROM again)),
spans AS (SELECT r, run, min(i) AS a, max(i) + 400 AS z FROM runs GROUP BY r, run),
parts AS (
  SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS from_byte FROM spans),
cut AS (
  SELECT r, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS upto,
         string_agg(hex(b[from_byte + 1:a]), '' ORDER BY a) AS kept
  FROM parts JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || hex(b[coalesce(upto, 0) + 1:octet_length(b)])))
         AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""


def _kmeans(rounds: int, count: int) -> str:
    """Rounds of assignment and exact means, written out one after another."""
    steps = [f"""
v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, e) - 1 AS k, e FROM v
  QUALIFY k < {count})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, v.e AS e, t.k AS k, t.dist AS dist FROM v JOIN (
    SELECT r, min(list_value(list_sum(list_transform(list_zip(v.e, c.e),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c.k)) AS best,
      best[1] AS dist, best[2] AS k
    FROM v, c{i} AS c GROUP BY r) AS t USING (r))""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT k, list(m ORDER BY p) AS e FROM (
    SELECT k, p, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM (SELECT k, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{i}) GROUP BY k, p)
  GROUP BY k),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.k AS k, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (k))""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, a.k::INTEGER AS cluster, dist AS distance,
       sum(dist) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
       sum(dist) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c USING (k)
"""


OP12 = _kmeans(rounds=5, count=40)

#: crc32 of a decimal number, bit by bit.
_CRC32 = """
list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split({number}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))
"""

OP13 = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, c - ((c % 5) + 5) % 5 AS base, xor({_CRC32.format(number="c")}, 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
plans AS (
  SELECT ids.*, least(h, (SELECT count(*) FROM t WHERE t.c = ids.base)) AS n_head FROM ids),
rebuilt AS (
  SELECT p.c, t.k + 1 AS d, role, text FROM plans p JOIN t ON t.c = p.base AND t.k < p.n_head
  UNION ALL
  SELECT p.c, t.k - p.h + p.n_head + 1, role, text FROM plans p JOIN t ON t.c = p.c
  WHERE t.k >= p.h),
paths AS (
  SELECT c, d, octet_length(encode(text)) AS bytes,
         md5(string_agg(md5(role) || md5(text), '' ORDER BY d) OVER (
           PARTITION BY c ORDER BY d)) AS node
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM plans),
sizes AS (SELECT c, max(d) AS n_turns FROM paths GROUP BY c),
steps AS (
  SELECT c, d, bytes, node, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent,
         d = n_turns AS last FROM paths JOIN sizes USING (c)),
nodes AS (
  SELECT d, node, parent, min(c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256
  FROM steps GROUP BY d, node, parent),
below AS (
  SELECT DISTINCT a.d, a.node, b.d AS sub_d, b.node AS sub
  FROM steps a JOIN steps b ON a.c = b.c AND b.d >= a.d),
children AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM nodes GROUP BY 1, 2),
totals AS (
  SELECT below.d, below.node, count(*) FILTER (k.n IS NULL) AS n_leaves,
         sum((s.n_convs - 1) * s.bytes)::BIGINT AS saved_tokens
  FROM below JOIN nodes s ON s.d = below.sub_d AND s.node = below.sub
  LEFT JOIN children k ON k.d = s.d AND k.node = s.node GROUP BY below.d, below.node)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN totals USING (d, node)
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.parent
LEFT JOIN children k ON k.d = n.d AND k.node = n.node
"""

ORACLE = {
    "op1_quality_rules": OP1,
    "quality_ablations": ABLATIONS,
    "op7_substring_dedup": OP7,
    "op8_line_dedup": OP8,
    "op9_secret_scan": OP9,
    "op10_embedding_dedup": OP10,
    "op11_suffix_array_dedup": OP11,
    "op12_centroid_clustering": OP12,
    "op13_prefix_trie": OP13,
}
