"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
p AS MATERIALIZED (
  SELECT r, i, hash(w[i], w[i + 1], w[i + 2]) AS g, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM p) WHERE c > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
lines AS (
  SELECT r, len(l) - len(list_distinct(l)) AS n FROM (
    SELECT r, list_filter(string_split(t, chr(10)),
                          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)),
m AS MATERIALIZED (
  SELECT d.r, doc_id, source, len(w.w)::BIGINT AS n_words,
         length(array_to_string(w.w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         lines.n::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w ON d.r = w.r JOIN lines ON d.r = lines.r LEFT JOIN covered ON d.r = covered.r),
b AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b WHERE source IS NOT NULL
  GROUP BY source),
prior AS (
  SELECT m, rho, greatest(0.0, 1 / rho - 1) AS k FROM (
    SELECT m, CASE WHEN m * (1 - m) > 0 AND docs > hosts
                   THEN (v * docs / (m * (1 - m)) - hosts) / (docs - hosts) ELSE 0 END AS rho
    FROM (SELECT sum(f) / sum(n) AS m, sum(n) AS docs, count(*) AS hosts,
                 sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v
          FROM hosts))),
verdict AS (
  SELECT source, round(CASE WHEN rho <= 1e-12 THEN m ELSE (f + m * k) / (n + k) END, 9) > 0.75
         AS host_failed
  FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(host_failed, false) AS host_failed,
       NOT base_failed AND NOT coalesce(host_failed, false) AS kept
FROM b LEFT JOIN verdict ON b.source = verdict.source
"""


OP3 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP9 = """
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, coalesce('s:' || source, 'null') AS name,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key,
         greatest(coalesce(length(text), 1), 1) AS size
  FROM documents),
share AS (
  SELECT name, pow(sum(size)::DOUBLE, 0.7) AS x, count(*) OVER () AS k FROM d GROUP BY name),
exact AS (SELECT name, (1000 - k) * x / sum(x) OVER () AS e FROM share),
w AS MATERIALIZED (
  SELECT name, row_number() OVER (ORDER BY name) AS i,
         (1 + floor(e) + (row_number() OVER (ORDER BY round(e - floor(e), 9) DESC, name)
                          <= 1000 - sum(1 + floor(e)) OVER ())::INT)::BIGINT AS p
  FROM exact),
l AS MATERIALIZED (SELECT list(p ORDER BY i) AS p, list(0::BIGINT ORDER BY i) AS zero FROM w),
edf AS (
  SELECT -1::BIGINT AS slot, 0::BIGINT AS pick, 0::BIGINT AS turn, zero AS done FROM l
  UNION ALL
  SELECT slot, pick, done[pick], list_transform(done, lambda x, i: x + (i = pick)::BIGINT)
  FROM (
    SELECT slot + 1 AS slot, done, list_min(list_transform(done, lambda x, i:
      CASE WHEN x < p[i] AND x * 1000 // p[i] <= slot + 1
           THEN ((x + 1) * 1000 + p[i] - 1) // p[i] * 1000 + i END)) % 1000 AS pick
    FROM edf, l WHERE slot < 999)),
period AS (SELECT name, p, turn, slot FROM edf JOIN w ON w.i = edf.pick WHERE slot >= 0),
b AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY name ORDER BY key, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 65536)::BIGINT AS block
  FROM d)
SELECT doc_id, source, block, (block // p * 1000 + slot)::BIGINT AS slot,
       row_number() OVER (PARTITION BY b.name, block ORDER BY key, doc_id) AS place
FROM b JOIN period ON period.name = b.name AND period.turn = block % p
"""

OP10 = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(octet_length(encode(text)), 0) AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text ' || md5(text), '')), 1, 15))::BIGINT
         AS key
  FROM documents),
n AS (
  SELECT r, doc_id, depth, key >> (60 - depth) AS prefix,
         count(*) OVER bucket AS shard_docs, sum(bytes) OVER bucket AS shard_bytes
  FROM d, (SELECT unnest(range(0, 25)) AS depth)
  WINDOW bucket AS (PARTITION BY depth, key >> (60 - depth)))
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard,
       depth::INT AS depth, shard_docs, shard_bytes::BIGINT AS shard_bytes
FROM n WHERE shard_bytes <= 1048576 OR shard_docs = 1
QUALIFY row_number() OVER (PARTITION BY r ORDER BY depth) = 1
"""


OP7 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         END) AS s FROM d),
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM g),
c AS (
  SELECT a.doc_id AS p, b.doc_id AS q, a.n AS m, b.n AS n, count(*) AS k
  FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT p, q FROM c WHERE k >= 0.8 * (m + n - k) - 1e-9),
e AS MATERIALIZED (SELECT p, q FROM l UNION ALL SELECT q, p FROM l),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM g
  UNION SELECT r.a, e.q FROM r JOIN e ON r.b = e.p),
k AS (SELECT a, min(b) AS class_id, count(*) AS class_size FROM r GROUP BY a)
SELECT a AS doc_id, class_id, class_size,
       (SELECT count(*) FROM e WHERE e.p = k.a) AS n_links
FROM k
"""

OP11 = """
WITH t AS MATERIALIZED (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, strlen(coalesce(text, '')) AS size,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
n AS MATERIALIZED (
  SELECT c, id, size,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, id) AS pos FROM t),
v AS MATERIALIZED (     -- CRC-32 of the decimal id, bit by bit
  SELECT c, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
           string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
         lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
           lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT)
                        ELSE x >> 1 END))) % 9 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT v.c, 0 AS own, pos, id, size FROM v JOIN n ON n.c = v.c - v.c % 5 AND pos <= h
  UNION ALL SELECT v.c, 1, pos, id, size FROM v JOIN n ON n.c = v.c AND pos > h),
q AS (SELECT c, id, size, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d FROM r),
k AS MATERIALIZED (
  SELECT c, d, size, md5(string_agg(id, ',') OVER (
           PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS key FROM q
  UNION ALL SELECT c, 0, 0, '' FROM v),
node AS MATERIALIZED (
  SELECT key, d, min(c) AS conv_id, count(*) AS n, max(size) AS size FROM k GROUP BY key, d),
up AS MATERIALIZED (
  SELECT node.key, k.key AS up FROM node JOIN k ON k.c = conv_id AND k.d = node.d - 1),
children AS MATERIALIZED (SELECT up AS key, count(*) AS n FROM up GROUP BY up),
own AS (
  SELECT node.*, coalesce(children.n, 0) AS children,
         CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf, (node.n - 1) * size AS saved
  FROM node LEFT JOIN children ON node.key = children.key),
below AS (
  SELECT k.key, sum(leaf) AS leaves, sum(saved) AS saved
  FROM own JOIN k ON k.c = conv_id AND k.d <= own.d GROUP BY k.key),
ends AS (
  SELECT key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(key, d) AS key FROM k GROUP BY c) GROUP BY key)
SELECT own.conv_id, own.d::BIGINT AS depth, p.conv_id AS parent_conv_id, own.n::BIGINT AS n_convs,
       own.children::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       below.saved::BIGINT AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM own JOIN below ON own.key = below.key LEFT JOIN ends ON own.key = ends.key
LEFT JOIN up ON own.key = up.key LEFT JOIN node AS p ON up.up = p.key
"""


OP13 = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, e.r, e.vec_id, a.label = e.label AS same,
         list_dot_product(a.v, e.v)::BIGINT AS score
  FROM e AS a JOIN e ON a.vec_id % 50 = 0 AND a.r <> e.r),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, r) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.a, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r)::INTEGER
         AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s AS n ON n.a = p.a AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_host_rules": OP1, "op3_digest_index": OP3, "op7_ngram_join": OP7,
            "op9_pfair_mix": OP9, "op10_extendible_shards": OP10, "op11_turn_trie": OP11,
            "op13_hard_negatives": OP13}
