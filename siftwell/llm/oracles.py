"""DuckDB SQL for the rows of the queries of this subpackage, by plain means: all windows, all pairs, recursion."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"
#: Lower case of A to Z alone.
LOW = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: What links reach: ``link`` holds (a, b) both ways, ``node`` the ids.
REACH = """
reach(a, b) AS (SELECT id, id FROM node UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)""".strip()

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id AS id, {WORDS.format(t=LOW.format(t="text"))} AS w FROM documents),
g AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM w),
e AS (SELECT id, unnest(g) AS x FROM g),
met AS (SELECT p.id AS a, q.id AS b, count(*) AS n FROM e p JOIN e q ON p.x = q.x AND p.id < q.id GROUP BY ALL),
pair AS (SELECT a, b FROM met JOIN g p ON p.id = a JOIN g q ON q.id = b WHERE 100 * n >= 80 * (len(p.g) + len(q.g) - n)),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair), node AS (SELECT id FROM g),
{REACH}
SELECT g.id AS doc_id, len(g.g)::BIGINT AS n_shingles, component_id, g.id = component_id AS kept FROM g JOIN component USING (id)
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, CASE WHEN embedding IS NULL OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 OR len(list_filter(embedding, lambda x: x <> 0)) = 0 THEN NULL ELSE list_transform(embedding, lambda x: x::DOUBLE) END AS v FROM embeddings),
u AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS n FROM v WHERE v IS NOT NULL),
link AS (SELECT p.id AS a, q.id AS b FROM u p JOIN u q ON p.id <> q.id AND len(p.v) = len(q.v) WHERE list_dot_product(p.v, q.v) / (p.n * q.n) >= 0.95),
node AS (SELECT id FROM v), many AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a),
{REACH}
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept FROM component LEFT JOIN many USING (id)
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(t="text")} AS w FROM documents),
s AS (SELECT doc_id, k, md5(array_to_string(w[k : k + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM w)),
r AS (SELECT doc_id, k FROM s JOIN (SELECT h FROM s GROUP BY h HAVING count(*) > 1) USING (h)),
c AS (SELECT doc_id, list_distinct(flatten(list(range(k, k + 35)))) AS gone FROM r GROUP BY doc_id),
x AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM w LEFT JOIN c USING (doc_id)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM x) JOIN x USING (doc_id) WHERE NOT list_contains(gone, i) GROUP BY doc_id)
SELECT x.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM x LEFT JOIN kept USING (doc_id)
"""

#: Bytes as pairs of hexadecimal digits.
SUFFIXES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, k, md5(substring(hx, 2 * k - 1, 200)) AS m FROM (SELECT doc_id, hx, unnest(range(1, len(hx) // 2 - 98)) AS k FROM h)),
f AS (SELECT doc_id, k, row_number() OVER (PARTITION BY m ORDER BY doc_id, k) > 1 AS again FROM w),
r AS (SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 100 THEN 0 ELSE 1 END AS new FROM f WHERE again),
i AS (SELECT doc_id, min(k) AS a, max(k) + 99 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM r) GROUP BY doc_id, g),
s AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS s, a - 1 AS t FROM i UNION ALL SELECT h.doc_id, coalesce(max(b), 0) + 1, any_value(len(hx) // 2) FROM h LEFT JOIN i USING (doc_id) GROUP BY h.doc_id),
k AS (SELECT doc_id, string_agg(substring(hx, 2 * s - 1, 2 * (t - s + 1)), '' ORDER BY s) AS kx FROM s JOIN h USING (doc_id) WHERE t >= s GROUP BY doc_id),
n AS (SELECT doc_id, sum(b - a + 1) AS removed, count(*) AS spans FROM i GROUP BY doc_id)
SELECT h.doc_id, (len(hx) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kx, ''))) AS kept_sha256
FROM h LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_suffix_dedup": SUFFIXES,
    "op6_embedding_dedup": EMBEDDINGS,
    "op7_near_dedup": NEAR_DEDUP,
    "op10_substring_dedup": SUBSTRINGS,
}
