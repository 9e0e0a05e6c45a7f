"""DuckDB SQL with the results of the registered queries, where SQL can express them."""

from __future__ import annotations

_OP1 = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM valid q JOIN valid c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

# op2: pairs that share a shingle, counted; components by a recursive walk.
_OP2 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_n
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT x, y FROM pairs JOIN sizes sx ON x = sx.doc_id JOIN sizes sy ON y = sy.doc_id
  WHERE 100 * both_n >= 85 * (sx.n + sy.n - both_n)
),
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT x, y FROM ways UNION SELECT r.doc_id, w.y FROM reach r JOIN ways w ON r.other = w.x
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN reach r USING (doc_id)
GROUP BY d.doc_id, z.n
"""

# op5: DuckDB's levenshtein counts bytes, so letters beyond ASCII become capitals, which lower() frees.
_LATIN = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßð"
_FREE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\x01\x02\x03\x04\x05"
_OP5 = f"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL
),
every AS (
  SELECT doc_id, pos, raw, trim(regexp_replace(lower(raw), '[ \\t-\\r]+', ' ', 'g'), ' ') AS line FROM parts
),
rows_ AS (SELECT doc_id, pos, line, translate(line, '{_LATIN}', '{_FREE}') AS one FROM every WHERE line <> ''),
firsts AS (SELECT line, one, length(line) AS n, min((doc_id, pos)) AS place FROM rows_ GROUP BY ALL),
links AS (
  SELECT a.line AS line, b.place < a.place AS later FROM firsts a JOIN firsts b
    ON a.n >= 24 AND b.n >= 24 AND b.n BETWEEN a.n - 2 AND a.n + 2 AND a.line <> b.line
  WHERE levenshtein(a.one, b.one) <= 2
),
near AS (SELECT line, bool_or(later) AS near, count(*) AS links FROM links GROUP BY line),
marked AS (
  SELECT r.doc_id, r.pos, f.n < 24 AS short, (r.doc_id, r.pos) <> f.place AS exact, coalesce(n.near, false) AS near,
         coalesce(n.links, 0) AS links
  FROM rows_ r JOIN firsts f USING (line) LEFT JOIN near n USING (line)
),
kept AS (
  SELECT e.doc_id, count(*) FILTER (e.line <> '') AS n_lines,
         count(*) FILTER (m.exact) AS n_exact, count(*) FILTER (m.near AND NOT m.exact) AS n_near,
         coalesce(sum(m.links), 0) AS n_links,
         string_agg(e.raw, chr(10) ORDER BY e.pos) FILTER (NOT coalesce((m.exact OR m.near) AND NOT m.short, false)) AS text
  FROM every e LEFT JOIN marked m USING (doc_id, pos) GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_OP10 = """
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k,
         array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM item_words WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM windows),
grams AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes)
),
found AS (SELECT g.doc_id, g.i, g.k, v.item_id FROM grams g JOIN windows v USING (k, s)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11 = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM valid a JOIN valid r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER found AS INTEGER) AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW found AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER found <= 10
"""

# op12: prefixes as joined turn digests; crc32 bit by bit (a byte, then seven times 0, for eight steps).
_OP12 = """
WITH one AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS n,
         md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({'digest': digest, 'n': n} ORDER BY turn NULLS FIRST, digest) AS t FROM one GROUP BY conv_id
),
heads AS (
  SELECT conv_id, t, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
           lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, e: xor(xor(c, e) // 2, (xor(c, e) % 2) * 3988292384)), 4294967295) % 6 AS h
  FROM own
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.t, 1, c.h), []), coalesce(list_slice(c.t, c.h + 1, len(c.t)), [])) AS t
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (
  SELECT conv_id, d, len(t) AS size, t[d].n AS n,
         array_to_string(list_transform(list_slice(t, 1, d), lambda x: x.digest), '') AS key
  FROM (SELECT conv_id, t, unnest(range(len(t) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM prefixes GROUP BY key, d
),
children AS (SELECT left(key, 32 * (d - 1)) AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
weighed AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.key = c.key
),
subtrees AS (
  SELECT left(key, 32 * up) AS key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * n END) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM weighed) GROUP BY 1
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM weighed w JOIN subtrees s ON w.key = s.key LEFT JOIN nodes p ON w.d > 0 AND p.key = left(w.key, 32 * (w.d - 1))
"""

_OP13 = """
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_topk": _OP1,
    "op2_minhash": _OP2,
    "op5_line_dedup": _OP5,
    "op10_decontaminate": _OP10,
    "op11_hard_negatives": _OP11,
    "op12_prefix_trie": _OP12,
    "op13_exact_dedup": _OP13,
}
