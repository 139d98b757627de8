"""DuckDB SQL of the training-data queries that SQL can express on whole
tables; the others are held against brute force in ``tests/llm``."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

_OP12 = f"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), {_TERMS})) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term),
factors AS (SELECT doc_id, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM lengths, corpus),
item_terms AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), {_TERMS})) AS term FROM benchmark)
  GROUP BY item_id, term),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (term) JOIN tf USING (term) JOIN factors USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank", doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 10
"""

# Links between valid vectors; each vector's component is the smallest label
# that reaches it along links.
_OP1 = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT a AS node, a AS low FROM links
  UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node WHERE reach.low < links.b),
low AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(low, e.vec_id) AS component_id, coalesce(low, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON e.vec_id = l.a LEFT JOIN low ON e.vec_id = node
"""

# Sets of four-word shingles, all intersections, links at 80 percent.
_OP4 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (
  SELECT a AS node, a AS low FROM links
  UNION SELECT links.b, reach.low FROM reach JOIN links ON links.a = reach.node WHERE reach.low < links.b),
low AS (SELECT node, min(low) AS low FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, d.doc_id) AS component_id, coalesce(low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes ON d.doc_id = sizes.doc_id LEFT JOIN low ON d.doc_id = node
"""

# CRC-32 by its table; two words are near if they agree with one letter taken
# out of both (replaced) or of one (inserted, deleted).
_OP11 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run),
bytes AS (
  SELECT *, list_transform(range(1, 2 * octet_length(encode(key)), 2), lambda i: CAST('0x' || substr(hex(encode(key)), i, 2) AS BIGINT)) AS b
  FROM (SELECT *, concat(doc_id, ':', run) AS key FROM runs)),
hashed AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM bytes, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT u.word, v.word, v.n FROM words u JOIN cuts v ON u.word = v.rest
  UNION SELECT v.word, u.word, u.n FROM words u JOIN cuts v ON u.word = v.rest),
best AS (
  SELECT word, near AS form, near_n AS form_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (
  SELECT word, n, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words LEFT JOIN best USING (word)),
paths AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT p.word, f.form, p.steps + 1 FROM paths p JOIN formed f ON p.here = f.word WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(here, steps) AS root FROM paths GROUP BY word) USING (word)
"""

# Every 400-byte string of every text, as hexadecimal digits.
_OP13 = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 800)) AS name FROM (SELECT doc_id, h, unnest(range(n - 399)) AS s FROM texts WHERE n >= 400)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY name) AS k FROM starts) WHERE k > 1),
islands AS (
  SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM (
    SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 1 ELSE 0 END AS new FROM again)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM islands GROUP BY doc_id, island),
gaps AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans
  UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
left_over AS (SELECT g.doc_id, string_agg(substr(h, 2 * g.a + 1, 2 * (coalesce(g.b, n) - g.a)), '' ORDER BY g.a) AS h
              FROM gaps g JOIN texts t ON t.doc_id = g.doc_id GROUP BY g.doc_id),
gone AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(l.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN gone g ON t.doc_id = g.doc_id LEFT JOIN left_over l ON t.doc_id = l.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": _OP1, "op4_minhash_near_dedup": _OP4, "op11_spelling_variants": _OP11,
    "op12_lexical_search": _OP12, "op13_suffix_array_dedup": _OP13,
}
