"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# An item's windows, joined to the documents' windows of the same length; windows of short items by length.
_OP1 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10ffff}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10ffff}}]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: list_slice(w, i, i + least(len(w), 10) - 1))) AS g FROM b WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, ns WHERE len(w) >= n),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM dw) dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP4 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.pos, k.line, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP8 = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM g),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM o WHERE r > 1),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(s.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT t.doc_id, count(x.p) AS n_removed, string_agg(t.word, ' ' ORDER BY t.p) FILTER (x.p IS NULL) AS kept
FROM t LEFT JOIN x ON x.doc_id = t.doc_id AND x.p = t.p GROUP BY t.doc_id) s USING (doc_id)
"""

_OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: list_slice(w, i, i + 3))) END AS s FROM d),
t AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.doc_id = s.doc_id) AS component_id FROM s
"""

_OP7 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id)::BIGINT AS n_links, min(r.c) AS component_id, min(r.c) = e.vec_id AS kept
FROM embeddings e JOIN r USING (vec_id) GROUP BY e.vec_id
"""

ORACLE: dict[str, str] = {
    "op1_decontaminate": _OP1,
    "op4_line_dedup": _OP4,
    "op5_jaccard_join": _OP5,
    "op7_embedding_dedup": _OP7,
    "op8_substring_dedup": _OP8,
}
