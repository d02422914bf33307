"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH word_lists AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_lists AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         list_aggregate(w[i : i + least(13, len(w)) - 1], 'string_agg', ' ') AS win
  FROM item_lists, range(1, greatest(2, len(w) - 11)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, size, list_aggregate(w[i : i + size - 1], 'string_agg', ' ') AS win
  FROM word_lists, sizes, range(1, len(w) + 1) AS r(i) WHERE i + size - 1 <= len(w)),
found AS (SELECT doc_id, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM word_lists LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


_PAGE_HASH = """sha256(
  coalesce(CAST(length(url) AS VARCHAR), '-') || ':' || coalesce(url, '') ||
  coalesce(CAST(length(html) AS VARCHAR), '-') || ':' || coalesce(html, ''))"""

FIXITY = f"""
WITH replica AS (
  SELECT page_id, url, CASE WHEN page_id % 211 = 17 THEN coalesce(html, '') || '?' ELSE html END AS html
  FROM (SELECT * FROM pages WHERE page_id % 307 <> 5 UNION ALL SELECT * FROM pages WHERE page_id % 401 = 9)),
a AS (SELECT page_id, {_PAGE_HASH} AS h, count(*) AS n FROM pages GROUP BY ALL),
b AS (SELECT page_id, {_PAGE_HASH} AS h, count(*) AS n FROM replica GROUP BY ALL)
SELECT CAST(page_id // 4096 AS VARCHAR) AS archive, page_id AS "offset", h AS record_sha256,
       coalesce(a.n, 0) AS n_primary, coalesce(b.n, 0) AS n_replica
FROM a FULL JOIN b USING (page_id, h) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)
"""

_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), ']', '&rsqb;')"

CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(9 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(q.e, p.e) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id <> p.vec_id AND len(q.e) = len(p.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_merkle_fixity": FIXITY, "op4_decontaminate": DECONTAMINATE, "op8_chat_format": CHAT, "op9_topk": TOPK,
            "op13_hard_negatives": HARD_NEGATIVES}
