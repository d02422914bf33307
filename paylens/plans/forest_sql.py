"""SQL that grows a whole forest: the independent check of ``models.forest``.

One recursive query: its working table holds, per tree, the rows of the bag (``w`` > 0), the rows to be predicted (``w`` = 0) and one row
per split (``w`` = -1). Every step finds the best split of every node and moves the rows on. Nodes are numbered like a heap, which
serves up to a depth of 61.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

SEED = 42


def _weight() -> str:
    """Poisson draw of mean 1 by its distribution function."""
    total, whens = 0.0, []
    for k in range(13):
        total += math.exp(-1) / math.factorial(k)
        if int(total * 2**32) < 2**32:
            whens.append(f"CAST(u >= {int(total * 2**32)} AS INTEGER)")
    return " + ".join(whens)


def forest(rows: str, numeric: Sequence[str], text: Sequence[str], trees: int, depth: int | None, per_node: int | None) -> str:
    """CTEs up to ``forest_rows``; ``rows`` has job_id, salary_k, split and the columns, all complete."""
    names = [*numeric, *text]
    features = ", ".join(f"({i}, '{n}', {str(n in text).lower()})" for i, n in enumerate(names, 1))
    values = _union(f"SELECT '{c}' AS name, CAST({c} AS DOUBLE) AS v, count(*) AS n FROM {rows} WHERE split = 'train' GROUP BY ALL" for c in numeric)
    levels = _union(
        f"""SELECT '{c}' AS name, {c} AS level, row_number() OVER (ORDER BY CAST(sum(salary_k) AS DOUBLE) / count(*), {c}) AS v
FROM {rows} WHERE split = 'train' GROUP BY {c}""" for c in text) if text else "SELECT '' AS name, '' AS level, 0 AS v WHERE false"
    edge = [f"(SELECT min(edge) FROM fr_edges WHERE name = '{c}' AND edge >= CAST({c} AS DOUBLE))" for c in numeric]
    level = [f"coalesce((SELECT v FROM fr_levels WHERE name = '{c}' AND level = {c}), -1)" for c in text]
    # beyond the last edge a value counts as the last one
    code = [f"CASE WHEN split = 'train' THEN {e} ELSE CAST({c} AS DOUBLE) END" for e, c in zip(edge, numeric)] + level
    draw = "" if per_node is None else f"""QUALIFY row_number() OVER (PARTITION BY tree, node
    ORDER BY md5('{SEED}:' || tree || ':' || substr(bin(node), 2) || ':' || name)) <= {per_node}"""
    limit = "" if depth is None else f"AND node < {2**depth}"
    return f"""fr_features AS (
SELECT * FROM (VALUES {features}) t(f, name, is_text)
), fr_values AS (
{values}
), fr_edges AS MATERIALIZED (
SELECT name, v AS edge FROM (SELECT *, sum(n) OVER (PARTITION BY name ORDER BY v) AS upto, sum(n) OVER (PARTITION BY name) AS total FROM fr_values)
WHERE (upto * 255) // total > ((upto - n) * 255) // total
), fr_levels AS MATERIALIZED (
{levels}
), fr_rows AS MATERIALIZED (
SELECT job_id AS id, CAST(salary_k AS DOUBLE) AS y, split, [{", ".join(code)}] AS e FROM {rows}
), fr_trees AS (
SELECT CAST(t AS INTEGER) AS tree FROM range({trees}) r(t)
), fr_bags AS MATERIALIZED (
SELECT tree, id, y, CAST({_weight()} AS DOUBLE) AS w, e FROM (SELECT tree, id, y, e,
  CAST('0x' || substr(md5('{SEED}:' || tree || ':' || id), 1, 8) AS BIGINT) AS u FROM fr_rows, fr_trees WHERE split = 'train')
), forest_rows AS (
WITH RECURSIVE grown(tree, node, id, y, w, e, done, value, f, gain) AS (
SELECT tree, CAST(1 AS BIGINT), id, y, w, e, false, CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE) FROM fr_bags WHERE w > 0
UNION ALL SELECT tree, 1, id, y, 0.0, e, false, NULL, NULL, NULL FROM fr_rows, fr_trees WHERE split <> 'train'
UNION ALL (
WITH here AS MATERIALIZED (SELECT * FROM grown WHERE w >= 0 AND NOT done),
nodes AS MATERIALIZED (SELECT tree, node, sum(w) AS wn, sum(w * y) AS ws FROM here WHERE w > 0 GROUP BY ALL),
drawn AS (SELECT tree, node, f, is_text FROM nodes, fr_features WHERE true {limit} {draw}),
cells AS (SELECT tree, node, d.f AS f, is_text, e[d.f] AS v, sum(w) AS n, sum(w * y) AS s
  FROM here JOIN drawn d USING (tree, node) WHERE w > 0 GROUP BY ALL),
summed AS MATERIALIZED (SELECT *, sum(n) OVER o AS nl, sum(s) OVER o AS sl, row_number() OVER o AS pos FROM cells
  WINDOW o AS (PARTITION BY tree, node, f ORDER BY CASE WHEN is_text THEN s / n ELSE v END, v ROWS UNBOUNDED PRECEDING)),
best AS MATERIALIZED (SELECT tree, node, f, is_text, v AS edge, pos, score - ws * ws / wn AS gain FROM (
  SELECT *, sl * sl / nl + (ws - sl) * (ws - sl) / (wn - nl) AS score FROM summed JOIN nodes USING (tree, node) WHERE nl < wn)
  WHERE score - ws * ws / wn > 0 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, pos) = 1),
lefts AS (SELECT tree, node, list(s.v) AS vs FROM summed s JOIN best b USING (tree, node, f) WHERE b.is_text AND s.pos <= b.pos GROUP BY ALL)
SELECT h.tree, CASE WHEN b.f IS NULL THEN h.node ELSE 2 * h.node +
    CASE WHEN CASE WHEN b.is_text THEN list_contains(l.vs, h.e[b.f]) ELSE h.e[b.f] <= b.edge END THEN 0 ELSE 1 END END,
  h.id, h.y, h.w, h.e, b.f IS NULL, ws / wn, NULL, NULL
FROM here h JOIN nodes USING (tree, node) LEFT JOIN best b USING (tree, node) LEFT JOIN lefts l USING (tree, node) WHERE h.w = 0 OR b.f IS NOT NULL
UNION ALL SELECT tree, node, NULL, NULL, -1.0, NULL, true, NULL, f, gain FROM best
))
SELECT tree, node, id, w, done, value, f, gain FROM grown WHERE w <= 0 AND done
), forest_pred AS (
SELECT job_id, CAST(salary_k AS DOUBLE) AS y_true, y_pred, split FROM {rows}
JOIN (SELECT id AS job_id, sum(value) / count(*) AS y_pred FROM forest_rows WHERE w = 0 GROUP BY id) USING (job_id)
), forest_weights AS (
SELECT name AS feature, coalesce(share / (SELECT count(DISTINCT tree) FROM forest_rows WHERE w < 0), 0) AS weight FROM fr_features LEFT JOIN (
  SELECT f, sum(gain / total) AS share FROM (SELECT tree, f, sum(gain) AS gain FROM forest_rows WHERE w < 0 GROUP BY ALL)
  JOIN (SELECT tree, sum(gain) AS total FROM forest_rows WHERE w < 0 GROUP BY ALL) USING (tree) GROUP BY f) USING (f)
)"""


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)
