"""Near-duplicate vectors in SQL."""

from __future__ import annotations

VECTORS = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), smallest AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
), degree AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
), named AS (
  SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(m, vec_id), vec_id) AS component_id
  FROM v LEFT JOIN degree ON degree.x = vec_id LEFT JOIN smallest ON smallest.x = vec_id
)
SELECT *, vec_id = component_id AS kept FROM named
"""
