"""Pfair mixing in SQL."""

from __future__ import annotations

MIXING = r"""
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), raw AS (
  SELECT source, greatest(1, floor(1000 * sqrt(n / (SELECT max(n) FROM counts))))::BIGINT AS w FROM counts
), common AS (
  SELECT list_reduce(list(w), lambda a, b: gcd(a, b)) AS g FROM raw
), weights AS (
  SELECT source, w // g AS u, (SELECT sum(w // g) FROM raw, common)::BIGINT AS q FROM raw, common
), edf(t, source, u, q, j, hit) AS (
  SELECT -1::BIGINT, source, u, q, 0::BIGINT, false FROM weights
  UNION ALL
  SELECT t + 1, source, u, q, j + (turn = 1)::INT, turn = 1
  FROM (
    SELECT *, row_number() OVER (
      ORDER BY (j * q // u > t + 1 OR j >= u), ((j + 1) * q + u - 1) // u, source NULLS FIRST) AS turn
    FROM edf WHERE t + 1 < q
  )
), plan AS (
  SELECT source, u, q, j - 1 AS k, t AS place FROM edf WHERE hit
), numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS number FROM documents
)
SELECT n.doc_id, n.source, number, number // 16 AS block,
       (number // 16) * q // u AS release, ((number // 16 + 1) * q + u - 1) // u AS deadline,
       ((number // 16) // u) * q + place AS slot
FROM numbered n JOIN plan p ON p.source IS NOT DISTINCT FROM n.source AND p.k = (number // 16) % u
"""
