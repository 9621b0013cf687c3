"""Ranked lexical search in SQL."""

from __future__ import annotations

SEARCH = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), corpus AS (
  SELECT count(*) AS docs, sum(len(terms))::BIGINT AS len FROM d WHERE len(terms) > 0
), lengths AS (
  SELECT doc_id, 25 + 75 * len(terms) * docs // len AS m FROM d, corpus WHERE len(terms) > 0
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT q.term, count(tf.doc_id) AS df FROM (SELECT DISTINCT term FROM q) q LEFT JOIN tf USING (term) GROUP BY q.term), corpus
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
