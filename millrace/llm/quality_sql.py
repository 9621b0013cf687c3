"""The quality rules in SQL, for any set of documents."""

from __future__ import annotations

JUDGED = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}
), windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM windows) WHERE k > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), signals AS (
  SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
         len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '[.!?]')) AS n_ends,
         len(regexp_extract_all(t, '!')) AS n_shouts
  FROM words w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), votes AS (
  SELECT *, 100 * n_symbols < 10 * n_words AS plain FROM signals
), seen AS MATERIALIZED (
  SELECT *, [
    CASE WHEN n_words < 50 THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_repeat_words >= 40 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_symbols >= 20 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_upper >= 40 * word_chars THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_shouts >= 20 * n_words THEN -1 ELSE 0 END,
    CASE WHEN n_lines >= 4 AND 100 * n_dup_lines >= 40 * n_lines THEN -1 ELSE 0 END,
    CASE WHEN word_chars BETWEEN 2 * n_words AND 14 * n_words THEN 0 ELSE -1 END,
    CASE WHEN plain AND 100 * n_ends >= 2 * n_words AND 100 * n_ends < 34 * n_words THEN 1
         WHEN 100 * n_ends < n_words OR 100 * n_ends >= 50 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_symbols < 3 * n_words THEN 1 WHEN 100 * n_symbols >= 10 * n_words THEN -1 ELSE 0 END,
    CASE WHEN plain AND 100 * n_upper < 12 * word_chars THEN 1
         WHEN 100 * n_upper >= 30 * word_chars THEN -1 ELSE 0 END,
    CASE WHEN plain AND 100 * n_repeat_words < 12 * n_words THEN 1
         WHEN 100 * n_repeat_words >= 30 * n_words THEN -1 ELSE 0 END
  ] AS v FROM votes
), patterns AS MATERIALIZED (
  SELECT v, count(*) AS n FROM seen GROUP BY v
), em(r, share, good, bad) AS (
  SELECT 0, 0.8::DOUBLE,
         list_transform(range(11), lambda j: [ln(0.1::DOUBLE), ln(0.4::DOUBLE), ln(0.5::DOUBLE)]),
         list_transform(range(11), lambda j: [ln(0.5::DOUBLE), ln(0.4::DOUBLE), ln(0.1::DOUBLE)])
  UNION ALL
  SELECT r + 1, (sg + 40) / (sn + 50),
    list_transform(range(1, 12), lambda j: [ln(x / (sg + 50)) FOR x IN [
      5 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = -1 THEN w.g ELSE 0 END)),
      20 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = 0 THEN w.g ELSE 0 END)),
      25 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = 1 THEN w.g ELSE 0 END))]]),
    list_transform(range(1, 12), lambda j: [ln(x / (sn - sg + 50)) FOR x IN [
      25 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = -1 THEN w.n - w.g ELSE 0 END)),
      20 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = 0 THEN w.n - w.g ELSE 0 END)),
      5 + list_sum(list_transform(ws, lambda w: CASE WHEN w.v[j] = 1 THEN w.n - w.g ELSE 0 END))]])
  FROM (
    SELECT r, sum(g) AS sg, sum(n) AS sn, list({{'v': v, 'g': g, 'n': n}} ORDER BY v) AS ws
    FROM (
      SELECT r, v, n::DOUBLE AS n, n / (1 + exp(-(ln(share) - ln(1 - share) + list_sum(list_transform(
        range(1, 12), lambda j: good[j][v[j] + 2] - bad[j][v[j] + 2]))))) AS g
      FROM em, patterns WHERE r < 25
    ) GROUP BY r
  )
), judged AS (
  SELECT seen.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1 / (1 + exp(-(ln(share) - ln(1 - share) + list_sum(list_transform(
      range(1, 12), lambda j: good[j][v[j] + 2] - bad[j][v[j] + 2]))))) AS quality
  FROM seen, em WHERE r = 25
)
"""

QUALITY = JUDGED.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND quality >= 0.5 AS kept, round(quality, 6) AS quality
FROM judged
"""
