"""SQL that gives the same rows as the registered queries, for another engine."""

from __future__ import annotations

from millrace.llm.chats_sql import CHATS
from millrace.llm.mixing_sql import MIXING
from millrace.llm.quality_sql import QUALITY
from millrace.llm.search_sql import SEARCH
from millrace.llm.trie_sql import TRIE
from millrace.llm.vectors_sql import VECTORS

NEAR_DUPLICATES = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM {docs}
), words AS (
  SELECT doc_id, regexp_extract_all(coalesce(t, ''), '[^\x20\x09-\x0D]+') AS w FROM texts
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), ends AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(x, y) AS (
  SELECT x, y FROM ends UNION SELECT reach.x, ends.y FROM reach JOIN ends ON reach.y = ends.x
), smallest AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
), near AS (
  SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(m, w.doc_id), w.doc_id) AS component_id
  FROM words w LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON x = w.doc_id
)
"""

SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op2_source_mixing": MIXING,
    "op5_embedding_near_dedup": VECTORS,
    "op10_tool_calls": CHATS,
    "op11_lexical_search": SEARCH,
    "op12_prefix_trie": TRIE,
    "op6_minhash_near_dedup": NEAR_DUPLICATES.format(docs="documents")
    + "SELECT *, component_id = doc_id AS kept FROM near",
}
