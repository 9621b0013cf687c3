"""Tool-call linking over the derived agent log, in SQL."""

from __future__ import annotations

CHATS = r"""
WITH RECURSIVE log AS (
  SELECT conv_id, turn, role, text, length(text) AS n, 'call_' || conv_id || '_' || turn AS call_id,
         role = 'assistant' AS asks, role = 'user' AND turn > 0 AS answers
  FROM conversations
), calls AS (
  SELECT conv_id, turn, call_id, text, n, n % 3 AS kind,
         CASE WHEN n % 3 = 1 AND (turn // 2) % 3 <> 0 THEN 'call_' || conv_id || '_' || (turn - 2) END AS ref
  FROM log WHERE asks
), firsts AS (
  SELECT conv_id, call_id, min(turn) AS called FROM calls GROUP BY ALL
), results AS (
  SELECT *, 'call_' || conv_id || '_' || CASE WHEN n % 7 = 0 THEN 'none' ELSE (turn - 1)::VARCHAR END AS asked
  FROM log WHERE answers
), answered AS (
  SELECT f.call_id, min(r.turn) AS answered FROM firsts f JOIN results r ON r.asked = f.call_id AND r.turn > f.called GROUP BY ALL
), edges AS (
  SELECT DISTINCT c.call_id, c.ref, f.call_id IS NOT NULL AS known
  FROM calls c LEFT JOIN firsts f ON f.call_id = c.ref WHERE c.ref IS NOT NULL
), depth(call_id, level) AS (
  SELECT call_id, 0 FROM firsts WHERE call_id NOT IN (SELECT call_id FROM edges WHERE known)
  UNION
  SELECT edges.call_id, level + 1 FROM edges JOIN depth ON depth.call_id = edges.ref WHERE known
), levels AS (
  SELECT call_id, max(level) AS level FROM depth GROUP BY call_id
)
SELECT conv_id, turn, 0::BIGINT AS level, '' AS status,
       to_json({'content': text, 'role': role})::VARCHAR AS json
FROM log WHERE NOT asks AND NOT answers
UNION ALL
SELECT r.conv_id, r.turn, coalesce(CASE WHEN called < r.turn THEN 2 * level + 1 END, 0)::BIGINT,
       CASE WHEN called IS NULL OR called >= r.turn THEN 'orphan' WHEN r.turn <> answered THEN 'repeated' ELSE '' END,
       to_json({'content': text, 'role': 'tool', 'tool_call_id': asked})::VARCHAR
FROM results r LEFT JOIN firsts f ON f.call_id = r.asked LEFT JOIN levels l ON l.call_id = r.asked
  LEFT JOIN answered a ON a.call_id = r.asked
UNION ALL
SELECT c.conv_id, c.turn, (2 * level)::BIGINT,
       array_to_string(list_sort(list_filter([
         CASE WHEN e.call_id IS NOT NULL AND NOT known THEN 'unknown_ref' END,
         CASE WHEN answered IS NULL THEN 'unanswered' END,
         CASE WHEN kind = 0 AND n % 13 NOT BETWEEN 1 AND 10 THEN 'value:limit' END,
         CASE WHEN kind = 2 AND n % 5 = 4 THEN 'value:lang' END], lambda x: x IS NOT NULL)), ','),
       CASE kind
         WHEN 0 THEN '{"role":"assistant","tool_calls":[{"arguments":' || to_json({'limit': n % 13, 'query': text})
         WHEN 1 THEN '{"content":' || to_json(text) || ',"role":"assistant","tool_calls":[{"arguments":' ||
           CASE WHEN c.ref IS NULL THEN to_json({'key': md5(text)}) ELSE to_json({'key': md5(text), 'of': '$ref:' || c.ref}) END
         ELSE '{"role":"assistant","tool_calls":[{"arguments":' ||
           to_json({'lang': ['de', 'en', 'es', 'fr', 'xx'][n % 5 + 1], 'text': text}) END
       || ',"id":' || to_json(c.call_id) || ',"name":"' || ['search', 'lookup', 'translate'][kind + 1] || '"}]}'
FROM calls c LEFT JOIN levels USING (call_id) LEFT JOIN answered USING (call_id) LEFT JOIN edges e USING (call_id)
"""
