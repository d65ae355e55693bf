"""DuckDB twins of operators whose rows SQL can express."""

from __future__ import annotations

from .spot_signatures import ANCHORS

_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

CONVERSATION_REPAIR = f"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE code WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM given WHERE code <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), judged AS (
    SELECT *, body = '' AS blank, body <> '' AND rn > min(rn) OVER (PARTITION BY conv_id, role, text) AS duplicate, left(role, 1) AS initial,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || left(role, 1) AS border
    FROM placed
), faulty AS (
    SELECT *, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated, count(*) FILTER (border NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faulty GROUP BY conv_id
), made(q, q1, name) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
inserts AS (
    SELECT q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines, q AS q1 FROM made
    UNION ALL SELECT q, 5, 'I', [name || ':'], q1 FROM made
    UNION ALL SELECT a.q, 10, 'II', [a.name || ':', b.name || ':'], b.q1 FROM made a JOIN made b ON b.q = a.q1
), kept(q, initial, q1) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
moves AS (
    SELECT r.conv_id, r.rn, m.q, m.q AS q1, 2 AS cost, 'D' AS letter, []::VARCHAR[] AS lines FROM faulty r, made m
    UNION ALL SELECT r.conv_id, r.rn, k.q, k.q1, CASE WHEN truncated THEN 5 ELSE 0 END, 'K', [role || ':' || text] FROM faulty r JOIN kept k ON k.initial = r.initial WHERE NOT blank AND NOT duplicate
    UNION ALL SELECT r.conv_id, r.rn, m.q, m.q1, CASE WHEN truncated THEN 6 ELSE 1 END, 'R', [m.name || ':' || text] FROM faulty r, made m WHERE NOT blank AND NOT duplicate
), best(conv_id, rn, q, b) AS (
    SELECT c.conv_id, 0::BIGINT, i.q1, {{'cost': i.cost, 'audit': i.audit, 'lines': i.lines}} FROM (SELECT DISTINCT conv_id FROM given) c, inserts i WHERE i.q = 0
    UNION ALL
    SELECT s.conv_id, s.rn + 1, i.q1, min({{'cost': s.b.cost + m.cost + i.cost, 'audit': s.b.audit || m.letter || i.audit, 'lines': list_concat(list_concat(s.b.lines, m.lines), i.lines)}})
    FROM best s JOIN moves m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.rn = s.rn + 1 AND m.q = s.q JOIN inserts i ON i.q = m.q1
    GROUP BY s.conv_id, s.rn, i.q1
), ended AS (
    SELECT s.conv_id, coalesce(any_value(c.gaps), 0) AS gaps, coalesce(any_value(c.blank), 0) AS blank, coalesce(any_value(c.duplicate), 0) AS duplicate,
           coalesce(any_value(c.truncated), 0) AS truncated, coalesce(any_value(c.illegal), 0) AS illegal, min(s.b) AS b
    FROM best s LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id WHERE s.q IN (0, 3) AND s.rn = coalesce(c.n, 0) GROUP BY s.conv_id
)
SELECT conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated, illegal::BIGINT AS illegal,
       b.cost::BIGINT AS cost, b.audit AS audit, sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM ended
"""

_SIGNATURES = "('0x' || substr(md5({0}), 1, 15))::BIGINT"

SPOT_SIGNATURES = f"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS text, count(*) OVER () AS n,
           row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, ''))) - 1 AS pos
    FROM documents
), edits AS (
    SELECT a.doc_id, a.text, b.text AS next_text, substring(a.text, 1, length(a.text) - length(a.text) // 3) || substring(b.text, 1, length(a.text) // 3) AS edited
    FROM given a JOIN given b ON b.pos = (a.pos + 1) % a.n
), texts AS (
    SELECT text FROM edits UNION SELECT edited FROM edits
), split AS (
    SELECT text, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D.,;:!?"''()\\[\\]|\\x01]+'), lambda w: w <> '') AS words FROM texts
), glued AS (
    SELECT text, words, string_split(array_to_string(list_transform(words, lambda w: w || CASE WHEN w IN ({", ".join(f"'{a}'" for a in ANCHORS)}) THEN chr(1) ELSE ' ' END), ''), ' ') AS tokens
    FROM split
), parts AS (
    SELECT text, words, list_transform(tokens, lambda t: string_split(t, chr(1))) AS tokens FROM glued
), found AS (
    SELECT text, words, list_sort(list_distinct(list_transform(
        list_filter(range(1, len(tokens) - 1), lambda i: len(tokens[i]) > 1 AND tokens[i + 2][-1] <> ''),
        lambda i: {_SIGNATURES.format("tokens[i][-2] || chr(1) || tokens[i][-1] || ' ' || tokens[i + 1][-1] || ' ' || tokens[i + 2][-1]")}
    ))) AS spots
    FROM parts
), sets AS (
    SELECT text, CASE WHEN len(spots) = 0 AND len(words) > 0 THEN [{_SIGNATURES.format("array_to_string(words, ' ')")}] ELSE spots END AS spots FROM found
), met AS (
    SELECT e.doc_id, e.text, e.edited, a.spots AS own, b.spots AS edit, c.spots AS next, len(list_intersect(a.spots, b.spots)) AS with_edit, len(list_intersect(a.spots, c.spots)) AS with_next
    FROM edits e JOIN sets a ON a.text = e.text JOIN sets b ON b.text = e.edited JOIN sets c ON c.text = e.next_text
)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own, ' ') AS fingerprint, array_to_string(edit, ' ') AS edited_fingerprint,
       CASE WHEN len(own) + len(edit) = 0 THEN 1.0::DOUBLE ELSE with_edit::DOUBLE / (len(own) + len(edit) - with_edit) END AS near_edited,
       CASE WHEN len(own) + len(next) = 0 THEN 1.0::DOUBLE ELSE with_next::DOUBLE / (len(own) + len(next) - with_next) END AS near_next
FROM met
"""


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, source, leaf, now, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
    FROM (SELECT doc_id, source, {_leaf("text")} AS leaf,
                 CASE WHEN {_CRC32.format("coalesce(doc_id::VARCHAR, '1')")} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf("text")} END AS now
          FROM documents)
), nodes(lvl, source, pos, n, h) AS (
    SELECT 0, source, pos, n, leaf FROM leaves
    UNION ALL
    SELECT lvl + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lvl, source, pos // 16, n
), runs AS (
    SELECT lvl, source, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), subroots AS (
    SELECT source, h, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(lvl, pos, n, h) AS (
    SELECT 0, pos, n, h FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 16, n
), top_runs AS (
    SELECT lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY ALL
), walk(doc_id, source, leaf, lvl, pos, proof, folded) AS (
    SELECT doc_id, source, leaf, 0, pos, '', now FROM leaves
    UNION ALL
    SELECT w.doc_id, w.source, w.leaf, w.lvl + 1, w.pos // 16, w.proof || array_to_string(hs[1:w.pos % 16], '') || array_to_string(hs[w.pos % 16 + 2:], ''),
           sha256(array_to_string(hs[1:w.pos % 16], '') || w.folded || array_to_string(hs[w.pos % 16 + 2:], ''))
    FROM walk w JOIN runs r ON r.lvl = w.lvl AND r.source IS NOT DISTINCT FROM w.source AND r.run = w.pos // 16
), climb(doc_id, leaf, subroot, lvl, pos, proof, folded) AS (
    SELECT w.doc_id, w.leaf, s.h, 0, s.pos, w.proof, w.folded FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source AND s.height = w.lvl
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.lvl + 1, c.pos // 16, c.proof || array_to_string(hs[1:c.pos % 16], '') || array_to_string(hs[c.pos % 16 + 2:], ''),
           sha256(array_to_string(hs[1:c.pos % 16], '') || c.folded || array_to_string(hs[c.pos % 16 + 2:], ''))
    FROM climb c JOIN top_runs r ON r.lvl = c.lvl AND r.run = c.pos // 16
)
SELECT c.doc_id, c.leaf, c.subroot, t.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.h AS verified
FROM climb c JOIN tops t ON t.n = 1 AND t.lvl = c.lvl
"""
