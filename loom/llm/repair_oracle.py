"""SQL for op11_conversation_repair: the same edits by a recursive query over the turns, one column for each state of a dialogue."""


def _add(v: str, cost: str, letter: str) -> str:
    """A value (nine digits of cost, then the audit) with an edit; least() of such values is the cheapest, then the ASCII-least."""
    return f"(lpad((substr({v}, 1, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || substr({v}, 10) || '{letter}')"


def _spoken(before: str, initial: str, more: str = "") -> list[str]:
    keep = f"CASE WHEN ini = '{initial}' THEN {_add(before, 'late', 'K')} END"
    return [keep, _add(before, "3 + late", "R")] if initial != "s" else [keep]


def _state(own: str, ways: list[str]) -> str:
    return f"CASE WHEN gone THEN {_add(own, '4', 'D')} ELSE least({', '.join([_add(own, '4', 'D'), *ways])}) END"


_USER = [x for before in ("v0", "v1", "v3") for x in _spoken(before, "u")]

REPAIR_SQL = rf"""
            WITH RECURSIVE crc AS (
              SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
            keyed AS (
              SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
                       lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 20 AS kind
              FROM conversations, crc),
            turns AS (
              SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                     CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
              FROM keyed WHERE kind <> 0),
            placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM turns),
            faults AS (
              SELECT *, rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS said, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                     substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM placed),
            marked AS (
              SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT contains('.!?', right(said, 1)) THEN 'truncated' ELSE '' END AS fault FROM faults),
            counted AS (
              SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                     count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
                     list(ini ORDER BY i) AS inis, list(fault IN ('blank', 'duplicate') ORDER BY i) AS goes, list(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END ORDER BY i) AS lates
              FROM marked GROUP BY conv_id),
            parse(conv_id, inis, goes, lates, i, v0, v1, v2, v3) AS (
              SELECT conv_id, inis, goes, lates, 1, '000000000', NULL::VARCHAR, '000000003I', '000000006II' FROM counted
              UNION ALL
              SELECT conv_id, inis, goes, lates, i, w0, w1, u2, least(w3, {_add('u2', '3', 'I')})
              FROM (
                SELECT *, least(w2, {_add('w0', '3', 'I')}, {_add('w1', '3', 'I')}, {_add('w3', '3', 'I')}) AS u2
                FROM (
                  SELECT conv_id, inis, goes, lates, i + 1 AS i, {_add('v0', '4', 'D')} AS w0,
                         {_state('v1', _spoken('v0', 's'))} AS w1,
                         {_state('v2', _USER)} AS w2,
                         {_state('v3', _spoken('v2', 'a'))} AS w3
                  FROM (SELECT *, inis[i] AS ini, goes[i] AS gone, lates[i] AS late FROM parse WHERE i <= len(inis))))),
            best AS (SELECT conv_id, least(v0, v3) AS v FROM parse WHERE i = len(inis) + 1),
            edits AS (
              SELECT conv_id, k, substr(v, 9 + k, 1) AS edit, len(replace(substr(v, 10, k), 'I', '')) AS i, len(replace(substr(v, 10, k), 'D', '')) AS o
              FROM (SELECT conv_id, v, unnest(range(1, len(v) - 8)) AS k FROM best)),
            spoken AS (
              SELECT e.*, m.text, m.role, max(CASE WHEN o = 1 AND edit = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
              FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i AND e.edit IN ('K', 'R') WHERE edit <> 'D'),
            said AS (
              SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY o) AS whole
              FROM spoken GROUP BY conv_id)
            SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated,
                   coalesce(n.illegal, 0) AS illegal, coalesce(substr(b.v, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(b.v, 10), '') AS audit, sha256(coalesce(s.whole, '')) AS repaired_sha256
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
            LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM c.conv_id"""
