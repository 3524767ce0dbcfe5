"""SQL for mechanism_queries."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return {
        "hierarchy_depths": """WITH RECURSIVE own AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 97 = 1 THEN NULL WHEN c_custkey % 211 = 5 THEN c_custkey + 4
                WHEN c_custkey % 499 = 0 THEN -c_custkey ELSE c_custkey - 1 - c_nationkey % 3 END AS parent FROM customer),
            up AS (SELECT o.id, p.id AS above FROM own o JOIN own p ON p.id = o.parent UNION SELECT up.id, p.id FROM up JOIN own o ON o.id = up.above JOIN own p ON p.id = o.parent),
            ends AS (SELECT o.id, o.parent IS NULL AS top FROM own o LEFT JOIN own p ON p.id = o.parent WHERE p.id IS NULL),
            reach AS (SELECT id, count(*) AS depth, max(CASE WHEN e.top IS NOT NULL THEN above END) AS root, bool_or(above = up.id) AS turns FROM up LEFT JOIN (SELECT id AS e, top FROM ends) e ON e.e = above GROUP BY id)
            SELECT o.id, coalesce(root, e.id) AS root, CASE WHEN e.id IS NOT NULL THEN 0 WHEN root IS NOT NULL THEN depth END AS depth,
                CASE WHEN top THEN 'root' WHEN NOT top THEN 'orphan' WHEN root IS NOT NULL THEN 'below' WHEN turns THEN 'cycle' ELSE 'above cycle' END AS state
            FROM own o LEFT JOIN ends e USING (id) LEFT JOIN reach r ON r.id = o.id""",
        "class_set_sizes": """WITH e AS (SELECT event_type, floor(value / 20)::BIGINT AS family, user_id FROM events), k AS (SELECT DISTINCT event_type, user_id FROM e WHERE user_id IS NOT NULL),
            pairs AS (SELECT * FROM (VALUES ('click', 'view'), ('error', 'view'), ('click', 'error'), ('click', 'nothing')) v(one, two))
            SELECT 'family' AS part, event_type AS one, family::VARCHAR AS two, count(DISTINCT user_id) AS n FROM e WHERE user_id IS NOT NULL GROUP BY ALL
            UNION ALL SELECT 'kind', event_type, NULL, count(*) FROM k GROUP BY ALL
            UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT user_id) FROM k
            UNION ALL SELECT 'both', one, two, (SELECT count(*) FROM k x JOIN k y USING (user_id) WHERE x.event_type = one AND y.event_type = two) FROM pairs""",
        "rejected_documents": """WITH d AS (SELECT *, CASE WHEN trim(coalesce(text, ''), ' ') = '' THEN 'no text' WHEN lang IS NULL THEN 'no language' WHEN n_chars < 200 THEN 'short' END AS reason FROM documents),
            s AS (SELECT count(*) AS rows_read, count(*) FILTER (reason IS NULL) AS rows_kept, max(n_chars) FILTER (reason IS NULL)::BIGINT AS longest, sum(n_chars) FILTER (reason IS NULL)::BIGINT AS chars FROM d)
            SELECT doc_id, reason, rows_read, rows_kept, longest, chars FROM d, s WHERE reason IS NOT NULL""",
    }
