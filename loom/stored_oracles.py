"""SQL for stored_queries."""

from __future__ import annotations

from loom.oracles import ALL, RATED, SEQS, kmers, near, sizes, walk
from loom.queries import LEVELS
from loom.stored_queries import LOOKED_UP


def _updates() -> str:
    """Representatives after each of two updates: at a level, those of the update before and of the coarser level are seeds."""
    out = []
    for batch in (0, 1):
        for place, level in enumerate(LEVELS):
            seeds = [f"SELECT id FROM b{batch - 1}l{level}"] if batch else []
            seeds += [f"SELECT id FROM b{batch}l{LEVELS[place - 1]}"] if place else []
            name = f"b{batch}l{level}"
            out.append(f"s_{name} AS MATERIALIZED ({' UNION '.join(seeds) or 'SELECT id FROM rated WHERE false'})")
            nodes = f"SELECT id, ord, score FROM rated WHERE (id // 100 % 3 = 0)::INT = {batch}"
            out.append(walk(name, "ord, score DESC, id", near(f"sim >= {level}"), f"s_{name}", nodes))
    return ", ".join(out) + ", reps AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {n} AS level, id FROM b1l{n}" for n in LEVELS) + ")"


def oracle_sql() -> dict[str, str]:
    return {
        "fasta_records": r"""SELECT role || ':' || conv_id || ':' || turn AS label, role AS comment, length(s)::BIGINT AS letters, md5(s) AS md5
            FROM (SELECT *, regexp_replace(text, '\s', '', 'g') AS s FROM conversations WHERE role <> 'system')""",
        "genome_lookup": f"""SELECT conv_id::VARCHAR AS id, conv_id || '.' || turn AS fid, role AS function, length(text)::BIGINT AS letters FROM conversations
            WHERE conv_id BETWEEN {LOOKED_UP[0]} AND {LOOKED_UP[-1]}""",
        "admitted_once": "SELECT DISTINCT user_id, event_type FROM events",
        "running_representatives": f"""WITH RECURSIVE {SEQS}, {kmers()}, own AS MATERIALIZED (SELECT k.*, conv_id AS grp FROM kmers k JOIN seqs USING (id)), {sizes('kmers', 'sizes')},
            pairs AS MATERIALIZED (SELECT a.id AS id1, b.id AS id2, count(*) AS sim FROM own a JOIN own b USING (grp, kmer) WHERE a.id < b.id GROUP BY ALL),
            {walk('kept', 'id', near(f'sim >= {min(LEVELS)}'))},
            best AS (SELECT id2 AS id, arg_min(id1, (-sim, id1)) AS ref_id, max(sim) AS sim FROM pairs JOIN kept ON kept.id = id1 GROUP BY id2)
            SELECT s.conv_id AS grp, s.id, CASE WHEN k.id IS NULL THEN ref_id ELSE s.id END AS ref_id, CASE WHEN k.id IS NULL THEN sim ELSE 9999 END AS sim,
                   CASE WHEN k.id IS NULL THEN 1 - sim::DOUBLE / (x.n + y.n - sim) ELSE 0 END AS distance, k.id IS NOT NULL AS added
            FROM seqs s LEFT JOIN kept k ON k.id = s.id LEFT JOIN best b ON b.id = s.id LEFT JOIN sizes x ON x.id = s.id LEFT JOIN sizes y ON y.id = ref_id""",
        "incremental_build": f"""WITH RECURSIVE {ALL}, {RATED}, {_updates()},
            members AS (SELECT level, k.id AS ref_id, kmer FROM reps JOIN kmers k USING (id)),
            shared AS (SELECT k.id, level, ref_id, count(*) AS sim FROM kmers k JOIN members USING (kmer) GROUP BY ALL)
            SELECT s.id, s.level, ref_id, sim, 1.0::DOUBLE - sim::DOUBLE / (x.n + y.n - sim) AS distance, sim >= s.level AS represented, r.id IS NOT NULL AS representative
            FROM (SELECT *, row_number() OVER (PARTITION BY id, level ORDER BY sim DESC, ref_id) AS place FROM shared) s
            JOIN sizes x ON x.id = s.id JOIN sizes y ON y.id = ref_id LEFT JOIN reps r ON r.id = s.id AND r.level = s.level WHERE place = 1""",
    }
