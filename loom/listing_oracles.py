"""SQL for listing_queries."""

from __future__ import annotations

from loom.functions.sequences import AMINO_ACIDS
from loom.oracles import BUILD, CLOSE, SEQS, _own, cross, events, kmers, sizes


def oracle_sql() -> dict[str, str]:
    core = _own()
    return {
        "coupling_size_order": f"WITH {events(CLOSE)} SELECT row_number() OVER (ORDER BY size DESC, class1, class2) AS place, class1, class2, size FROM totals",
        "rep_group_report": f"""WITH RECURSIVE {BUILD}, groups AS (SELECT level, ref_id, count(*) FILTER (represented) AS members FROM placed GROUP BY ALL)
            SELECT r.level, row_number() OVER (PARTITION BY r.level ORDER BY coalesce(members, 0) DESC, r.id) AS place, r.id AS rep_id, 'turn ' || r.id AS name, rating, coalesce(members, 0) AS members
            FROM reps r JOIN rated USING (id) LEFT JOIN groups g ON g.level = r.level AND g.ref_id = r.id""",
        "error_order": f"SELECT *, row_number() OVER (ORDER BY mean_error DESC, sd_error DESC, id) AS place FROM ({core['error_summary']})",
        "triplet_counts": f"""WITH letters AS (SELECT unnest(string_split('{AMINO_ACIDS}', '')) AS x, unnest(range(20)) AS d),
            every AS (SELECT (a.d * 400 + b.d * 20 + c.d)::INT AS number, a.x || b.x || c.x AS triplet FROM letters a, letters b, letters c),
            found AS (SELECT substring(p, i::INT, 3) AS triplet, count(*) AS n FROM (SELECT p, unnest(range(1, length(p) - 1)) AS i FROM (SELECT translate(text, '{AMINO_ACIDS.lower()}', '{AMINO_ACIDS}') AS p FROM conversations)) GROUP BY 1)
            SELECT number, triplet, coalesce(n, 0) AS n FROM every LEFT JOIN found USING (triplet)""",
        "random_family_members": """WITH own AS (SELECT user_id AS genome, event_id AS fid, 'f' || floor(value / 20)::BIGINT AS class FROM events WHERE value >= 10), s AS (SELECT unnest([0, 1]) AS seed),
            a AS (SELECT genome, fid, row_number() OVER (PARTITION BY genome ORDER BY fid) AS n FROM own),
            b AS (SELECT genome, class, seed, row_number() OVER (PARTITION BY genome, seed ORDER BY md5(genome || ':' || fid || ':' || seed), fid) AS n FROM own, s)
            SELECT genome, fid, class, seed::INT AS seed FROM a JOIN b USING (genome, n)""",
        "rep_classify_filtered": f"""SELECT c.* FROM ({core['rep_classify_levels']}) c WHERE c.id // 100 % 3 < 2 AND c.id // 100 IN (SELECT conv_id FROM conversations WHERE role = 'assistant')""",
        "descriptor_table": r"""SELECT conv_id || '.' || turn * 10 AS genome_id, role AS genome_name, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS seed_md5, md5(text) AS ssu_rna FROM conversations""",
        "nearest_of_all_others": f"""WITH {SEQS}, {kmers()}, {sizes('kmers', 'sizes')}, u AS (SELECT k.* FROM kmers k JOIN seqs USING (id) WHERE role <> 'assistant'),
            a AS (SELECT k.* FROM kmers k JOIN seqs USING (id) WHERE role = 'assistant'), {cross('u', 'a')},
            best AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS ref_id, max(sim) AS sim FROM sims GROUP BY id)
            SELECT x.id, ref_id, coalesce(sim, 0) AS sim, CASE WHEN sim IS NULL THEN 1 ELSE 1.0::DOUBLE - sim::DOUBLE / (m.n + r.n - sim) END AS distance, coalesce(sim, 0) < 10 AS outlier
            FROM (SELECT DISTINCT id FROM u) x LEFT JOIN best USING (id) LEFT JOIN sizes m ON m.id = x.id LEFT JOIN sizes r ON r.id = ref_id""",
    }
