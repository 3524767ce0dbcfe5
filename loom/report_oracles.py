"""What the queries of report_queries return, as SQL."""

from __future__ import annotations

from loom.functions.sequences import AMINO_ACIDS, FAR
from loom.oracles import BUILD, CUSTOMERS, GOOD, SEQS, USERS, _own, cross, kmers, near, own, pairs, sizes, walk
from loom.queries import LEVELS


def oracle_sql() -> dict[str, str]:
    base = _own()
    adjacent = base["coupling_adjacent"].rsplit("SELECT", 1)[0]
    return {
        "seq_test_outliers": f"""WITH {SEQS}, {kmers(8, 'k8')}, {kmers(12, 'k12')}, {own('u8', 'user', 'k8')}, {own('a8', 'assistant', 'k8')}, {own('u12', 'user', 'k12')}, {own('a12', 'assistant', 'k12')},
            {cross('u8', 'a8', 's8')}, {cross('u12', 'a12', 's12')},
            b8 AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS rep, max(sim) AS sim FROM s8 GROUP BY id), b12 AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS rep, max(sim) AS sim FROM s12 GROUP BY id),
            o AS (SELECT id, b8.rep AS seed_rep, b8.sim AS seed_sim, b12.rep AS rna_rep, b12.sim AS rna_sim FROM b8 JOIN b12 USING (id) WHERE b8.rep <> b12.rep)
            SELECT o.*, coalesce((SELECT sim FROM s12 s WHERE s.id = o.id AND s.ref_id = seed_rep), 0) AS seed_rep_rna_sim, coalesce((SELECT sim FROM s8 s WHERE s.id = o.id AND s.ref_id = rna_rep), 0) AS rna_rep_seed_sim,
                   (SELECT count(*) FROM a8 x JOIN a8 y USING (kmer) WHERE x.id = seed_rep AND y.id = rna_rep) AS ref_seed_sim, (SELECT count(*) FROM a12 x JOIN a12 y USING (kmer) WHERE x.id = seed_rep AND y.id = rna_rep) AS ref_rna_sim FROM o""",
        "updated_assignments": f"""WITH RECURSIVE {SEQS}, {kmers(8, 'k8')}, both_kinds AS (SELECT k.* FROM k8 k JOIN seqs USING (id) WHERE role IN ('user', 'assistant')), {sizes('both_kinds', 'sizes')}, {pairs('both_kinds')},
            old AS (SELECT DISTINCT id FROM both_kinds JOIN seqs USING (id) WHERE role = 'assistant'), mine AS (SELECT DISTINCT id FROM both_kinds JOIN seqs USING (id) WHERE role = 'user'),
            {walk('kept', 'id', near('sim >= 10'), 'old', 'SELECT DISTINCT id FROM both_kinds')},
            added AS (SELECT id FROM kept WHERE id IN (SELECT id FROM mine)),
            ends AS (SELECT id1 AS id, id2 AS ref_id, sim, distance FROM pairs UNION ALL SELECT id2, id1, sim, distance FROM pairs),
            top AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS ref_id, max(sim) AS sim, arg_min(distance, (-sim, ref_id)) AS distance FROM ends
              WHERE id IN (SELECT id FROM mine) AND (ref_id IN (SELECT id FROM old) OR (ref_id IN (SELECT id FROM added) AND ref_id < id)) GROUP BY id)
            SELECT id, id AS ref_id, 9999 AS sim, 0.0::DOUBLE AS distance, true AS outlier FROM added UNION ALL SELECT id, ref_id, sim, distance, false FROM top WHERE sim >= 10 AND id NOT IN (SELECT id FROM added)""",
        "unrepresented": f"WITH {USERS} SELECT x.id, coalesce(max(sim), 0) AS sim FROM (SELECT DISTINCT id FROM u) x LEFT JOIN sims s ON s.id = x.id GROUP BY x.id HAVING coalesce(max(sim), 0) < 10",
        "both_sequences": f"""WITH {SEQS}, t AS (SELECT conv_id, role, arg_min(turn, (-length(seq), turn)) AS turn, max(length(seq)) AS letters FROM seqs WHERE seq IS NOT NULL GROUP BY ALL)
            SELECT conv_id, a.turn AS seed_turn, a.letters AS seed_letters, b.turn AS ssu_turn, b.letters AS ssu_letters FROM t a JOIN t b USING (conv_id) WHERE a.role = 'user' AND b.role = 'assistant'""",
        "domain_universal_roles": """WITH f AS (SELECT l_orderkey AS genome, p_type AS role FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O')),
            one AS (SELECT genome, role FROM f GROUP BY ALL HAVING count(*) = 1), n AS (SELECT count(DISTINCT genome) AS n FROM f)
            SELECT role, count(*) AS count, round(count(*) * 100.0::DOUBLE / n, 6) AS percent FROM one, n GROUP BY role, n HAVING count(*) >= floor(floor(10.0 * n + 99) / 100)""",
        "seeded_roles": "SELECT event_type AS role, count(*) AS n, count(DISTINCT user_id) AS genomes FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'error') GROUP BY event_type",
        "ssu_features": "SELECT p_partkey, p_size AS length FROM part WHERE (p_type ILIKE '%medium%' OR p_type ILIKE '%promo%') AND p_size >= 20",
        "checksum_sequences": """WITH known AS (SELECT md5(text) AS md5, min(text) AS seq FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark WHERE item_id % 2 = 0) WHERE text IS NOT NULL GROUP BY 1)
            SELECT item_id, md5(text) AS md5, length(seq) AS letters FROM benchmark LEFT JOIN known ON known.md5 = md5(text)""",
        "missing_roles_taxonomy": f"""WITH {CUSTOMERS}, m AS ({base['missing_roles'].replace('WITH f AS', 'SELECT * FROM (WITH f AS')}))
            SELECT role, row_number() OVER (PARTITION BY role ORDER BY n_regionkey, c_nationkey, genome) AS place, genome, count, type, n_regionkey || ', ' || c_nationkey AS taxonomy FROM m JOIN cust ON c_custkey = genome""",
        "coupling_genome_counts": f"{adjacent.rstrip()} SELECT genome, count(*) AS couplings FROM (SELECT DISTINCT o.genome, fid1, fid2 FROM occ o JOIN totals t ON t.class1 = o.class1 AND t.class2 = o.class2 WHERE size >= 20) GROUP BY genome",
        "coupling_run_stats": f"{adjacent.rstrip()} SELECT count(*) AS pairs, round(avg(size), 6) AS mean_size, max(size) AS max_size FROM totals WHERE size >= 20",
        "coupling_reread": f"{adjacent.rstrip()} SELECT class1, class2, size, weight AS strength FROM totals",
        "coupling_named": f"{adjacent.rstrip()} SELECT class1, CASE WHEN class1 LIKE 'f%' THEN 'family ' || substring(class1, 2, 9) ELSE '' END AS family_product1, class2, CASE WHEN class2 LIKE 'f%' THEN 'family ' || substring(class2, 2, 9) ELSE '' END AS family_product2, size FROM totals",
        "coupling_by_checksum": "SELECT 'X' || (event_id % 50) % 7 AS class, count(*) AS n, count(DISTINCT user_id) AS genomes FROM events WHERE event_id % 50 < 40 GROUP BY 1",
        "role_ids": """WITH names AS (SELECT p_type AS role FROM part UNION SELECT lower(p_type) || '  # note' FROM part)
            SELECT role, substring(md5(trim(regexp_replace(lower(trim(regexp_replace(role, '\\s*#.*$', ''))), '[^a-z0-9]+', ' ', 'g'))), 1, 12) AS role_id FROM names""",
        "multi_parent_report": f"""WITH {GOOD}, m AS (SELECT *, count(*) OVER (PARTITION BY level, id) AS n, row_number() OVER (PARTITION BY level, id ORDER BY parent) AS place FROM edges)
            SELECT level, id, place, CASE WHEN place = 1 THEN id::VARCHAR ELSE '' END AS child, CASE WHEN place = 1 THEN 'rep' || level ELSE '' END AS set_name, parent FROM m WHERE n > 1""",
        "without_species": "SELECT c_custkey AS id FROM customer WHERE c_custkey % 4 = 0",
        "fully_placed": f"WITH RECURSIVE {BUILD} SELECT id FROM placed WHERE represented GROUP BY id HAVING count(DISTINCT level) >= {len(LEVELS)}",
        "feature_texts": """WITH e AS (SELECT *, event_id AS n, event_id % 100 AS l,
              CASE WHEN event_id % 7 > 0 THEN 'acgt' || repeat('n', (event_id % 8)::INT) || 'acgt' END AS dna,
              CASE WHEN event_id % 11 > 0 THEN CASE WHEN event_id % 4 = 0 THEN 'MAXX' || event_type ELSE 'MA' || upper(event_type) END END AS protein FROM events),
            f AS (SELECT *, CASE WHEN protein IS NULL THEN [] ELSE list_distinct(list_transform(range(1, length(protein)), lambda i: substring(protein, i::INT, 2))) END AS ks,
                  list_distinct(list_transform(range(1, 9), lambda i: substring('MAXXCLICK', i::INT, 2))) AS ref FROM e)
            SELECT event_id, CASE WHEN n % 5 > 0 THEN user_id || '.' || (n % 30) END AS genome, CASE WHEN n % 3 = 0 THEN n || chr(9) || 'end' ELSE '' END AS after_tab,
              CASE WHEN dna IS NULL THEN 'missing DNA' WHEN protein IS NULL THEN 'missing protein' WHEN n % 4 = 0 THEN 'ambiguous protein' END AS reason,
              dna IS NOT NULL AND n % 8 < 5 AS valid, CASE WHEN n % 2 = 0 THEN greatest(50 - (l + 20), l - 70) ELSE 2147483647 END AS gap,
              CASE WHEN n % 13 = 0 THEN 'MAX' ELSE (n % 50)::VARCHAR END AS shown, round(1.0::DOUBLE / (n % 50 + 1), 9) AS inverse, len(list_intersect(ks, ref)) AS shared,
              CASE WHEN protein IS NULL THEN NULL WHEN instr(@@AA@@, protein[3]) = 0 THEN -1 ELSE (instr(@@AA@@, 'M') - 1) * 400 + (instr(@@AA@@, 'A') - 1) * 20 + instr(@@AA@@, protein[3]) - 1 END AS triplet FROM f""".replace("@@AA@@", f"'{AMINO_ACIDS}'").replace("2147483647", str(FAR)),
        "rank_correlation": """WITH p AS (SELECT p_partkey AS i, p_size::DOUBLE AS x, p_retailprice AS y FROM part)
            SELECT (SELECT count(*) FROM p) AS n, round(sum(sign(a.x - b.x) * sign(a.y - b.y)) / sqrt(sum(abs(sign(a.x - b.x)))::DOUBLE * sum(abs(sign(a.y - b.y)))), 6) AS tau FROM p a JOIN p b ON a.i < b.i""",
        "natural_order": "SELECT (user_id % 20) || '.' || user_id AS id, row_number() OVER (PARTITION BY user_id % 20 ORDER BY user_id) AS place FROM (SELECT DISTINCT user_id FROM events)",
        "local_families": "SELECT 'L' || (user_id % 4) || '_' || (event_id % 9) AS class, count(*) AS n, count(DISTINCT user_id) AS genomes FROM events WHERE event_id % 6 > 0 GROUP BY 1",
        "random_families": "SELECT user_id AS genome, 'f' || floor(value / 20)::BIGINT AS class, count(*) AS n FROM events WHERE value >= 10 GROUP BY ALL",
        "resume_after": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > (SELECT min(o_orderkey) FROM orders WHERE o_custkey = 7)",
        "seed_proteins": "SELECT user_id AS genome, arg_min(lpad(event_id::VARCHAR, 9, '0'), (-length(props), event_id)) AS fid, max(length(props)) + 1 AS letters FROM events WHERE event_type IN ('click', 'error') GROUP BY user_id",
        "flagged": "SELECT c_custkey AS id, c_custkey % 4 < 2 AS good FROM customer",
        "level_folders": f"WITH RECURSIVE {BUILD} SELECT level, r.id, domain, rating FROM reps r JOIN rated USING (id)",
        "genome_modes": f"""WITH RECURSIVE {BUILD}, t AS (
              SELECT 'lists' AS name, (SELECT count(*) FROM placed) AS n UNION ALL SELECT 'groups', (SELECT count(*) FROM (SELECT DISTINCT level, ref_id FROM placed))
              UNION ALL SELECT 'good', (SELECT count(*) FROM rated) UNION ALL SELECT 'finder', (SELECT count(*) FROM placed WHERE level = {max(LEVELS)}) UNION ALL SELECT 'genomes', (SELECT count(*) FROM reps))
            SELECT mode, name, n FROM t, (VALUES ('YES'), ('NO'), ('ONLY')) m(mode) WHERE mode = 'YES' OR (name = 'genomes') = (mode = 'ONLY')""",
    }
