"""What each registered query returns, as SQL over the same tables."""

from __future__ import annotations

from loom.queries import LEVELS, REACH, K

SEQS = "seqs AS (SELECT conv_id * 100 + turn AS id, conv_id, turn, role, text AS seq FROM conversations)"


def kmers(k: int = K, name: str = "kmers") -> str:
    return f"{name} AS MATERIALIZED (SELECT DISTINCT id, substring(seq, i::INT, {k}) AS kmer FROM (SELECT id, seq, unnest(range(1, length(seq) - {k} + 2)) AS i FROM seqs))"


def own(name: str, role: str, source: str = "kmers") -> str:
    return f"{name} AS (SELECT k.id, kmer FROM {source} k JOIN seqs USING (id) WHERE role = '{role}')"


def sizes(source: str, name: str) -> str:
    return f"{name} AS MATERIALIZED (SELECT id, count(*) AS n FROM {source} GROUP BY id)"


def pairs(source: str = "kmers", name: str = "pairs", size: str = "sizes") -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT id1, id2, sim, CASE WHEN x.n + y.n - sim > 0 THEN 1.0::DOUBLE - sim::DOUBLE / (x.n + y.n - sim) ELSE 1 END AS distance FROM "
        f"(SELECT a.id AS id1, b.id AS id2, count(*) AS sim FROM {source} a JOIN {source} b USING (kmer) WHERE a.id < b.id GROUP BY ALL) p "
        f"JOIN {size} x ON x.id = id1 JOIN {size} y ON y.id = id2)"
    )


def cross(q: str, r: str, name: str = "sims") -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT p.id, ref_id, sim, 1.0::DOUBLE - sim::DOUBLE / (x.n + y.n - sim) AS distance FROM "
        f"(SELECT a.id, b.id AS ref_id, count(*) AS sim FROM {q} a JOIN {r} b USING (kmer) GROUP BY ALL) p "
        f"JOIN (SELECT id, count(*) AS n FROM {q} GROUP BY id) x USING (id) JOIN (SELECT id, count(*) AS n FROM {r} GROUP BY id) y ON y.id = ref_id)"
    )


ALL = f"{SEQS}, {kmers()}, {sizes('kmers', 'sizes')}, {pairs()}"
USERS = f"{SEQS}, {kmers()}, {own('u', 'user')}, {own('a', 'assistant')}, {cross('u', 'a')}"


def walk(name: str, order: str, edges: str, seeds: str | None = None, nodes: str = "SELECT id FROM seqs") -> str:
    """The sequential walk: one node after another, kept when no kept node is its neighbour."""
    start = f"(SELECT coalesce(list(id), []) FROM {seeds})" if seeds else "[]::BIGINT[]"
    return f"""
      {name}_n AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY {order}) AS n FROM ({nodes})),
      {name}_e AS MATERIALIZED (SELECT id, list(other) AS near FROM ({edges}) GROUP BY id),
      {name}_o AS MATERIALIZED (SELECT n, id, coalesce(near, [-1]::BIGINT[]) AS near FROM {name}_n LEFT JOIN {name}_e USING (id)),
      {name}_w AS (
        SELECT 0::BIGINT AS n, {start} AS kept
        UNION ALL
        SELECT o.n, CASE WHEN list_contains(w.kept, o.id) OR list_has_any(w.kept, o.near) THEN w.kept ELSE list_append(w.kept, o.id) END
        FROM {name}_w w JOIN {name}_o o ON o.n = w.n + 1),
      {name} AS MATERIALIZED (SELECT unnest(kept) AS id FROM (SELECT kept FROM {name}_w ORDER BY n DESC LIMIT 1))"""


def near(limit: str, source: str = "pairs") -> str:
    return f"SELECT id1 AS id, id2 AS other FROM {source} WHERE {limit} UNION ALL SELECT id2, id1 FROM {source} WHERE {limit}"


def levels(order: str, source: str = "pairs", nodes: str = "SELECT id FROM seqs") -> str:
    out, seeds = [], None
    for n in LEVELS:
        out.append(walk(f"l{n}", order, near(f"sim >= {n}", source), seeds, nodes))
        seeds = f"l{n}"
    return ",".join(out) + ", reps AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {n} AS level, id FROM l{n}" for n in LEVELS) + ")"


RATED = """rated AS MATERIALIZED (SELECT id, role AS domain, length(seq)::DOUBLE AS score,
      CASE role WHEN 'system' THEN 'NCBI_REF' WHEN 'assistant' THEN 'NCBI_REP' ELSE 'NORMAL' END AS rating,
      CASE role WHEN 'system' THEN 0 WHEN 'assistant' THEN 1 ELSE 2 END AS ord FROM seqs)"""
BUILD = f"""{ALL}, {RATED}, {levels('ord, score DESC, id', nodes='SELECT id, ord, score FROM rated')},
    members AS (SELECT level, k.id AS ref_id, kmer FROM reps JOIN kmers k USING (id)),
    shared AS (SELECT k.id, level, ref_id, count(*) AS sim FROM kmers k JOIN members USING (kmer) GROUP BY ALL),
    placed AS MATERIALIZED (
      SELECT s.id, level, ref_id, sim, 1.0::DOUBLE - sim::DOUBLE / (x.n + y.n - sim) AS distance, sim >= level AS represented
      FROM (SELECT *, row_number() OVER (PARTITION BY id, level ORDER BY sim DESC, ref_id) AS r FROM shared) s
      JOIN sizes x ON x.id = s.id JOIN sizes y ON y.id = ref_id WHERE r = 1)"""

EVENTS = """feats AS MATERIALIZED (SELECT user_id AS genome, event_id AS fid, event_id % 2 AS strand,
      date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts))::BIGINT AS l, event_type,
      CASE WHEN value < 10 THEN NULL ELSE 'f' || floor(value / 20)::BIGINT END AS fam,
      CASE event_id % 3 WHEN 0 THEN ['s' || event_id % 5, 's9'] WHEN 1 THEN ['s' || event_id % 5] ELSE []::VARCHAR[] END AS subs FROM events),
    classes AS MATERIALIZED (SELECT genome, fid, event_type AS class FROM feats UNION SELECT genome, fid, fam FROM feats WHERE fam IS NOT NULL),
    counts AS (SELECT genome, class, count(*) AS n FROM classes GROUP BY ALL)"""
CLOSE = f"""near AS MATERIALIZED (SELECT genome, fid1, fid2 FROM (
      SELECT a.genome, a.fid AS fid1, b.fid AS fid2,
             max(greatest(b.l - (a.l + 60), a.l - (b.l + 60))) OVER (PARTITION BY a.genome, a.fid ORDER BY b.l, b.fid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS worst
      FROM feats a JOIN feats b ON a.genome = b.genome AND a.strand = b.strand AND (b.l > a.l OR (b.l = a.l AND b.fid > a.fid))) WHERE worst <= {REACH})"""
ADJACENT = f"""near AS MATERIALIZED (SELECT genome, fid1, fid2 FROM (
      SELECT genome, fid AS fid1, l, lead(fid) OVER w AS fid2, lead(l) OVER w AS l2 FROM feats WINDOW w AS (PARTITION BY genome, strand ORDER BY l, fid)) WHERE l2 - (l + 60) <= {REACH})"""


def events(finder: str, kept: str = "SELECT * FROM classes") -> str:
    return f"""{EVENTS}, {finder}, kept AS ({kept}),
    occ AS MATERIALIZED (
      SELECT least(x.class, y.class) AS class1, greatest(x.class, y.class) AS class2, near.genome, fid1, fid2
      FROM near JOIN kept x ON x.genome = near.genome AND x.fid = fid1 JOIN kept y ON y.genome = near.genome AND y.fid = fid2 WHERE x.class <> y.class),
    per AS (
      SELECT class1, class2, o.genome, min(1.0::DOUBLE / (c.n * d.n)) AS weight, count(*) FILTER (list_has_any(f.subs, g.subs)) AS sub_match,
             count(*) FILTER (NOT list_has_any(f.subs, g.subs) AND len(f.subs) + len(g.subs) > 0) AS sub_fail
      FROM occ o JOIN counts c ON c.genome = o.genome AND c.class = class1 JOIN counts d ON d.genome = o.genome AND d.class = class2
      JOIN feats f ON f.fid = fid1 JOIN feats g ON g.fid = fid2 GROUP BY ALL),
    totals AS MATERIALIZED (SELECT class1, class2, count(*) AS size, round(sum(weight), 6) AS weight, sum(sub_match)::BIGINT AS sub_match, sum(sub_fail)::BIGINT AS sub_fail FROM per GROUP BY ALL)"""


GOOD = """good AS MATERIALIZED (SELECT c_custkey AS id, c_custkey % 5 AS rep10, CASE WHEN c_custkey % 11 = 0 THEN c_custkey % 7 ELSE c_custkey % 25 END AS rep50, c_custkey % 100 AS rep100 FROM customer),
    sets AS (SELECT 10 AS level, id FROM good WHERE id < 5 UNION ALL SELECT 50, id FROM good WHERE id < 25 AND id <> 3 UNION ALL SELECT 100, id FROM good WHERE id < 100 AND id % 10 <> 7),
    edges AS MATERIALIZED (SELECT DISTINCT 50 AS level, rep50 AS id, rep10 AS parent FROM good UNION SELECT DISTINCT 100, rep100, rep50 FROM good)"""
CUSTOMERS = "cust AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def percentile(p: float) -> str:
    return f"""CASE WHEN {p} * (n + 1) < 1 THEN d[1] WHEN {p} * (n + 1) >= n THEN d[n]
      ELSE d[floor({p} * (n + 1))::BIGINT] + ({p} * (n + 1) - floor({p} * (n + 1))) * (d[floor({p} * (n + 1))::BIGINT + 1] - d[floor({p} * (n + 1))::BIGINT]) END"""


VERDICTS = f"""{SEQS}, {kmers()}, {sizes('kmers', 'sizes')},
    use AS (SELECT conv_id, id, seq FROM seqs WHERE length(seq) >= 400),
    near AS (
      SELECT p.conv_id, count(*) FILTER (1.0 - sim::DOUBLE / (x.n + y.n - sim) <= 0.5) AS close FROM (
        SELECT s.conv_id, a.id AS id1, b.id AS id2, count(*) AS sim FROM use s JOIN use t ON s.conv_id = t.conv_id AND s.id < t.id
        JOIN kmers a ON a.id = s.id JOIN kmers b ON b.id = t.id AND a.kmer = b.kmer GROUP BY ALL) p
      JOIN sizes x ON x.id = id1 JOIN sizes y ON y.id = id2 GROUP BY p.conv_id),
    sums AS (
      SELECT conv_id AS id, CASE WHEN conv_id % 4 = 0 THEN 'NCBI_REF' ELSE 'NORMAL' END AS rating, count(*) FILTER (length(seq) >= 400) AS useful,
             max(length(seq)) AS longest, arg_min(seq, (-length(seq), turn)) AS ssu FROM seqs GROUP BY conv_id),
    verdicts AS MATERIALIZED (
      SELECT s.id, CASE WHEN useful = 0 THEN 'BAD_SSU' WHEN useful = 1 AND rating = 'NORMAL' THEN 'SINGLE_SSU'
        WHEN useful > 1 AND coalesce(close, 0) < useful * (useful - 1) // 2 THEN 'BAD_SSU' WHEN longest < 800 THEN 'SHORT_SSU' ELSE rating END AS rating, ssu
      FROM sums s LEFT JOIN near ON near.conv_id = s.id)"""

COMPARED = f"""{SEQS}, {kmers(4, 'k4')}, {kmers(8, 'k8')}, {sizes('k4', 'n4')}, {sizes('k8', 'n8')}, {pairs('k4', 'p4', 'n4')}, {pairs('k8', 'p8', 'n8')},
    compared AS MATERIALIZED (
      SELECT a.id AS id1, b.id AS id2, coalesce(p8.distance, 1.0) AS seed_dist, coalesce(p4.distance, 1.0) AS rna_dist
      FROM seqs a JOIN seqs b ON a.id < b.id LEFT JOIN p8 ON p8.id1 = a.id AND p8.id2 = b.id LEFT JOIN p4 ON p4.id1 = a.id AND p4.id2 = b.id),
    each AS (SELECT id1 AS id, seed_dist, rna_dist FROM compared UNION ALL SELECT id2, seed_dist, rna_dist FROM compared)"""


def oracle_sql() -> dict[str, str]:
    from loom import listing_oracles, mechanism_oracles, report_oracles, stored_oracles

    parts = (report_oracles, stored_oracles, listing_oracles, mechanism_oracles)
    return {**_own(), **{name: sql for part in parts for name, sql in part.oracle_sql().items()}}


def _own() -> dict[str, str]:
    event_totals = "SELECT class1, class2, size, weight, sub_match, sub_fail FROM totals"
    best = "SELECT id, arg_min(ref_id, (-sim, ref_id)) AS ref_id, max(sim) AS sim, arg_min(distance, (-sim, ref_id)) AS distance FROM sims GROUP BY id"
    near_sql = f"WITH {USERS}, best AS ({best}), out AS (SELECT id, ref_id, coalesce(sim, 0) AS sim, coalesce(distance, 1.0) AS distance, coalesce(sim, 0) < 10 AS outlier FROM (SELECT DISTINCT id FROM u) LEFT JOIN best USING (id))"
    return {
        "kmer_profile": f"WITH {SEQS}, {kmers()}, {sizes('kmers', 'sizes')} SELECT id, coalesce(n, 0) AS kmers, (length(seq) - length(replace(seq, 'x', ''))) AS ambiguous, length(seq) AS letters FROM seqs LEFT JOIN sizes USING (id)",
        "pair_similarity": f"WITH {ALL} SELECT id1, id2, sim, distance FROM pairs",
        "distance_matrix": f"""WITH {ALL}, n AS (SELECT count(*) * (count(*) - 1) // 2 AS pairs FROM sizes),
            s AS (SELECT count(*) AS near, sum(sim)::DOUBLE AS s, sum(sim * sim)::DOUBLE AS ss, sum(1 - distance) AS d, sum((1 - distance) ** 2) AS dd FROM pairs)
            SELECT n.pairs, n.pairs - near AS zero_pairs, round(s / n.pairs, 6) AS mean_sim, round(sqrt(ss / n.pairs - (s / n.pairs) ** 2), 6) AS sd_sim,
                   round(1 - d / n.pairs, 6) AS mean_distance, round(sqrt(dd / n.pairs - (d / n.pairs) ** 2), 6) AS sd_distance FROM n, s""",
        "nearest_representative": f"{near_sql} SELECT * FROM out",
        "ssu_nearest": f"WITH {SEQS}, {kmers(12)}, {own('u', 'user')}, {own('a', 'assistant')}, {cross('u', 'a')} SELECT id, ref_id, sim, distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, ref_id) AS r FROM sims) WHERE r = 1",
        "representative_stats": f"{near_sql} SELECT ref_id AS rep_id, count(*) FILTER (NOT outlier) AS represented, count(*) FILTER (outlier) AS outliers FROM out WHERE ref_id IS NOT NULL GROUP BY ref_id",
        "neighbors_topn_ties": f"""WITH {USERS}, top AS (SELECT *, rank() OVER (PARTITION BY id ORDER BY sim DESC) AS r, row_number() OVER (PARTITION BY id ORDER BY sim DESC, ref_id) AS place FROM sims WHERE sim >= 2)
            SELECT z.id, z.size, place, ref_id, sim, distance, CASE WHEN place = 1 THEN 'Y' ELSE '' END AS closest, z.size * (1.0 - distance) AS signal
            FROM (SELECT id, count(*) AS size FROM u GROUP BY id) z LEFT JOIN (SELECT * FROM top WHERE r <= 3) t ON t.id = z.id""",
        "group_distance": f"""WITH {ALL}, near AS (SELECT id1 AS id, id2 AS other, distance FROM pairs UNION ALL SELECT id2, id1, distance FROM pairs)
            SELECT n.id, s.role AS grp, min(distance) AS distance FROM near n JOIN seqs s ON s.id = n.id JOIN seqs t ON t.id = other AND t.role = s.role GROUP BY ALL HAVING min(distance) <= 0.995""",
        "seq_test": f"""WITH {SEQS}, {kmers(8, 'k8')}, {kmers(12, 'k12')}, {own('u8', 'user', 'k8')}, {own('a8', 'assistant', 'k8')}, {own('u12', 'user', 'k12')}, {own('a12', 'assistant', 'k12')}, {cross('u8', 'a8', 's8')}, {cross('u12', 'a12', 's12')},
            b8 AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS rep, max(sim) AS sim FROM s8 GROUP BY id), b12 AS (SELECT id, arg_min(ref_id, (-sim, ref_id)) AS rep, max(sim) AS sim FROM s12 GROUP BY id)
            SELECT id, b8.rep AS seed_rep, coalesce(b8.sim, 0) AS seed_sim, b12.rep AS rna_rep, coalesce(b12.sim, 0) AS rna_sim, b8.rep IS NOT DISTINCT FROM b12.rep AS same
            FROM (SELECT DISTINCT id FROM u8) x JOIN (SELECT DISTINCT id FROM u12) y USING (id) LEFT JOIN b8 USING (id) LEFT JOIN b12 USING (id)""",
        "greedy_representatives": f"WITH RECURSIVE {ALL}, {walk('kept', 'id', near('sim >= 10'))} SELECT id FROM kept",
        "deferred_priority_build": f"WITH RECURSIVE {ALL}, {walk('kept', 'late, id', near('sim >= 10'), nodes=chr(10) + 'SELECT id, length(seq) - length(replace(seq, $$x$$, $$$$)) >= 4 AS late FROM seqs')} SELECT id FROM kept",
        "greedy_by_distance": f"""WITH RECURSIVE {ALL}, n AS (SELECT count(*) - 1 AS n FROM seqs),
            ends AS (SELECT id1 AS id, distance FROM pairs UNION ALL SELECT id2, distance FROM pairs),
            tot AS MATERIALIZED (
              SELECT id, round(n - sum(1 - distance), 9) AS total, round(sqrt(greatest((sum((1 - distance) ** 2) - sum(1 - distance) ** 2 / n) / (n - 1), 0)), 9) AS deviation
              FROM ends, n GROUP BY id, n HAVING min(distance) <= 0.995),
            {walk('kept', 'total, deviation, id', near('distance <= 0.995'), nodes='SELECT id, total, deviation FROM tot')} SELECT id FROM kept""",
        "updated_representatives": f"WITH RECURSIVE {ALL}, old AS (SELECT id FROM seqs WHERE role = 'system'), {walk('kept', 'id', near('sim >= 10'), 'old')} SELECT id FROM kept WHERE id NOT IN (SELECT id FROM old)",
        "nested_levels": f"WITH RECURSIVE {ALL}, {levels('id')} SELECT level, id FROM reps",
        "level_lists": f"WITH RECURSIVE {BUILD} SELECT id, domain, level, ref_id AS rep_id, sim AS score, distance FROM placed JOIN rated USING (id)",
        "rep_group_stats": f"WITH RECURSIVE {BUILD} SELECT level, ref_id AS rep_id, count(*) FILTER (represented) AS members, count(*) FILTER (NOT represented) AS outliers FROM placed GROUP BY ALL",
        "first_two_per_group": f"WITH RECURSIVE {BUILD} SELECT ref_id AS rep_id, place, id FROM (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY ord, score DESC, id) AS place FROM placed JOIN rated USING (id) WHERE level = {max(LEVELS)} AND represented) WHERE place <= 2",
        "good_table": f"WITH RECURSIVE {BUILD} SELECT r.id, domain, score, rating, " + ", ".join(f"max(ref_id) FILTER (level = {n} AND represented) AS rep{n}" for n in LEVELS) + " FROM rated r LEFT JOIN placed p ON p.id = r.id GROUP BY ALL",
        "finder_table": f"WITH RECURSIVE {BUILD}, fine AS (SELECT * FROM placed WHERE level = {max(LEVELS)}) SELECT CASE WHEN id = ref_id THEN 1 ELSE 2 END AS section, id, ref_id AS rep_id, coalesce(members, 0) AS members, represented FROM fine LEFT JOIN (SELECT ref_id, count(*) AS members FROM fine WHERE represented GROUP BY ref_id) USING (ref_id)",
        "rep_classify_levels": f"""WITH RECURSIVE {USERS}, {sizes('a', 'sizes')}, {pairs('a')}, {levels('id', nodes='SELECT DISTINCT id FROM a')},
            best AS (SELECT s.id, level, arg_min(ref_id, (-sim, ref_id)) AS ref_id, max(sim) AS sim FROM sims s JOIN reps r ON r.id = ref_id GROUP BY ALL)
            SELECT x.id, """ + ", ".join(f"max(ref_id) FILTER (level = {n} AND sim >= {n}) AS rep{n}" for n in LEVELS) + " FROM (SELECT DISTINCT id FROM u) x LEFT JOIN best USING (id) GROUP BY x.id",
        "coupling_close": f"WITH {events(CLOSE)} {event_totals}",
        "coupling_adjacent": f"WITH {events(ADJACENT)} {event_totals}",
        "coupling_limited": f"WITH {events(CLOSE, 'SELECT c.* FROM classes c JOIN counts n ON n.genome = c.genome AND n.class = c.class WHERE n <= 12')} {event_totals}".replace("WHERE n <= 12", "WHERE n.n <= 12"),
        "coupling_blacklist": f"WITH {events(CLOSE, 'SELECT * FROM classes WHERE class NOT IN ($$view$$, $$f1$$)')} {event_totals}",
        "coupling_pair_filters": f"""WITH {events(CLOSE)} SELECT class1, class2, 'SIZE' AS filter, size FROM totals WHERE size >= 140 UNION ALL SELECT class1, class2, 'WEIGHT', size FROM totals WHERE weight >= 1
            UNION ALL SELECT class1, class2, 'WHITELIST', size FROM totals WHERE class1 IN ('error', 'f0') OR class2 IN ('error', 'f0')""",
        "coupling_groups": f"WITH {events(ADJACENT)} SELECT class1, class2, string_agg(lpad(genome::VARCHAR, 6, '0'), ',' ORDER BY genome) AS genomes FROM per JOIN totals USING (class1, class2) WHERE size >= 20 GROUP BY ALL",
        "coupling_scores": f"""WITH {SEQS}, cls AS (SELECT conv_id AS genome, turn AS fid, role AS class FROM seqs UNION ALL SELECT conv_id, turn, 'len' || floor(length(seq) / 400)::BIGINT FROM seqs),
            cnt AS (SELECT genome, class, count(*) AS n FROM cls GROUP BY ALL),
            near AS (SELECT * FROM (SELECT conv_id AS genome, turn AS fid1, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS fid2 FROM seqs) WHERE fid2 - fid1 <= 1),
            occ AS (SELECT DISTINCT least(x.class, y.class) AS class1, greatest(x.class, y.class) AS class2, near.genome FROM near JOIN cls x ON x.genome = near.genome AND x.fid = fid1 JOIN cls y ON y.genome = near.genome AND y.fid = fid2 WHERE x.class <> y.class),
            per AS MATERIALIZED (SELECT o.*, 1.0::DOUBLE / (c.n * d.n) AS weight FROM occ o JOIN cnt c ON c.genome = o.genome AND c.class = class1 JOIN cnt d ON d.genome = o.genome AND d.class = class2),
            seeds AS (SELECT conv_id AS g, arg_min(id, (-length(seq), turn)) AS id FROM seqs GROUP BY conv_id), {kmers(8, 'every')},
            kmers AS MATERIALIZED (SELECT g AS id, kmer FROM seeds JOIN every USING (id)), {sizes('kmers', 'sizes')}, {pairs()},
            met AS (SELECT a.class1, a.class2, coalesce(1.0 / (sim + 1), 1.0) AS s, coalesce(distance, 1.0) AS d FROM per a JOIN per b ON a.class1 = b.class1 AND a.class2 = b.class2 AND a.genome < b.genome LEFT JOIN pairs ON id1 = a.genome AND id2 = b.genome),
            sums AS (SELECT class1, class2, sum(s) AS s, sum(d) AS d FROM met GROUP BY ALL),
            totals AS (SELECT class1, class2, count(*) AS size, sum(weight) AS weight FROM per GROUP BY ALL),
            has AS (SELECT class, count(DISTINCT genome) AS n FROM cls GROUP BY class)
            SELECT t.class1, t.class2, size, round(weight, 6) AS weight, round(coalesce(s, 0), 6) AS sim_distance, round(coalesce(d, 0), 6) AS real_distance, round(100.0 * size / x.n, 6)::DOUBLE AS percent1, round(100.0 * size / y.n, 6)::DOUBLE AS percent2
            FROM totals t LEFT JOIN sums USING (class1, class2) JOIN has x ON x.class = t.class1 JOIN has y ON y.class = t.class2""",
        "coupling_verify": f"""WITH {events(ADJACENT)}, known AS (SELECT * FROM (VALUES ('click', 'view'), ('error', 'f0'), ('nothing', 'view')) v(class1, class2)),
            occurs AS (SELECT class1, class2, count(DISTINCT x.genome) AS n FROM known JOIN classes x ON x.class = class1 JOIN classes y ON y.class = class2 AND y.genome = x.genome GROUP BY ALL)
            SELECT class1, class2, coalesce(size, 0) AS size, coalesce(n, 0) AS occurrences, CASE WHEN n > 0 THEN round(coalesce(size, 0) * 100.0::DOUBLE / n, 6) ELSE 0.0 END AS percent FROM known LEFT JOIN occurs USING (class1, class2) LEFT JOIN totals USING (class1, class2)""",
        "coupling_linkback": f"""WITH {events(ADJACENT)}, best AS (SELECT genome, fid1, fid2, max((size, weight)) AS c FROM occ JOIN totals USING (class1, class2) WHERE size >= 20 GROUP BY ALL)
            SELECT genome, fid1 AS fid, fid2 AS target, c[1] AS size, c[2] AS strength FROM best UNION ALL SELECT genome, fid2, fid1, c[1], c[2] FROM best""",
        "coupling_feature_lists": f"""WITH {events(ADJACENT)}, f AS (SELECT DISTINCT class1, class2, least(fid1::VARCHAR, fid2::VARCHAR) || ':' || greatest(fid1::VARCHAR, fid2::VARCHAR) AS f FROM occ JOIN totals USING (class1, class2) WHERE size >= 20)
            SELECT class1, class2, count(*) AS n, md5(string_agg(f, ',' ORDER BY f)) AS features_md5 FROM f GROUP BY ALL""",
        "universal_roles": """WITH f AS (SELECT l_orderkey AS genome, p_type AS role, l_quantity AS len, p_brand AS fam FROM lineitem JOIN part ON l_partkey = p_partkey),
            one AS (SELECT genome, role, min(len) AS len FROM f GROUP BY ALL HAVING count(*) = 1),
            s AS (SELECT role, count(*) AS count, avg(len) AS m, coalesce(stddev_samp(len), 0) AS sd FROM one GROUP BY role), n AS (SELECT count(DISTINCT genome) AS n FROM f)
            SELECT s.role, count, families, round(count * 100.0::DOUBLE / n, 6) AS percent, round(m, 6) AS mean_len, round(sd, 6) AS sdev_len
            FROM s, n JOIN (SELECT role AS r, string_agg(DISTINCT fam, ',' ORDER BY fam) AS families FROM f GROUP BY role) x ON true WHERE x.r = s.role AND count >= floor(floor(15.0 * n + 99) / 100)""",
        "missing_roles": """WITH f AS (SELECT o_custkey AS genome, o_orderpriority AS role, count(*) AS n FROM orders GROUP BY ALL), grid AS (SELECT c_custkey AS genome, role FROM customer, (SELECT DISTINCT o_orderpriority AS role FROM orders))
            SELECT role, genome, coalesce(n, 0) AS count, CASE WHEN n IS NULL THEN 'MISSING' ELSE 'OVER_PRESENT' END AS type FROM grid LEFT JOIN f USING (genome, role) WHERE n IS NULL OR n > 1""",
        "role_summary": """WITH n AS (SELECT c_custkey, count(DISTINCT o_orderpriority) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) SELECT min(n) AS min, max(n) AS max, round(avg(n), 6) AS mean, median(n)::DOUBLE AS median FROM n""",
        "longest_per_group": f"WITH {SEQS} SELECT conv_id, arg_min(turn, (-length(seq), turn)) AS turn, max(length(seq)) AS letters, md5(arg_min(seq, (-length(seq), turn))) AS md5 FROM seqs GROUP BY conv_id",
        "tax_report": f"""WITH {CUSTOMERS}, t AS (SELECT n_regionkey AS repgen_id, 'genus' AS rank, c_nationkey::VARCHAR AS tax_id FROM cust UNION ALL SELECT n_regionkey, 'species', c_mktsegment FROM cust),
            c AS (SELECT tax_id, rank, repgen_id, count(*) AS count FROM t WHERE tax_id NOT IN ('', '0') GROUP BY ALL) SELECT *, count::DOUBLE / sum(count) OVER (PARTITION BY tax_id, rank) AS weight FROM c""",
        "lineage_string": f"""WITH {CUSTOMERS} SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN c_name || ', ' || n_name || ', ' || r_name WHEN c_custkey % 2 = 0 THEN n_name || ', ' || r_name ELSE 'Bacteria' END AS taxonomy FROM cust""",
        "lineage_parse": f"""WITH {CUSTOMERS} SELECT c_custkey AS id, 'n' || c_nationkey AS genus, lower(c_mktsegment) AS species, CASE WHEN n_regionkey = 2 THEN 'Archaea' ELSE 'Bacteria' END AS domain,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 4 ELSE 11 END AS genetic_code FROM cust WHERE c_custkey % 4 > 0""",
        "hierarchy_errors": f"""WITH {GOOD} SELECT g.id, CASE WHEN r.id IS NULL OR r.rep100 <> g.rep100 THEN 100 WHEN r.rep50 <> g.rep50 THEN 50 ELSE 10 END AS level,
            CASE WHEN r.id IS NULL OR r.rep100 <> g.rep100 THEN r.rep100 WHEN r.rep50 <> g.rep50 THEN r.rep50 ELSE r.rep10 END AS expected,
            CASE WHEN r.id IS NULL OR r.rep100 <> g.rep100 THEN g.rep100 WHEN r.rep50 <> g.rep50 THEN g.rep50 ELSE g.rep10 END AS actual
            FROM good g LEFT JOIN good r ON r.id = g.rep100 WHERE r.id IS NULL OR r.rep100 <> g.rep100 OR r.rep50 <> g.rep50 OR r.rep10 <> g.rep10""",
        "multi_parent": f"WITH {GOOD} SELECT level, id, parent FROM (SELECT *, count(*) OVER (PARTITION BY level, id) AS n FROM edges) WHERE n > 1",
        "hierarchy_tree": f"""WITH {GOOD}, l0 AS (SELECT DISTINCT parent AS id, parent::VARCHAR AS path FROM edges WHERE level = 50), l1 AS (SELECT e.id, path || '>' || e.id AS path FROM l0 JOIN edges e ON e.parent = l0.id AND level = 50),
            l2 AS (SELECT e.id, path || '>' || e.id AS path FROM l1 JOIN edges e ON e.parent = l1.id AND level = 100)
            SELECT path, id::VARCHAR AS line FROM l0 UNION ALL SELECT path, '    ' || id FROM l1 UNION ALL SELECT path, '        ' || id FROM l2""",
        "subset_errors": f"WITH {GOOD} SELECT s.level, s.id, CASE s.level WHEN 10 THEN 50 ELSE 100 END AS missing_in FROM sets s WHERE level < 100 AND NOT EXISTS (SELECT 1 FROM sets t WHERE t.id = s.id AND t.level = CASE s.level WHEN 10 THEN 50 ELSE 100 END)",
        "representation_errors": f"""WITH {GOOD}, long AS (SELECT id, 10 AS level, rep10 AS rep FROM good UNION ALL SELECT id, 50, rep50 FROM good UNION ALL SELECT id, 100, rep100 FROM good)
            SELECT id, level, rep AS bad_rep, 'Not a Representative' AS error FROM long l WHERE NOT EXISTS (SELECT 1 FROM sets s WHERE s.level = l.level AND s.id = l.rep)
            UNION ALL SELECT id, level, rep, 'Not Self-Representing' FROM long l WHERE rep <> id AND EXISTS (SELECT 1 FROM sets s WHERE s.level = l.level AND s.id = l.id)""",
        "rating_default": "SELECT rating, count(*) AS count FROM (SELECT d.doc_id, CASE WHEN quality IS NULL AND l.doc_id IS NULL THEN 'NORMAL' WHEN quality = 1 THEN 'NCBI_REP' ELSE 'BAD_SSU' END AS rating FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE rating <> 'BAD_SSU' GROUP BY rating",
        "ssu_verdict": f"WITH {VERDICTS} SELECT id, rating, md5(ssu) AS ssu_md5 FROM verdicts",
        "genus_retry": f"""WITH {VERDICTS}, v AS MATERIALIZED (SELECT id, rating, ssu, CASE WHEN id % 7 > 0 THEN id % 7 END AS genus FROM verdicts),
            refs AS (SELECT genus, arg_min(ssu, id) AS ref_ssu FROM v WHERE rating IN ('NCBI_REF', 'NCBI_REP', 'NORMAL') AND genus IS NOT NULL GROUP BY genus),
            single AS (SELECT v.id, v.genus, ref_ssu, list_distinct(list_transform(range(1, length(ssu) - 2), lambda i: substring(ssu, i::INT, 4))) AS x,
                       list_distinct(list_transform(range(1, length(ref_ssu) - 2), lambda i: substring(ref_ssu, i::INT, 4))) AS y FROM v LEFT JOIN refs USING (genus) WHERE rating = 'SINGLE_SSU' AND v.genus IS NOT NULL),
            d AS (SELECT *, len(list_intersect(x, y)) AS sim FROM single)
            SELECT id, genus, rating FROM v WHERE rating <> 'SINGLE_SSU' UNION ALL
            SELECT id, genus, CASE WHEN ref_ssu IS NULL THEN 'SINGLE_SSU' WHEN 1.0 - sim::DOUBLE / (len(x) + len(y) - sim) >= 0.75 THEN 'BAD_SSU' WHEN length(ref_ssu) < 800 THEN 'SHORT_SSU' ELSE 'NORMAL' END FROM d""",
        "max_pair_distance": f"""WITH {SEQS}, {kmers(4)}, {sizes('kmers', 'sizes')}, inner_pairs AS (
              SELECT s.conv_id, s.id AS id1, t.id AS id2, count(b.kmer) AS sim FROM seqs s JOIN seqs t ON s.conv_id = t.conv_id AND s.id < t.id JOIN kmers a ON a.id = s.id LEFT JOIN kmers b ON b.id = t.id AND a.kmer = b.kmer GROUP BY ALL),
            d AS (SELECT p.conv_id, max(CASE WHEN sim = 0 THEN 1.0 ELSE 1.0 - sim::DOUBLE / (x.n + y.n - sim) END) AS far FROM inner_pairs p JOIN sizes x ON x.id = id1 JOIN sizes y ON y.id = id2 GROUP BY p.conv_id)
            SELECT conv_id, count(*) AS count, max(far) AS max_dist FROM seqs JOIN d USING (conv_id) GROUP BY conv_id HAVING count(*) > 1""",
        "seq_compare": f"WITH {COMPARED} SELECT * FROM compared WHERE rna_dist < 1",
        "seq_correlation": f"WITH {COMPARED} SELECT count(*) AS pairs, round(corr(seed_dist, rna_dist), 6) AS pearson FROM compared",
        "error_summary": f"WITH {COMPARED} SELECT id, round(avg(abs(seed_dist - rna_dist)), 6) AS mean_error, round(coalesce(stddev_samp(abs(seed_dist - rna_dist)), 0), 6) AS sd_error FROM each GROUP BY id",
        "kendall_summary": f"""WITH {COMPARED}, p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seed_dist, rna_dist) AS i FROM each WHERE rna_dist < 1),
            far AS (SELECT id, count(*) AS far FROM each WHERE rna_dist >= 1 GROUP BY id),
            s AS (SELECT a.id, sum(sign(a.seed_dist - b.seed_dist) * sign(a.rna_dist - b.rna_dist)) AS s, sum(abs(sign(a.seed_dist - b.seed_dist))) AS nx, sum(abs(sign(a.rna_dist - b.rna_dist))) AS ny FROM p a JOIN p b ON a.id = b.id AND a.i < b.i GROUP BY a.id),
            t AS (SELECT id, count(*) FILTER (seed_dist < 1) AS below_x, count(*) AS below_y FROM p GROUP BY id),
            k AS (SELECT t.id, coalesce(s, 0) + coalesce(far, 0) * below_x AS s, coalesce(nx, 0) + coalesce(far, 0) * below_x AS nx, coalesce(ny, 0) + coalesce(far, 0) * below_y AS ny FROM t LEFT JOIN s USING (id) LEFT JOIN far USING (id))
            SELECT e.id, count(*) AS n, CASE WHEN any_value(nx * ny) > 0 THEN round(any_value(s / sqrt((nx * ny)::DOUBLE)), 6) END AS tau, CASE WHEN stddev_pop(seed_dist) * stddev_pop(rna_dist) > 1e-12 THEN round(corr(seed_dist, rna_dist), 6) END AS pearson FROM each e LEFT JOIN k ON k.id = e.id GROUP BY e.id""",
        "neighbor_stats": f"""WITH {SEQS}, {kmers(4, 'k4')}, {kmers(8, 'k8')}, q8 AS (SELECT k.* FROM k8 k JOIN seqs USING (id) WHERE role <> 'assistant'), q4 AS (SELECT k.* FROM k4 k JOIN seqs USING (id) WHERE role <> 'assistant'),
            {own('r8', 'assistant', 'k8')}, {own('r4', 'assistant', 'k4')}, {cross('q8', 'r8', 's8')}, {cross('q4', 'r4', 's4')},
            every AS (SELECT s.id, r.id AS ref_id, m.measure FROM seqs s, seqs r, (VALUES ('seed'), ('rna')) m(measure) WHERE s.role <> 'assistant' AND r.role = 'assistant'),
            x AS (SELECT e.*, coalesce(CASE measure WHEN 'seed' THEN s8.distance ELSE s4.distance END, 1.0) AS distance FROM every e LEFT JOIN s8 USING (id, ref_id) LEFT JOIN s4 USING (id, ref_id)),
            g AS (SELECT id, measure, list_sort(list(distance)) AS d, count(*) AS n, avg(distance) AS m, coalesce(stddev_samp(distance), 0) AS sd FROM x GROUP BY id, measure)
            SELECT id, measure, round(d[1], 6) AS min, round(d[least(101, n)], 6) AS v100, round({percentile(0.25)}, 6) AS q1, round({percentile(0.5)}, 6) AS q2, round({percentile(0.75)}, 6) AS q3, round(d[n], 6) AS max, round(m, 6) AS mean, round(sd, 6) AS sdev FROM g""",
        "discriminating_kmers": """WITH t AS (SELECT DISTINCT c_custkey AS id, substring(c_name, i::INT, 4) AS kmer FROM (SELECT *, unnest(range(1, length(c_name) - 2)) AS i FROM customer)),
            o AS (SELECT DISTINCT substring(s_name, i::INT, 4) AS kmer FROM (SELECT *, unnest(range(1, length(s_name) - 2)) AS i FROM supplier))
            SELECT kmer FROM t GROUP BY kmer HAVING count(*) = (SELECT count(DISTINCT id) FROM t) EXCEPT SELECT kmer FROM o""",
        "prioritize": "SELECT o_orderkey, o_custkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS urgent FROM orders",
        "top_groups": "SELECT o_custkey, o_orderkey, o_totalprice, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n >= 12 AND place <= 5",
        "distance_buckets": f"""WITH {SEQS}, {kmers(4)}, {sizes('kmers', 'sizes')}, s AS (SELECT b.id, count(*) AS sim FROM kmers a JOIN kmers b USING (kmer) WHERE a.id = 0 GROUP BY b.id),
            d AS (SELECT s.id, 1.0::DOUBLE - sim::DOUBLE / (n + (SELECT n FROM sizes WHERE id = 0) - sim) AS distance FROM s JOIN sizes z ON z.id = s.id),
            b AS (SELECT *, list_min(list_filter(range(50), lambda i: (i + 1)::DOUBLE / 50 > distance))::INT AS bucket FROM d),
            p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY id <> 0, id) AS place FROM b WHERE bucket IS NOT NULL) SELECT id, bucket, place, distance FROM p WHERE place <= 4""",
        "catalog_sync": "SELECT item_id AS doc_id, 'delete' AS action FROM (SELECT item_id FROM benchmark EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'add' FROM (SELECT doc_id FROM labels EXCEPT SELECT item_id FROM benchmark)",
        "incremental_table": "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "md5_checksum": "SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS site, count(*) AS pages, md5(string_agg(md5(html), ',' ORDER BY md5(html))) AS checksum FROM pages GROUP BY site",
    }
