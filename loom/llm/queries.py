"""The training-data queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loom.llm import (
    conversation_repair, decontaminate, exact_dedup, filter_audit, language_id, line_dedup, mixing, packing, quality, sharding, simhash, substring_dedup,
    toxicity,
)
from loom.llm.repair_oracle import REPAIR_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    out = toxicity.score(docs.select("doc_id", "text"), index)
    held_out = F.coalesce(~toxicity.training_row(), F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, F.col("toxicity").alias("score"), (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "evidence")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(~language_id.training_row(), F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = quality.score(docs.select("doc_id", "text"), quality.train(docs))
    return out.select("doc_id", F.col("quality").alias("score"), (F.col("quality") >= 0.5).alias("kept"), "weak_posterior", "votes")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    shards = F.array_join(F.array_sort(F.array_distinct(F.transform("pieces", lambda p: p["shard"]))).cast("array<string>"), ",")
    return out.select("doc_id", "size", "source_size", "target", "taken", shards.alias("shards"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents")).select("doc_id", "slot", "shard")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.boilerplate_free(_table(spark, sf_dir, "pages")).select("page_id", "host", "n_lines", "n_dropped",
        F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.mark(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", "item_id", "equal_tokens", "span_tokens", "doc_from", "item_from")


def repaired(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each conversation of conversations: what repairing turns, its counted rows, found and did."""
    done = conversation_repair.repair_counted(turns)
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    report = done.report.join(conversation_repair.digests(done.turns).withColumnRenamed("conv", "same"), F.col("conv").eqNullSafe(F.col("same")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(report, F.col("id").eqNullSafe(F.col("conv")), "left").select(F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repaired(conversations, conversation_repair.damaged(conversations))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_audit.replay(filter_audit.labelled(filter_audit.failures(docs), labels))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_toxicity, op2_exact_dedup, op3_language_id, op4_simhash_dedup, op5_quality, op6_mixing, op7_sharding, op8_substring_dedup,
        op9_line_dedup, op10_decontaminate, op11_conversation_repair, op12_best_fit_packing, op13_filter_audit, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": r"""
            WITH hashed AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
            FROM hashed WINDOW w AS (PARTITION BY text_sha256)""",
        "op6_mixing": r"""
            WITH RECURSIVE docs AS (
              SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                     md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
            sums AS (SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM docs GROUP BY source),
            weighed AS (SELECT *, [5, 2, 1][(number - 1) % 3 + 1] AS weight FROM sums),
            total AS (SELECT sum(words)::BIGINT AS words FROM weighed),
            levels AS (
              SELECT w.*, (1.5 * t.words - coalesce(sum(2 * w.words) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                          / sum(weight) OVER (b ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level,
                     row_number() OVER b AS place
              FROM weighed w, total t WINDOW b AS (ORDER BY 2.0 * w.words / weight, source)),
            level AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= 2 * words),
            targets AS (
              SELECT source, words, number, CASE WHEN level.level * weight > 2 * words THEN (2 * words)::DOUBLE ELSE level.level * weight END AS target,
                     greatest(1024, ceil(2 * (SELECT words FROM total) / 5e8))::BIGINT AS most
              FROM weighed, level),
            blocks AS (SELECT *, CASE WHEN words <= most * 1000 THEN greatest(1, least(most, words // 1000)) ELSE most END AS block FROM targets),
            counts AS (SELECT *, (words + block - 1) // block AS n FROM blocks),
            plan AS (
              SELECT *, least(2 * n, floor(target / block + 0.5)::BIGINT) AS quota, greatest(1, floor(sqrt(n))::BIGINT) AS wide,
                     list_min(list_filter(range(greatest(1, n) * 5 // 8 + 1, 2 * greatest(1, n) + 2), lambda x: gcd(x, greatest(1, n)) = 1)) AS step
              FROM counts),
            tree(lo, shards, i, rest, need, q, d) AS (
              SELECT 0::BIGINT, 64::BIGINT, 1::BIGINT, sum(quota)::BIGINT, (sum(quota) * 32 // 64)::BIGINT, list(quota ORDER BY number), []::BIGINT[] FROM plan
              UNION ALL
              SELECT CASE WHEN more OR child = 0 THEN lo ELSE lo + shards // 2 END,
                     CASE WHEN more THEN shards WHEN child = 0 THEN shards // 2 ELSE shards - shards // 2 END,
                     CASE WHEN more THEN i + 1 ELSE 1 END,
                     CASE WHEN more THEN rest - q[i] ELSE list_sum(part)::BIGINT END,
                     CASE WHEN more THEN need - x WHEN child = 0 THEN (list_sum(part) * (shards // 4) // greatest(1, shards // 2))::BIGINT
                          ELSE (list_sum(part) * ((shards - shards // 2) // 2) // (shards - shards // 2))::BIGINT END,
                     CASE WHEN more THEN q ELSE part END,
                     CASE WHEN more THEN list_append(d, x) ELSE []::BIGINT[] END
              FROM (
                SELECT *, CASE WHEN more THEN least(high, low + len(list_filter(range(1, len(chance) + 1), lambda j: list_sum(chance[1:j]) < u)))::BIGINT END AS x,
                       CASE WHEN more THEN NULL WHEN child = 0 THEN d ELSE list_transform(range(1, len(q) + 1), lambda j: q[j] - d[j]) END AS part
                FROM (
                  SELECT *, (('0x' || substr(md5('mix-1:' || lo || ':' || shards || ':' || (i - 1)), 1, 8))::BIGINT + 0.5) / 4294967296 AS u,
                         CASE WHEN more THEN list_transform(range(low, high + 1), lambda k: exp(lgamma(q[i] + 1) - lgamma(k + 1) - lgamma(q[i] - k + 1)
                           + lgamma(bad + 1) - lgamma(need - k + 1) - lgamma(bad - need + k + 1) - lgamma(rest + 1) + lgamma(need + 1) + lgamma(rest - need + 1))) END AS chance
                  FROM (
                    SELECT *, CASE WHEN more THEN greatest(0, need - bad) ELSE 0 END AS low, CASE WHEN more THEN least(q[i], need) ELSE 0 END AS high
                    FROM (SELECT *, i <= len(q) AS more, rest - coalesce(q[i], 0) AS bad FROM tree WHERE shards > 1)),
                  (SELECT unnest([0, 1]) AS child)
                  WHERE child = 0 OR NOT more))),
            leaves AS (SELECT lo AS shard, unnest(q) AS blocks, unnest(range(1, len(q) + 1)) AS number FROM tree WHERE shards = 1),
            bounds AS (SELECT shard, number, sum(blocks) OVER (PARTITION BY number ORDER BY shard) AS upto, upto - blocks AS after FROM leaves),
            placed AS (
              SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM docs d),
            cut AS (
              SELECT p.doc_id, p.k, p.start, p.size, s.*, unnest(range(p.start // s.block, (p.start + p.size - 1) // s.block + 1)) AS b
              FROM placed p JOIN plan s ON p.source IS NOT DISTINCT FROM s.source WHERE p.size > 0),
            one AS (SELECT *, n // wide AS high, (b * step + e) % n AS x1 FROM cut, (VALUES (0), (1)) e(e)),
            two AS (SELECT *, CASE WHEN x1 < high * wide THEN ((x1 // wide + ('0x' || substr(md5('mix-1:column:' || e || ':' || (x1 % wide)), 1, 8))::BIGINT) % high) * wide + x1 % wide ELSE x1 END AS x2 FROM one),
            three AS (SELECT *, CASE WHEN x2 < high * wide THEN x2 // wide * wide + (x2 % wide + ('0x' || substr(md5('mix-1:row:' || e || ':' || (x2 // wide)), 1, 8))::BIGINT) % wide ELSE x2 END AS x3 FROM two),
            slots AS (SELECT *, e * n + (x3 * step + 1) % n AS slot FROM three),
            taken AS (
              SELECT s.doc_id, s.start, sum(least((b + 1) * block, start + size) - greatest(b * block, start))::BIGINT AS taken, array_to_string(list_sort(list_distinct(list(shard))), ',') AS shards
              FROM slots s JOIN bounds o ON o.number = s.number AND slot >= o.after AND slot < o.upto WHERE slot < quota GROUP BY s.doc_id, s.start)
            SELECT p.doc_id, p.size, s.words AS source_size, s.target, coalesce(t.taken, 0) AS taken, coalesce(t.shards, '') AS shards
            FROM placed p JOIN plan s ON p.source IS NOT DISTINCT FROM s.source
            LEFT JOIN taken t ON t.doc_id IS NOT DISTINCT FROM p.doc_id AND t.start = p.start AND p.size > 0""",
        "op8_substring_dedup": r"""
            WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
            flat AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM words),
            starts AS (
              SELECT doc_id, word, pos, CASE WHEN pos + 35 <= n THEN md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS h
              FROM flat),
            counted AS (SELECT doc_id, word, pos, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS twice FROM starts),
            covered AS (SELECT doc_id, word, pos, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
            kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM covered GROUP BY doc_id)
            SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
            FROM words LEFT JOIN kept USING (doc_id)""",
        "op9_line_dedup": rf"""
            WITH parts AS (
              SELECT page_id, lower(nullif(regexp_extract(url, '{line_dedup.HOST}', 1), '')) AS host,
                     list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
                       '{line_dedup.HIDDEN}', chr(10), 'g'), '{line_dedup.BREAKS}', chr(10), 'g'), '{line_dedup.TAG}', '', 'g'), chr(10)),
                       lambda x: trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS lines
              FROM pages),
            hosts AS (SELECT host, count(*) AS pages FROM parts WHERE host IS NOT NULL GROUP BY host),
            counted AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM parts WHERE host IS NOT NULL) GROUP BY ALL),
            frequent AS (
              SELECT host, list(line) AS drop_lines FROM counted JOIN hosts USING (host)
              WHERE pages >= {line_dedup.MIN_PAGES} AND n > pages * {line_dedup.RATIO} GROUP BY host),
            kept AS (
              SELECT page_id, host, lines, CASE WHEN drop_lines IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(drop_lines, x)) END AS kept
              FROM parts LEFT JOIN frequent USING (host))
            SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped, sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM kept""",
        "op11_conversation_repair": REPAIR_SQL,
        "op13_filter_audit": r"""
            WITH read AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
            split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM read),
            marks AS (SELECT doc_id, quality = 1 AS good, toxic = 1 AS toxic FROM labels),
            labelled AS (SELECT doc_id, coalesce(bool_or(good), false) AS good, coalesce(bool_or(toxic), false) AS toxic FROM marks GROUP BY doc_id),
            flags AS (
              SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
                      'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
                      'E': coalesce(least < doc_id, false)} AS f
              FROM split LEFT JOIN labelled USING (doc_id)),
            failed AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END) AS fails FROM flags),
            letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
            orders AS (
              SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
            replayed AS (
              SELECT part, good, toxic, fails, filter_order, list_min(list_transform(fails, lambda x: instr(filter_order, x))) AS first, unnest(range(1, 6)) AS step FROM failed, orders),
            sums AS (
              SELECT part, filter_order, step::INTEGER AS step, count(*) FILTER (first IS NULL OR first > step) AS kept, count(*) FILTER (first = step) AS removed,
                     count(*) FILTER (first < step AND list_contains(fails, filter_order[step])) AS redundant,
                     count(*) FILTER (fails = [filter_order[step]]) AS unique_fails, count(*) FILTER (first = step AND good) AS good_lost,
                     count(*) FILTER (first = step AND toxic) AS toxic_lost
              FROM replayed GROUP BY ALL)
            SELECT *, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley FROM sums""",
    }
