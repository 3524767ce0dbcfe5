"""Mixing sources to target weights: a splitting tree deals exact block quotas to shards, which draw permuted blocks.

DataFrame functions only; the driver handles at most COLUMNS sources, executors run no Python.
"""

from __future__ import annotations

import json
from hashlib import md5
from math import exp, lgamma

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loom.llm.common import WORD, fresh, materialize

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, "mix-1"
BLOCK_WORDS, SHARDS = 1024, 64
#: Sources with a column of their own in the tree, those of the largest quotas; all others share one more column.
COLUMNS = 255
#: Rows whose sizes one window sums up, about.
GROUP_ROWS = 5_000


def uniform(seed: str, *names: object) -> float:
    """A number between 0 and 1 from an MD5, the same in every run."""
    return (int(md5(":".join(map(str, (seed, *names))).encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def hypergeometric(good: int, bad: int, draws: int, u: float) -> int:
    """How many of the draws from good and bad blocks are good ones: the least k whose distribution function reaches u."""
    least, most, total = max(0, draws - bad), min(good, draws), good + bad
    if least == most:
        return least
    mode = min(most, max(least, (draws + 1) * (good + 1) // (total + 2)))
    wide = 50 + int(12 * (draws * (good / total) * (bad / total)) ** 0.5)
    low, high = max(least, mode - wide), min(most, mode + wide)
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    start = exp(choose(good, low) + choose(bad, draws - low) - choose(total, draws)) if low == least else None
    k = np.arange(low, high, dtype=float)
    step = (good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1))
    if start is None or start < 1e-250:  # from the mode outwards
        at = mode - low
        peak = exp(choose(good, mode) + choose(bad, draws - mode) - choose(total, draws))
        chance = peak * np.concatenate((np.cumprod(1 / step[:at][::-1])[::-1], [1.0], np.cumprod(step[at:])))
    else:
        chance = start * np.concatenate(([1.0], np.cumprod(step)))
    return min(high, low + int(np.searchsorted(np.cumsum(chance), u)))


def split_quotas(quotas: list[int], shards: int, seed: str = SEED, first: int = 0) -> list[list[int]]:
    """Blocks of each source (column) for each shard (row): every tree node halves its shards and gives the left half a
    multivariate hypergeometric draw of its blocks, source by source, so the sums are exact and shards are sized alike."""
    if shards == 1:
        return [quotas]
    left, rest = shards // 2, sum(quotas)
    need, draw = rest * left // shards, []
    for i, q in enumerate(quotas):
        rest -= q
        draw.append(hypergeometric(q, rest, need, uniform(seed, first, shards, i)))
        need -= draw[-1]
    return split_quotas(draw, left, seed, first) + split_quotas([q - d for q, d in zip(quotas, draw, strict=True)], shards - left, seed, first + left)


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from the driver, as one literal."""
    names = [c.split()[0] for c in schema.split(", ")]
    found = F.from_json(F.lit(json.dumps([dict(zip(names, r, strict=True)) for r in rows])), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")
    return spark.range(1).select(F.inline(found))


def water_level(totals: DataFrame, words: int, share: float, cap: int) -> float:
    """The words that a weight of 1 gets of share * words when none of totals (size, weight) gets above cap times its size.

    What a full source can't hold raises the level of the others, which may fill more; each round is one small aggregation.
    """
    level, filled = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > cap * F.col("size")
        held, n, weight = totals.agg(F.sum(F.when(full, cap * F.col("size"))), F.sum(full.cast("long")), F.sum(F.when(~full, F.col("weight")))).first()
        if n == filled or not weight:
            return level
        level, filled = (share * words - (held or 0)) / weight, n


def permuted(numbers: Column, n: Column, step: Column, e: int, seed: str = SEED) -> Column:
    """Each number below n of the array as another one: a permutation of its own for each pass e.

    Numbers stand in a grid about as wide as high; a step without a factor in common with n spreads them, every column and
    then every row of the grid is turned by a hash of its own, and the step spreads them again.
    """
    wide = F.greatest(F.lit(1), F.floor(F.sqrt(n.cast("double")))).cast("long")
    high = F.floor(n / wide).cast("long")
    turn = lambda kind, x: F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit(kind), F.lit(e), x.cast("string"))), 1, 8), 16,
        10).cast("long")
    row, column = lambda x: F.floor(x / wide).cast("long"), lambda x: F.pmod(x, wide)
    x = F.transform(numbers, lambda b: F.pmod(b * step + F.lit(e), n))
    x = F.transform(x, lambda b: F.when(b < high * wide, F.pmod(row(b) + turn("column", column(b)), high) * wide + column(b)).otherwise(b))
    x = F.transform(x, lambda b: F.when(b < high * wide, row(b) * wide + F.pmod(column(b) + turn("row", row(b)), wide)).otherwise(b))
    return F.transform(x, lambda b: F.pmod(b * step + F.lit(1), n))


def coprime_step(n: Column) -> Column:
    """The first number from n * 5 // 8 + 1 on that has no factor in common with n: found among the next 64, else 1.

    Euclid's algorithm in a fold: 64 steps end it for any two longs that fit.
    """
    gcd = lambda a: F.aggregate(F.sequence(F.lit(1), F.lit(90)), F.struct(a.cast("long").alias("a"), n.alias("b")), lambda s,
        _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.pmod(s["a"], F.when(s["b"] == 0, F.lit(1)).otherwise(s["b"])).alias("b"))),
        lambda s: s["a"])
    start = F.floor(n * 5 / 8).cast("long") + 1
    return F.coalesce(F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: start + k), lambda x: gcd(x) == 1), 1),
        F.lit(1)).cast("long")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def order_key(identifier: Column, spread: Column, seed: str = SEED) -> Column:
    """Documents of a source stand in the order of this MD5; a null id counts as the text 'null'."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(identifier.cast("string"), F.lit("null")), spread))


def plan_sources(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP,
        shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The plan of each source and, for each column of the tree, the slots before which each shard ends.

    totals: (source, size, rows). Sources by code point, null last, take the weights in turn; their number has no bound, as
    they are numbered and summed within ranges. Plan: source, size, rows, target, block (words of a block), blocks (of one
    pass), quota (blocks to take in up to cap passes), step, column, offset (of its slots within the column). The shared column's slots are permuted once more.
    A source of size 0 has quota 0; an empty table gives an empty plan.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    sorted_rows = materialize(totals.repartitionByRange(*by_name).sortWithinPartitions(*by_name).withColumn("at", F.monotonically_increasing_id()))
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))

    def before(rows: DataFrame, amount: Column, name: str) -> DataFrame:
        """rows with the sum of amount over all rows before: sums of the ranges, then a window within a range."""
        sums = {r.part: r.n for r in rows.groupBy(part.alias("part")).agg(F.sum(amount).alias("n")).collect()}  # one row a range
        base = np.cumsum([0] + [sums[p] for p in sorted(sums)]).tolist()
        starts = _table(rows.sparkSession, list(zip(sorted(sums), base[:-1], strict=True)), "range long, start long")
        own = F.coalesce(F.sum(amount).over(Window.partitionBy(part).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return rows.withColumn(name, own).join(F.broadcast(starts), part == F.col("range")).withColumn(name,
            F.col(name) + F.col("start")).drop("range", "start")

    turns = F.array(*[F.lit(w) for w in weights])
    numbered = before(sorted_rows, F.lit(1).cast("long"), "number").withColumn("weight",
        F.element_at(turns, (F.pmod("number", F.lit(len(weights))) + 1).cast("int")))
    numbered = materialize(numbered)
    words = numbered.agg(F.sum("size")).first()[0] or 0
    fair = F.lit(water_level(numbered, words, share, cap)) * F.col("weight")
    most = max(BLOCK_WORDS, -(-cap * words // 500_000_000))
    plan = numbered.withColumn("target", F.when(fair > cap * F.col("size"), (cap * F.col("size")).cast("double")).otherwise(fair))
    plan = plan.withColumn("block", F.when(F.col("size") <= most * 1000,
        F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("size") / 1000)))).otherwise(most).cast("long"))
    plan = plan.withColumn("blocks", F.ceil(F.col("size") / F.col("block")).cast("long"))
    plan = plan.withColumn("quota", F.least(cap * F.col("blocks"), F.floor(F.col("target") / F.col("block") + 0.5).cast("long"))).withColumn("step",
        coprime_step(F.greatest(F.lit(1).cast("long"), F.col("blocks"))))
    plan = materialize(plan)
    own = [(r.number, r.quota) for r in plan.orderBy(F.desc("quota"), "number").limit(COLUMNS).collect()]
    own = sorted(own)
    columns = _table(plan.sparkSession, [(n, k) for k, (n, _) in enumerate(own)], "number long, column int")
    plan = plan.join(F.broadcast(columns), "number", "left").withColumn("column", F.coalesce("column", F.lit(len(own))))
    pooled = F.when(F.col("column") == len(own), F.col("quota")).otherwise(0).cast("long")
    plan = before(plan, pooled, "offset").withColumn("offset", F.when(F.col("column") == len(own), F.col("offset")).otherwise(0))
    pool = plan.agg(F.sum(pooled)).first()[0] or 0
    quotas = [q for _, q in own] + ([pool] if pool else [])
    ends = np.cumsum(np.array(split_quotas(quotas, shards)).reshape(shards, len(quotas)), axis=0).T.tolist()
    bounds = _table(plan.sparkSession, [(k, x, pool if k == len(own) else None) for k, x in enumerate(ends)], "column int, bounds array<long>, pool long")
    bounds = bounds.withColumn("pool_step", F.when(F.col("pool") > 0, coprime_step(F.col("pool"))))
    plan = plan.select("source", "size", "rows", "target", "block", "blocks", "quota", "step", "column", "offset")
    return materialize(plan), bounds


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE, cap: int = CAP, shards: int = SHARDS, row_col: str | None = None) -> DataFrame:
    """One row per row of docs: row, id, source, size, source_size, target, pieces and taken, in docs' order of rows.

    A source's documents in hash order are one stream of words, cut into blocks (1024 words, or a thousandth of a small
    source). Each pass puts the blocks in a random order of its own; the first quota blocks over all passes are drawn. The
    splitting tree says how many of a source's blocks each shard gets; the shards draw them in turn, each block once a pass.
    pieces: array of (pass, shard, slot, from_word, to_word), disjoint within a pass, so no document gives more than cap times
    its words. Source totals are within a block of their targets. Sources beyond COLUMNS share a column of the tree.

    Null text has size 0 and no pieces; null is a source of its own, last in order; rows with the same id are separate
    documents. row is a row's place in docs, or row_col where that is named. Empty tables give empty results; extra columns are
    not read.

    No window holds a whole source: sizes are summed by ranges of the hash of about GROUP_ROWS rows, then within a range.
    Rows that share an id with others, or have none, are spread over the ranges by their places.
    """
    place = F.col(row_col) if row_col else F.monotonically_increasing_id()
    slim = docs.select(place.alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"))
    slim = materialize(slim)
    repeated = materialize(slim.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("same"),
        F.lit(True).alias("again")))
    told = slim.join(repeated, F.col("id") == F.col("same"), "left") if not repeated.isEmpty() else slim.withColumn("again", F.lit(False))
    spread = F.when(F.col("id").isNull() | F.coalesce("again", F.lit(False)), F.concat(F.lit(":"), F.col("row").cast("string"))).otherwise(F.lit(""))
    slim = materialize(told.select("row", "id", "source", "size", order_key(F.col("id"), spread).alias("key")))
    totals = slim.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    plan, bounds = plan_sources(totals, weights, share, cap, shards)
    known = plan.select(F.col("source").alias("s"), F.col("size").alias("source_size"), "target", "block", "blocks", "quota", "step", "column",
        "offset", F.ceil(F.col("rows") / GROUP_ROWS).alias("groups"))
    rows = slim.join(known.select("s", "groups"), F.col("source").eqNullSafe(F.col("s"))).withColumn("part",
        F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("groups") / F.lit(1 << 32)).cast("long")).drop("s", "groups")
    base = materialize(rows.groupBy("source", "part").agg(F.sum("size").alias("words")).withColumn("base", F.sum("words").over(_before(["source"], ["part"]))))
    within = F.coalesce(F.sum("size").over(_before(["source", "part"], ["key", "size", "row"])), F.lit(0))
    placed = rows.withColumn("within", within).join(base.select(F.col("source").alias("b_source"), F.col("part").alias("b_part"), "base"),
        F.col("source").eqNullSafe(F.col("b_source")) & (F.col("part") == F.col("b_part")))
    placed = placed.withColumn("start", F.coalesce("base", F.lit(0)) + F.col("within")).join(known,
        F.col("source").eqNullSafe(F.col("s"))).join(F.broadcast(bounds), "column", "left")
    numbers = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / F.col("block")).cast("long"),
        F.floor((F.col("start") + F.col("size") - 1) / F.col("block")).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    placed = placed.withColumn("numbers", numbers)
    for e in range(cap):
        placed = placed.withColumn(f"slots{e}", permuted(F.col("numbers"), F.col("blocks"), F.col("step"), e))
    one_pass = lambda e: F.zip_with("numbers", f"slots{e}", lambda b, x: F.struct(
        F.lit(e).alias("pass"), (F.lit(e) * F.col("blocks") + x).alias("slot"),
        (F.greatest(b * F.col("block"), "start") - F.col("start")).alias("from_word"), (F.least((b + 1) * F.col("block"), F.col("start") + F.col("size")) - F.col("start")).alias("to_word")))
    pieces = F.filter(F.concat(*[one_pass(e) for e in range(cap)]), lambda p: p["slot"] < F.col("quota"))
    at = F.transform("pieces", lambda p: p["slot"] + F.col("offset"))
    places = F.when(F.col("pool").isNull(), at).otherwise(permuted(at, F.coalesce("pool", F.lit(1)), F.coalesce("pool_step", F.lit(1)), cap))
    with_shard = F.zip_with("pieces", "places", lambda p,
        a: F.struct(p["pass"].alias("pass"), F.size(F.filter("bounds", lambda x: x <= a)).alias("shard"), p["slot"].alias("slot"),
        p["from_word"].alias("from_word"), p["to_word"].alias("to_word")))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["to_word"] - p["from_word"])
    out = placed.withColumn("pieces", pieces).withColumn("places", places).withColumn("taken", taken)
    return out.select("row", F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", with_shard.alias("pieces"), "taken")


def _before(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def read_order(piece: Column, seed: str = SEED) -> Column:
    """The place of a piece within its shard: blocks in random order, whatever their sources."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.lit("read"), piece["shard"].cast("string"), piece["slot"].cast("string"), piece["pass"].cast("string")))


def by_pass(pieces: Column) -> Column:
    """The pieces of a document as an array of (shard, order, spans), one for each pass that takes any: its first shard's."""
    passes = F.array_distinct(F.transform(pieces, lambda p: p["pass"]))
    own = lambda e: F.filter(pieces, lambda p: p["pass"] == e)
    first = lambda e: F.array_min(F.transform(own(e), lambda p: F.struct(p["shard"].alias("shard"), read_order(p).alias("order"))))
    span = lambda p: F.struct(p["from_word"].alias("from_word"), p["to_word"].alias("to_word"))
    return F.transform(passes, lambda e: F.struct(first(e)["shard"].alias("shard"), first(e)["order"].alias("order"),
        F.array_sort(F.transform(own(e), span)).alias("spans")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars",
        **how) -> DataFrame:
    """docs as the mix takes them, with docs' columns: a row for each pass that takes words of a document.

    A document taken whole keeps its text; one taken in part has the words taken, in order, joined by one space, and its
    length in length_col. Documents the mix leaves out are absent. Each task writes its rows by shard and, within a shard, in
    the random order of the blocks, so that a shard's sources are shuffled where the rows are. Docs' other columns stay as
    they are, whatever their names; empty tables give empty ones.
    """
    row, size, takes, words, take = fresh(docs, "__row", "__size", "__takes", "__words", "__take")
    named = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    slim = named.select(F.col(row).alias("at"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    chosen = mix(slim, "id", row_col="at", **how).where(F.size("pieces") > 0).select(F.col("row").alias(row), F.col("size").alias(size),
        by_pass(F.col("pieces")).alias(takes))
    length = lambda p: (p["to_word"] - p["from_word"]).cast("int")
    whole = lambda g: F.aggregate(g["spans"], F.lit(0).cast("long"), lambda n, p: n + length(p)) == F.col(size)
    out = named.join(chosen, row).withColumn(words, F.when(F.exists(takes, lambda g: ~whole(g)), F.regexp_extract_all(F.col(text_col), F.lit(WORD), 0)))
    cut = lambda g: F.array_join(F.flatten(F.transform(g["spans"], lambda p: F.slice(F.col(words), (p["from_word"] + 1).cast("int"), length(p)))),
        " ")
    made = F.transform(takes, lambda g: F.struct(g["shard"].alias("shard"), g["order"].alias("order"), F.when(~whole(g), cut(g)).alias("cut")))
    out = out.withColumn(take, F.explode(made)).withColumn(text_col, F.coalesce(F.col(take)["cut"], F.col(text_col)))
    if length_col and length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col(take)["cut"].isNotNull(),
            F.length(text_col)).otherwise(F.col(length_col)).cast(docs.schema[length_col].dataType))
    return out.sortWithinPartitions(F.col(take)["shard"], F.col(take)["order"]).select(*docs.columns)
