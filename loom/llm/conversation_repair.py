"""Conversation structure repair: faults of turns are found in Spark, an error-correcting Earley parse of the roles gives the edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loom.llm.common import materialize, ship
from loom.llm.earley import INITIALS, LEGAL, STATES, cheapest, links

BLANKS = " \t\n\x0b\x0c\r"
#: Different turns of a conversation that are parsed as one stretch; stretches of longer conversations are joined.
BLOCK_BITS = 8

STEPS = "array<struct<edit:string,turn_no:int,role:string>>"
_KEY = ("conv", "turn", "role", "sha")


@dataclass(frozen=True)
class Repair:
    """turns: (conv, block, place, edit, role, text, turn); report: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit)."""

    turns: DataFrame
    report: DataFrame


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies): turns as they come with faults planted by crc32("conv_id:turn") % 20; nulls are one space.

    0 drops the turn, 1 empties its text, 2 removes . ! ? from it, 3 says it twice, 4 makes it the user's.
    """
    t = _turns(conversations, "conv_id", "turn", "role", "text")
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv"), F.lit(":"), part("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return t.where(kind != 0).select("conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """The cheapest repair of every conversation, and what was wrong with it.

    A conversation's rows go by turn (nulls first), then role, then the text's SHA-256. Faults, the first counts: blank (no
    character but blanks), duplicate (role and text seen earlier), truncated (the last character that isn't blank is not . ! or ?). A null
    role or text is one space; a null conversation is one of its own; a role whose initial isn't s, u or a can't be kept as it is, nor
    can an empty one. Repeated rows are duplicates. Other columns are not read. An empty table gives empty ones.

    Only (conversation, turn, role, SHA-256) with counts are sorted, by range over all of them, so that a long conversation is dealt to
    many tasks; repeated rows are counted before the shuffle. Stretches of 256 different turns are parsed where they are, to links
    between the states in which a stretch may begin and end; one task joins the links of a conversation, about ten bytes a turn.
    Texts are shuffled once, and meet the kept turns on all parts of their key.
    """
    copied = _turns(conversations, conv_col, turn_col, role_col, text_col).withColumn("copies", F.lit(1).cast("long"))
    return repair_counted(copied)


def repair_counted(turns: DataFrame) -> Repair:
    """repair() of (conv, turn, role, text, copies): rows that stand for several alike."""
    ship(turns.sparkSession)
    turns = turns.withColumn("sha", F.unhex(F.sha2("text", 256)))
    said = F.rtrim("text", F.lit(BLANKS))
    keys = turns.select(*_KEY, "copies", (said == "").alias("blank"), (~F.substring(said, -1, 1).isin(".", "!", "?")).alias("cut"))
    keys = keys.groupBy(*_KEY).agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = keys.groupBy("conv", "role", "sha").agg(F.min(when)["turn"].alias("turn")).withColumn("first", F.lit(True))
    keys = _on_key(keys, first, "left").withColumn("first", F.coalesce("first", F.lit(False)))
    order = ("conv_known", "conv", "turn_known", "turn", "role", "sha")
    own = {"conv_known": F.col("conv").isNotNull(), "turn_known": F.col("turn").isNotNull()}
    n = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    ordered = materialize(keys.withColumns(own).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))

    item = F.struct("at", _symbols().alias("symbols"), "turn", "role", "sha")
    blocks = ordered.groupBy("conv", F.shiftright("at", BLOCK_BITS).alias("b")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    blocks = materialize(blocks.select("conv", F.col("items")[0]["at"].alias("block"), "items"))
    parsed = materialize(_parsed(blocks.select("conv", "block", F.col("items.symbols").alias("symbols"))))

    steps = parsed.select("block", "steps").join(blocks, "block").select("conv", "block", "items", F.posexplode("steps").alias("place", "step"))
    steps = steps.select("conv", "block", "place", F.col("step.edit").alias("edit"), F.col("step.role").alias("new_role"),
        F.when(F.col("step.turn_no").isNotNull(), F.expr("items[step.turn_no]")).alias("item"))
    steps = steps.select("conv", "block", "place", "edit", "new_role", F.col("item.turn").alias("turn"), F.col("item.role").alias("role"),
        F.col("item.sha").alias("sha"))
    texts = turns.groupBy(*_KEY).agg(F.first("text").alias("text"))
    out = _on_key(steps, texts, "left").select("conv", "block", "place", "edit", F.coalesce("new_role", "role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "turn")
    return Repair(out, _report(ordered, parsed))


def _on_key(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """left with right's other columns, joined on the whole key, nulls alike."""
    right = right.withColumnsRenamed({c: f"{c}__" for c in _KEY})
    on = F.lit(True)
    for c in _KEY:
        on = on & left[c].eqNullSafe(right[f"{c}__"])
    return left.join(right, on, how).drop(*[f"{c}__" for c in _KEY])


def _symbols() -> Column:
    """The symbols of a row and of its copies, see earley."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    gone = F.translate(initial, INITIALS, "0123")
    sound = ~F.col("blank") & F.col("first")
    head = F.when(~sound, gone).when(F.col("cut"), F.upper(initial)).otherwise(initial)
    return F.concat(head, F.repeat(gone, (F.col("copies") - 1).cast("int")))


def _parsed(blocks: DataFrame) -> DataFrame:
    """(conv, block, steps, cost, audit, illegal): the edits of each stretch; cost, audit and illegal stand with a conversation's first."""
    kind = blocks.schema["conv"].dataType
    mask = (1 << BLOCK_BITS) - 1
    linked = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL("block long, symbols array<string>, links string").fields])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The links of each stretch; one that begins a block may go on from any state, others begin a conversation."""
        for batch in batches:
            out = []
            for block, symbols in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = {k: v for p in (STATES if block & mask == 0 else STATES[:1]) for k, v in links("".join(symbols), p).items()}
                out.append(" ".join(f"{p}:{q}:{cost}:{audit}" for (p, q), (cost, audit) in found.items()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "links"])

    result = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(f"block long, steps {STEPS}, cost long, audit string, illegal long").fields])
    arrow = pa.list_(pa.struct([("edit", pa.string()), ("turn_no", pa.int32()), ("role", pa.string())]))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        def batch(convs: list, found: list) -> pa.RecordBatch:
            b, s, c, a, i = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(b, pa.int64()), pa.array(s, arrow), pa.array(c, pa.int64()),
                pa.array(a, pa.string()), pa.array(i, pa.int64())], names=result.names)

        conv_type = _arrow_type(kind)
        held, convs, found = [], [], []
        for row in rows():
            if held and held[0][0] != row[0]:
                found += _settled(held)
                convs += [held[0][0]] * len(held)
                held = []
                if len(found) >= 1000:
                    yield batch(convs, found)
                    convs, found = [], []
            held.append(row)
        if held:
            found += _settled(held)
            convs += [held[0][0]] * len(held)
            yield batch(convs, found)

    return blocks.mapInArrow(parse, linked).repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(settle, result)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _settled(stretches: list[tuple]) -> list[tuple]:
    """(block, steps, cost, audit, illegal) of one conversation's stretches (conv, block, symbols, links) in order."""
    found = []
    for _, _, _, text in stretches:
        parts = [x.split(":") for x in text.split(" ")]
        found.append({(p, q): (int(cost), audit) for p, q, cost, audit in parts})
    cost, audit = cheapest(found)
    out, at, spoken, system, illegal, before = [], 0, 0, 0, 0, ""
    for k, (_, block, symbols, _) in enumerate(stretches):
        steps, row = [], 0
        heads = {}
        for number, s in enumerate(symbols):
            heads[row] = number
            row += len(s)
        initials = before + "".join(s.lower() if s.isalpha() else INITIALS[int(s)] for s in "".join(symbols))
        illegal += sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        before = initials[-1:]
        left, whole, row = row, "".join(symbols), 0
        while at < len(audit) and (left or audit[at] == "I" and k == len(stretches) - 1):
            edit = audit[at]
            at += 1
            if edit == "D":
                pass
            elif edit == "K":
                system = system or (spoken == 0 and whole[row].lower() == "s")
                steps.append({"edit": "K", "turn_no": heads[row], "role": None})
            else:
                steps.append({"edit": edit, "turn_no": heads[row] if edit == "R" else None, "role": "assistant" if (spoken - system) % 2 else "user"})
            spoken += edit != "D"
            if edit != "I":
                row, left = row + 1, left - 1
        out.append([block, steps, None, None, None])
    out[0][2:] = [cost, audit, illegal]
    return [tuple(x) for x in out]


def _report(ordered: DataFrame, parsed: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit): a row for each conversation with rows."""
    n = F.col("copies")
    count = lambda c: F.sum(c).cast("long")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    faults = ordered.groupBy("conv").agg(gaps.alias("gaps"), count(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        count(F.when(F.col("blank"), 0).when(F.col("first"), n - 1).otherwise(n)).alias("duplicate"),
        count(F.when(~F.col("blank") & F.col("first") & F.col("cut"), 1).otherwise(0)).alias("truncated"))
    edits = parsed.where(F.col("audit").isNotNull()).select(F.col("conv").alias("conv__"), "illegal", "cost", "audit")
    return faults.join(edits, F.col("conv").eqNullSafe(F.col("conv__"))).drop("conv__")


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of turns (conv, block, place, role, text): of "role:text" of a conversation's turns, joined by line ends.

    One digest needs a conversation's texts one after another: they are sorted on disk and stream through, a batch at a time.
    """
    kind = turns.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, now, sha = _arrow_type(kind), None, None

        def batch(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], conv_type), pa.array([s for _, s in done], pa.string())],
                names=["conv", "repaired_sha256"])

        for part in batches:
            done = []
            for conv, role, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                if sha is not None and conv != now:
                    done.append((now, sha.hexdigest()))
                    sha = None
                piece = f"{role}:{text}".encode()
                if sha is None:
                    now, sha = conv, hashlib.sha256(piece)
                else:
                    sha.update(b"\n" + piece)
            if done:
                yield batch(done)
        if sha is not None:
            yield batch([(now, sha.hexdigest())])

    own = turns.select("conv", "role", "text", "block", "place").repartition("conv").sortWithinPartitions("conv", "block", "place")
    return own.select("conv", "role", "text").mapInArrow(run, T.StructType([T.StructField("conv", kind), T.StructField("repaired_sha256", T.StringType())]))
