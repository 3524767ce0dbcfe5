"""Conversation repair against a shortest-path search over whole edit sequences, and against SQL."""

import heapq
import random
import re
import zlib
from hashlib import sha256
from pathlib import Path

import pytest

from loom.llm import conversation_repair as repair
from loom.llm import queries
from loom.llm.earley import STATES, cheapest, links

FORM = re.compile(r"(s?(ua)+)?")


def plain(symbols):
    """The least (cost, audit): paths over (turns read, roles so far as a state) by a search that orders by cost, then by audit."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in ("", "a"):
            return cost, audit
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for role in "ua":
            if (state, role) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", i, step[state, role]))
        if i < len(symbols):
            x = symbols[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if not x.isdigit():
                more = 3 if x.isupper() else 0
                if (state, x.lower()) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, step[state, x.lower()]))
                for role in "ua":
                    if (state, role) in step:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, step[state, role]))


def cases():
    rng = random.Random(3)
    every = ["", *"suaoSUAO0123"]
    return [a + b + c for a in every for b in every for c in every] + ["".join(rng.choice("suaoSUA012uuaa") for _ in range(rng.randrange(4, 40))) for _ in range(300)]


def test_parse_is_cheapest_and_least():
    for symbols in cases():
        want = plain(symbols)
        assert cheapest([links(symbols)]) == want, symbols


def test_stretches_join_to_the_whole():
    rng = random.Random(4)
    for symbols in cases()[-150:]:
        cuts = sorted(rng.sample(range(1, len(symbols)), min(len(symbols) - 1, rng.randrange(1, 6))))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        assert cheapest([{k: v for p in STATES for k, v in links(x, p).items()} for x in parts]) == plain(symbols)


def planted(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_report(rows, convs):
    """conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256), a row at a time."""
    out = {}
    for conv in convs:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(r[3].encode()).digest()))
        seen, n, symbols = set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0), ""
        for _, _, role, text in own:
            said = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                n[fault] += 1
            i = role[0] if role[:1] and role[0] in "sua" else "o"
            symbols += str("suao".index(i)) if fault in ("blank", "duplicate") else i.upper() if fault else i
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit = plain(symbols)
        said, row, lead = [], 0, 0
        for e in audit:
            if e == "K":
                lead = lead or (not said and own[row][2].startswith("s"))
                said.append((own[row][2], own[row][3]))
            elif e != "D":
                said.append((("user", "assistant")[(len(said) - lead) % 2], own[row][3] if e == "R" else ""))
            row += e != "I"
        assert FORM.fullmatch("".join(r[0] for r, _ in said))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n.values(), illegal, cost, audit,
            sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return out


def test_whole_operator(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Well", "  ", "", None, "So?\n", "a. b", "Fine. \t"]
    rows = [(c, rng.choice([None, *range(12)]) if c % 7 == 0 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(texts) if c % 3 else f"t{t}.")
            for c in range(60) for t in range(rng.randrange(1, 14))]
    rows += [(None, 0, "user", "Q?"), (None, 1, "assistant", "A."), (None, None, "user", "x")]
    rows += [(900, t, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"own {t}", f"own {t}."])) for t in range(700)]
    rows += [(901, 5, "user", "Again.")] * 400 + [(902, 1, "user", "q" * 300_000 + "."), (902, 2, "assistant", "A.")]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{schema}, conv long, sha string").repartition(5)
    for bits in (8, 2):
        monkeypatch.setattr(repair, "BLOCK_BITS", bits)
        got = {r[0]: tuple(r[1:]) for r in queries.repaired(df, repair.damaged(df)).collect()}
        assert got == plain_report(planted(rows), {r[0] for r in rows})
    whole = repair.repair(df)
    digest = {r.conv: r.repaired_sha256 for r in repair.digests(whole.turns).collect()}
    want = plain_report([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows})
    assert {r.conv: (*r[1:], digest.get(r.conv, sha256(b"").hexdigest())) for r in whole.report.collect()} == want
    empty = repair.repair(spark.createDataFrame([], schema))
    assert empty.turns.count() == empty.report.count() == 0


def test_a_conversation_of_which_all_turns_go(spark):
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in queries.repaired(df, repair.damaged(df)).collect()] == [(gone[0], 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables here")
def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    got = queries.op11_conversation_repair(spark, "/root/testdata/sf0.001")
    want = con.sql(queries.oracle_sql()["op11_conversation_repair"])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert got.schema["gaps"].dataType.simpleString() == "bigint"
