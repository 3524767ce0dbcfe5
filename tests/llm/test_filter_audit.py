"""Filter interaction audit against a plain replay, and against SQL."""

import random
import re
from collections import Counter
from itertools import permutations
from pathlib import Path

import pyarrow as pa
import pytest

from loom.llm import filter_audit, queries


def plain_flags(docs):
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(i is not None and doc_id is not None and i < doc_id and (t or "") == text for i, t, _ in docs)
        out.append([len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search("[#$%&*|]", text)), smaller])
    return out


def plain_audit(docs, labels):
    flags = plain_flags(docs)
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {p or "" for _, _, p in docs}:
        own = [(f, d[0]) for f, d in zip(flags, docs) if (d[2] or "") == part]
        total = Counter()
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[0][f]]
                kept = [x for x in left if not x[0][f]]
                redundant = sum(x[0][f] for x in own) - len(gone)
                unique = sum(x[0][f] and sum(x[0]) == 1 for x in own)
                letters = "".join("ABCDE"[i] for i in order)
                out[part, letters, step] = [len(kept), len(gone), redundant, unique, sum(x[1] in good for x in gone), sum(x[1] in toxic for x in gone)]
                total["ABCDE"[f]] += len(gone)
                left = kept
        for key in [k for k in out if k[0] == part]:
            out[key].append(total[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def texts():
    rng = random.Random(9)
    make = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    common, rich = ["a", "B", "c\td", "é"], [f"w{i}" for i in range(5000)]
    out = [None, "", "  ", "UPPER", "x | y", "tab stays", *[make(rng.choice([3, 199, 200, 201, 400]), rng.choice([common, rich])) for _ in range(60)]]
    return out + [make(250, rich) + " $", make(250, rich) + "\n#", make(60_000, rich), make(60_000, common)] + [make(220, rich)] * 3


def test_bits_of_texts():
    own = texts()
    want = [sum(bit << i for i, bit in enumerate(f[:4])) for f in plain_flags([(None, t, None) for t in own])]
    assert filter_audit.text_failures(pa.array(own, pa.string())).tolist() == want
    assert filter_audit.text_failures(pa.array(own, pa.string())[7:31]).tolist() == want[7:31]
    assert filter_audit.text_failures(pa.array([], pa.string())).tolist() == []


def test_against_plain_replay(spark):
    rng = random.Random(10)
    own = [(i, t, rng.choice(["de", "en", None, ""])) for i, t in enumerate(texts())]
    copies = " ".join(f"v{i}" for i in range(300))
    own += [(1000 + i, copies, "en") for i in range(40)] + [(7, copies, "fr"), (7, copies, "fr"), (None, copies, "fr"), (None, None, None), (3, "other", "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1040, 2)] + [(7, 0, 0), (7, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*d, 1, "x") for d in own], "doc_id long, text string, lang string, step int, part string").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = queries.audited(df, lab).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == plain_audit(own, labels)
    assert len(got) == 600 * 4
    assert queries.audited(df.limit(0), lab).count() == 0 and queries.audited(df, lab.limit(0)).count() == 2400


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables here")
def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = queries.op13_filter_audit(spark, "/root/testdata/sf0.001")
    want = con.sql(queries.oracle_sql()["op13_filter_audit"])
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
