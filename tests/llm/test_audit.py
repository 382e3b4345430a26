import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from martloom.llm import audit
from martloom.llm.oracle import OP11

_RNG = random.Random(11)
_POOL = [f"word{i}" for i in range(400)]


def _text(n, pool=_POOL):
    return " ".join(_RNG.choice(pool) for _ in range(n))


LONG = _text(300)
TEXTS = [
    None, "", "", " \n\x0b\t", LONG, LONG, LONG, LONG + " ", LONG + " $", _text(250), _text(250, ["a", "b"]), _text(250, ["A", "b"]), "A", "A", "a|b",
    "É" * 300, "wörter " * 250, _text(20_000), " x y " * 220, " ".join(_POOL[:210]), LONG.upper(),
]
SCHEMA = "doc_id long, text string, source string, mask string, digest string, part string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 2}", "x", "x", "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (None, LONG, "s1", "", "", ""), (None, None, None, "", "", ""), rows[4], rows[5], (100, LONG, "", "", "", "")], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 3 % 2, "x") for i in range(0, 21, 2)] + [(4, 1, 0, "x"), (4, None, None, "x"), (None, 1, 1, "x"), (999, 1, 1, "x"), (5, 1, 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string")


def _plain(docs, labels):
    """Every order by itself, document by document."""
    rows = [(r.doc_id, r.text or "", r.source or "") for r in docs.collect()]
    good, toxic = set(), set()
    for r in labels.collect():
        if r.doc_id is not None:
            good |= {r.doc_id} if r.quality == 1 else set()
            toxic |= {r.doc_id} if r.toxic == 1 else set()
    failing = []
    for i, text, part in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any(j is not None and j < i and t == text for j, t, _ in rows),
        }
        failing.append((part, {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    shapley, out = Counter(), {}
    for order in permutations("ABCDE"):
        for part in {p for p, *_ in failing}:
            left = [x for x in failing if x[0] == part]
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                own = [x for x in failing if x[0] == part and f in x[1]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(own) - len(gone), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)]
    return {(p, o, s): (*v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def _found(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def test_audit_equals_every_order_by_itself(docs, labels):
    found = audit.audit(docs, labels)
    assert found.count() == 600 * 3 and _found(found) == _plain(docs, labels)


def test_audit_sql_agrees_on_odd_rows(docs, labels):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    con.register("labels", labels.select("doc_id", "quality", "toxic").toArrow())
    rows = con.execute(OP11).fetchall()
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in rows} == _found(audit.audit(docs, labels))


def test_audit_of_empty_tables(docs, labels):
    assert audit.audit(docs.limit(0), labels).count() == 0
    none = _found(audit.audit(docs, labels.limit(0)))
    assert len(none) == 1800 and all(v[4] == v[5] == 0 for v in none.values())


def test_sketch_clears_unique_texts_and_no_repeated_one(spark):
    """Of 20,000 texts all 2,000 repeats are possible ones, and few others."""
    rows = spark.range(22_000).select("id", F.xxhash64((F.col("id") % 20_000).cast("string")).alias("hash"))
    possible = {r.id for r in audit.possible_repeats(rows, audit.sketch(rows, 22_000), 22_000).collect()}
    repeats = {*range(2_000), *range(20_000, 22_000)}
    assert repeats <= possible and len(possible - repeats) < 0.02 * 18_000


def test_a_group_of_copies_is_one_row_for_each_task(spark, labels):
    copies = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"), F.lit("s").alias("source"))
    found = _found(audit.audit(copies, labels))
    assert found["s", "EABCD", 1][:2] == (1, 4_999) and found["s", "ABCDE", 5][:2] == (1, 4_999)
    plan = audit.sketch(audit.facts(copies), 5_000)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
