import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from martloom.llm import trie
from martloom.llm.oracle import OP12

SCHEMA = "conv_id long, turn long, role string, text string, seq string, part string"


def _rows(convs, seed=1, vocabulary=3):
    """Conversations over few different turns, so that prefixes are shared at every depth."""
    rng, rows = random.Random(seed), []
    for c in convs:
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, turn * 2, rng.choice(["user", "assistant", None]) if rng.random() < 0.1 else ("user", "assistant")[turn % 2],
                         rng.choice([None, "", "a b", "c d e", "x"][: vocabulary + 1]), "s", "p"))
    return rows


def _plain(rows, heads=True):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 0 - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * words
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("partition_bytes", [1, 600, 8 << 20])
def test_trie_equals_all_prefixes(spark, rows, partition_bytes, monkeypatch):
    monkeypatch.setattr(trie, "IDS", 7)
    data = _rows(range(400)) + [(None, 0, "user", "lost", "", ""), (7, None, "user", "first", "", ""), (1000, 0, "user", "no base", "", ""), (1005, 0, "user", "x", "", "")]
    found = trie.nodes(trie.with_shared_heads(trie.sequences(_frame(spark, data))), partition_bytes)
    assert rows(found) == _plain(data)


def test_trie_of_copies_long_and_single_conversations(spark, rows):
    copies = [(c, t, "user", f"turn {t}", "", "") for c in range(0, 3000, 20) for t in range(4)]
    long = [(5001, t, "user", f"w {t % 7}", "", "") for t in range(90)]
    for data in (copies, long, copies + long + _rows(range(6000, 6100)), [(3, 0, "user", "a", "", "")], [(-15, 0, "user", "a", "", ""), (0, 0, "user", "b", "", "")]):
        assert rows(trie.prefix_trie(_frame(spark, data))) == _plain(data)


def test_trie_of_repeated_rows_and_empty_tables(spark, rows):
    data = _rows(range(40)) * 2
    assert rows(trie.prefix_trie(_frame(spark, data))) == _plain(data)
    assert trie.prefix_trie(_frame(spark, data).limit(0)).count() == 0


def test_trie_sql_agrees(spark, rows):
    data = [r for r in _rows(range(200), 5)]
    con = duckdb.connect()
    con.register("conversations", _frame(spark, data).select("conv_id", "turn", "role", "text").toArrow())
    assert rows(trie.prefix_trie(_frame(spark, data))) == sorted(con.execute(OP12).fetchall(), key=repr)


def test_forest_merges_neighbours_deepest_first():
    turn = lambda c: c.encode() * trie.DIGEST
    seqs = sorted(b"".join(turn(c) for c in word) for word in ("", "ab", "abc", "abd", "b", "bcd", "bce"))
    nodes = trie.forest(seqs, [1] * 7, list(range(7)), ["e"] * 7)
    top = nodes[-1]
    assert (top.depth, top.n, len(top.children), top.parent) == (0, 7, 2, None)
    assert sorted((n.depth, n.n, len(n.children)) for n in nodes if n.children) == [(0, 7, 2), (1, 3, 1), (2, 2, 2), (2, 3, 2)]
    assert all(child.depth > node.depth and child.parent is node for node in nodes for child in node.children)
