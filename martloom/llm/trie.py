"""Prefix trie of conversations: which turns are shared, by how many, and what sharing them saves.

Conversations become sequences of 16-byte turn digests, equal ones become one row, and distinct sequences are dealt by range,
so each partition holds a run of the sorted order. Neighbours in it share a longest common prefix (LCP). A union-find over these LCP
edges, deepest first, builds the partition's forest: every merge of two components makes a branching node at the depth of the
edge or adds a child to the one there, and the nodes between a component's depth and its parent's form a chain. Prefixes that the
first or last sequence shares over a boundary are open: their chains are contracted to sums, and sums of one prefix from all
partitions are merged. Each distinct node is owned by the partition of its first sequence, so what must be counted once is counted there.

Rows without a conversation id are left out; null role or text is empty; turns of equal number go by the digest of their content, and
repeated rows are turns of their own. An empty table has no conversation and gives no node, not even the root. Other columns are
ignored. A conversation's digests (16 bytes a turn) and word counts are one row; texts never leave the first scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import on_workers
from martloom.session import materialise

_GAP = r"[\x20\x09-\x0D]+"
#: Bytes of a turn's digest.
DIGEST = 16
#: Bytes of sequences in one partition of the sorted order, and conversation ids joined to one piece of text.
PARTITION_BYTES, IDS = 8 << 20, 4096
_NONE = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): each conversation's turns in order, as structs (digest, words)."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    content = F.concat(F.char_length(role_).cast("string"), F.lit(":"), role_, text_)
    words = F.size(F.array_remove(F.split(text_, _GAP), ""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), F.substring(F.sha2(content, 256), 1, 2 * DIGEST).alias("digest"), words.alias("words")).alias("t"))
    # Nulls sort first in an ascending array.
    ordered = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def with_shared_heads(convs: DataFrame, group: int = 20, longest: int = 4) -> DataFrame:
    """The conversations, each with its first h turns replaced by those of its group's first conversation: all it has, if
    fewer, none if it is absent; h is the crc32 of the id as text, modulo ``longest``."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % longest).cast("int")
    base = F.col("conv") - F.col("conv") % group
    heads = convs.where(F.col("conv") % group == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, longest - 1).alias("head"))
    own = convs.withColumns({"base": base, "h": h})
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<digest string, words int>>")), F.lit(1), F.col("h"))
    return own.join(heads, "base", "left").select("conv", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _piece(number: Column) -> Column:
    return F.floor(number / IDS)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(seq, words, n, first, ends): each distinct sequence once, with its conversations counted and their ids digested.

    Ids of a sequence are joined in pieces of at most IDS ids, and one task passes over a sequence's pieces in order: a sequence of
    a third of all conversations needs no more memory than one piece.
    """
    on_workers(convs.sparkSession)
    packed = convs.select(
        "conv", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("seq"), F.transform("turns", lambda t: t["words"]).alias("words"))
    pieces = packed.groupBy("seq", _piece(F.col("conv")).alias("piece")).agg(F.first("words").alias("words"), F.sort_array(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select("seq", "piece", "words", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("first"), F.array_join("ids", ",").alias("ids"))
    dealt = pieces.repartition("seq").sortWithinPartitions("seq", "piece")
    return dealt.mapInArrow(_digest_pieces, "seq binary, words array<int>, n long, first long, ends string")


def _digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("seq", pa.binary()), ("words", pa.list_(pa.int32())), ("n", pa.int64()), ("first", pa.int64()), ("ends", pa.string())])
    held = None
    for batch in batches:
        done = []
        for seq, _, words, n, first, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if held is not None and held[0] == seq:
                held[2] += n
                held[4].update(b"," + ids.encode())
                continue
            if held is not None:
                done.append((*held[:4], held[4].hexdigest()))
            held = [seq, words, n, first, hashlib.sha256(ids.encode())]
        yield from _batch(done, schema)
    if held is not None:
        yield from _batch([(*held[:4], held[4].hexdigest())], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns of the longest common prefix of two sequences."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    x, y = (np.frombuffer(s, np.uint64, 2 * n).reshape(n, 2) for s in (a, b))
    return int(np.argmax((x != y).any(1)))


class _Node:
    """A component of the union-find: sequences lo to hi, which share ``depth`` turns."""

    __slots__ = ("depth", "lo", "hi", "n", "first", "ends", "children", "parent")

    def __init__(self, depth, lo, hi, n, first, ends=None):
        self.depth, self.lo, self.hi, self.n, self.first, self.ends = depth, lo, hi, n, first, ends
        self.children: list[_Node] = []
        self.parent: _Node | None = None

    def adopt(self, child: _Node) -> None:
        child.parent = self
        self.children.append(child)
        self.lo, self.hi = min(self.lo, child.lo), max(self.hi, child.hi)
        self.n, self.first = self.n + child.n, min(self.first, child.first)


def forest(seqs: list[bytes], counts: list[int], firsts: list[int], ends: list[str]) -> list[_Node]:
    """Nodes of distinct sorted sequences, children before parents; the last one is the top."""
    nodes = [_Node(len(s) // DIGEST, i, i, n, f, e) for i, (s, n, f, e) in enumerate(zip(seqs, counts, firsts, ends))]
    top, up = list(nodes), list(range(len(seqs)))
    lcp = [shared_turns(a, b) for a, b in zip(seqs, seqs[1:])]

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    # Deepest first and, at one depth, from left to right: a right component is then always deeper than the edge.
    finished = [n for n in nodes]
    for e in sorted(range(len(lcp)), key=lambda e: -lcp[e]):
        a, b = find(e), find(e + 1)
        left, right = top[a], top[b]
        if left.depth != lcp[e]:
            branch = _Node(lcp[e], left.lo, left.hi, 0, left.first)
            branch.adopt(left)
            finished.append(branch)
            left = branch
        left.adopt(right)
        up[b] = a
        top[a] = left
    return sorted(finished, key=lambda node: -node.depth)


def _spine(seq: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of 0 to ``depth`` turns."""
    state, names = hashlib.sha256(), []
    for d in range(depth + 1):
        names.append(state.digest()[:DIGEST])
        state.update(seq[d * DIGEST : (d + 1) * DIGEST])
    return names


_NODES = ("depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "spent long, once long, ends string")


def _partition_nodes(table: pa.Table) -> pa.Table:
    """All nodes of one partition. Rows with a ``side`` are the last sequence before it (-1) and the first one after (1)."""
    rows = {name: table.column(name).to_pylist() for name in ("side", "seq", "words", "n", "first", "ends")}
    fences = {side: rows["seq"][i] for i, side in enumerate(rows["side"]) if side}
    own = sorted((i for i, side in enumerate(rows["side"]) if not side), key=lambda i: rows["seq"][i])
    seqs = [rows["seq"][i] for i in own]
    words = [rows["words"][i] for i in own]
    last = len(seqs) - 1
    # Depth to which the first sequence goes on from the partition before, and the last one into the next; -1 where there is none.
    before = shared_turns(fences[-1], seqs[0]) if -1 in fences else -1
    after = shared_turns(seqs[last], fences[1]) if 1 in fences else -1
    spines = _spine(seqs[0], before), _spine(seqs[last], after)

    def key(node: _Node, depth: int) -> bytes | None:
        if node.lo == 0 and depth <= before:
            return spines[0][depth]
        return spines[1][depth] if node.hi == last and depth <= after else None

    out: dict[str, list] = {name: [] for name in ("depth", "key", "parent_key", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "spent", "once", "ends")}
    sums: dict[int, tuple[int, int, int, int]] = {}  # node -> leaves, spent, once, 1 if owned: at the top of its chain
    for node in forest(seqs, *[[rows[c][i] for i in own] for c in ("n", "first", "ends")]):
        parts = [sums.pop(id(child)) for child in node.children]
        leaves, spent, once, children = (sum(x) for x in zip(*parts)) if parts else (0, 0, 0, 0)
        if not parts and not (node.hi == last and node.depth <= after):
            leaves = 1
        floor = node.parent.depth if node.parent else -1
        for depth in range(node.depth, floor, -1):
            owned = not (node.lo == 0 and depth <= before)
            cost = words[node.lo][depth - 1] if depth else 0
            spent += node.n * cost
            once += cost if owned else 0
            above = node if depth > floor + 1 else node.parent
            above_key = key(above, depth - 1) if depth else None
            for name, value in zip(out, (depth, key(node, depth), above_key, node.first, above.first if depth and above_key is None else None,
                                         node.n, children, leaves, spent, once, node.ends if depth == node.depth else None)):
                out[name].append(value)
            children = int(owned)
        sums[id(node)] = leaves, spent, once, children
    kinds = {"key": pa.binary(), "parent_key": pa.binary(), "ends": pa.string()}
    return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()})


def nodes(convs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the trie of (conv, turns)."""
    seqs = materialise(distinct_sequences(convs), "trie-sequences")
    held = seqs.agg(F.sum(F.octet_length("seq") + 4 * F.size("words") + 100)).first()[0] or 0
    ranged = seqs.repartitionByRange(held // partition_bytes + 1, "seq").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "trie-ranges").withColumn("side", F.lit(0))
    # One row for each partition.
    ends = ranged.groupBy("part").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    order = Window.orderBy("part")
    beside = ends.select("part", F.lag("high").over(order).alias("high"), F.lead("low").over(order).alias("low"))
    fences = beside.select("part", F.inline(F.array(
        F.struct(F.lit(-1).alias("side"), F.col("high").alias("seq")), F.struct(F.lit(1).alias("side"), F.col("low").alias("seq")))))
    bounded = ranged.unionByName(fences.where("seq is not null"), allowMissingColumns=True)
    found = materialise(bounded.groupBy("part").applyInArrow(_partition_nodes, _NODES), "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "once")]
    merged = found.where("key is not null").groupBy("depth", "key").agg(
        F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), *sums, F.max("ends").alias("ends"))
    # The prefixes that cross a boundary: as many as the boundaries are deep.
    merged = materialise(merged.select(*found.columns), "trie-boundaries")
    every = found.where("key is null").unionByName(merged)
    parents = merged.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    # Most nodes have their parent in their own partition, and stay out of the join.
    inside = every.where("parent_key is null").drop("parent_key")
    across = every.where("parent_key is not null").join(parents, ["depth", "parent_key"]).withColumn("parent_conv_id", F.col("above"))
    return inside.unionByName(across.drop("parent_key", "above")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("spent") - F.col("once")).alias("saved_tokens"), F.coalesce("ends", F.lit(_NONE)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations rebuilt with their groups' shared heads."""
    return nodes(with_shared_heads(sequences(turns, conv, turn, role, text)))
