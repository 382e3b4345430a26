"""N-gram Jaccard join: groups of documents linked by word shingles with Jaccard similarity of 0.8 or more.

Exact prefix filtering over distinct sets, with the two skips of set-relation joins.

1. Every shingle is sent once per distinct set to a shard, a range of the hash space. The shard knows in how many sets
   it occurs and returns only shingles that occur in two or more: the others cannot be common, and their number
   is known as the set's size less the returned ones.
2. A set's shingles are ordered from rare to frequent. Two sets that pass the threshold share a shingle within their first
   n - ceil(0.8 n) + 1. A set whose prefix holds only shingles of its own is done; the others enter index lists
   with the position. Frequent passages stand last in the order and enter no list, unless a set has little else.
3. Lists skip by set relation: a list's sets are compared with a leader first. A set that is highly similar to the
   leader is of its group: inside a group no more comparisons are needed, and lists whose sets are all in one
   group are finished. Rounds with new leaders go on while they shrink what is left; the rest is
   joined pair by pair: lists have no blocks, every pair of a list's entries is formed first and then dropped by a
   filter on size, position and marks: a few words whose bits are turned by each shared shingle. Bits that differ are
   shingles that only one of two sets has. So a group of F near copies costs F comparisons, not F squared, but a long
   list whose sets are not linked costs its square in pairs formed.

Shingles are 64-bit hashes. Equal sets are one set. Null, blank and empty texts have empty sets and are linked with
nothing. Rows of a repeated id stay separate rows; a null id is never the smallest of a group with other ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import components, map_texts, numbered, on_workers, slices
from martloom.llm.grams import Words, follow, mix, pack, planes, shard_ends, text_bytes, tokens, unpack, unplanes
from martloom.session import materialise

#: Words in a shingle, and the least similarity in hundredths.
WORDS, PERCENT = 5, 80
#: Bytes of text whose shingles a shard counts.
SHARD = 16 << 20
#: Shingles of a prefix that families first meet by, rounds of leaders at most, and pairs for each list entry below
#: which the rest is joined at once.
SEEDS, ROUNDS, FEW = 2, 8, 4
#: Words of 64 bits in the marks of a set; fewer or more only change how many pairs are compared.
MARKS = 8


def shingle_sets(texts: list[str | None], width: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than the width make one shingle."""
    words = Words()
    ids = [words.add(tokens(t)) for t in texts]
    hashes = words.hashes()
    out = []
    for sequence in ids:
        h = hashes[np.array(sequence, np.int64)]
        n = max(1, len(h) - width + 1) if len(h) else 0
        span = min(width, len(h))
        value = np.full(n, np.uint64(span))
        for i in range(span):
            value = follow(value, h[i : i + n])
        out.append(np.unique(mix(value)))
    return out


def _signature(shingles: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def sets_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, set, n_shingles): ``set`` identifies the document's distinct shingles; null for an empty set."""

    def make():
        def step(c):
            found = shingle_sets(c["text"])
            return {"key": c["key"], "set": [_signature(s) for s in found], "n_shingles": [len(s) for s in found]}

        return step

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_texts(rows, "text", f"key {kind}, set long, n_shingles long", make)


def _send(batches, shards: int):
    """Shingles of a slice of documents by shard: sorted keys, and for each the number of its set among those listed."""
    names = ["shard", "keys", "member", "sets", "sizes"]
    for batch in batches:
        for part in slices(batch, "text"):
            by_set = {}
            for s in shingle_sets(part.column(0).to_pylist()):
                if len(s):
                    by_set.setdefault(_signature(s), s)
            if not by_set:
                continue
            ids, found = np.array(list(by_set), np.int64), list(by_set.values())
            sizes = np.array([len(s) for s in found], np.int64)
            keys, member = np.concatenate(found), np.repeat(np.arange(len(found), dtype=np.int32), sizes)
            order = np.argsort(keys, kind="stable")
            keys, member, start, rows = keys[order], member[order], 0, []
            for shard, end in enumerate(shard_ends(keys, shards)):
                if end > start:
                    used, local = np.unique(member[start:end], return_inverse=True)
                    small = local.astype(np.uint16 if len(used) < 65536 else np.uint32)
                    rows.append((shard, pack(keys[start:end]), small.tobytes(), ids[used].tobytes(), sizes[used].astype(np.int32).tobytes()))
                start = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names)


def _gather(table: pa.Table, with_df: bool = False):
    """Entries of packed rows: keys, the set of each, the set's size, and the number of sets of the key."""
    keys, sets, sizes, numbers = [], [], [], []
    for row in table.select(["keys", "member", "sets", "sizes", *["df"] * with_df]).to_pylist():
        ids = np.frombuffer(row["sets"], np.int64)
        local = np.frombuffer(row["member"], np.uint16 if len(ids) < 65536 else np.uint32)
        keys.append(unpack(row["keys"]))
        sets.append(ids[local])
        sizes.append(np.frombuffer(row["sizes"], np.int32)[local])
        if with_df:
            numbers.append(unplanes(row["df"], np.uint32))
    return [np.concatenate(x) for x in (keys, sets, sizes, *[numbers] * with_df)]


def _shared(table: pa.Table, parts: int) -> pa.Table:
    """Shingles of a shard that occur in two or more sets, with their number of sets, for each range of set ids."""
    keys, sets, sizes = _gather(table)
    order = np.argsort(keys, kind="stable")
    keys, sets, sizes = keys[order], sets[order], sizes[order]
    same = keys[1:] == keys[:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    keys, sets, sizes = keys[twice], sets[twice], sizes[twice]
    order = np.lexsort((sets, keys))
    keys, sets, sizes = keys[order], sets[order], sizes[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
    keys, sets, sizes = keys[fresh], sets[fresh], sizes[fresh]
    _, at, number = np.unique(keys, return_inverse=True, return_counts=True)
    number = number[at].astype(np.uint32)
    order = np.argsort(sets, kind="stable")  # keys stay in order within a range of sets after the next sort
    part = np.empty(len(sets), np.int64)
    start = 0
    for i, end in enumerate(shard_ends((sets[order].view(np.uint64) ^ np.uint64(1 << 63)), parts)):
        part[order[start:end]] = i
        start = end
    rows = []
    for i in np.unique(part[number > 1]).tolist():
        own = (part == i) & (number > 1)
        used, first, local = np.unique(sets[own], return_index=True, return_inverse=True)
        small = local.astype(np.uint16 if len(used) < 65536 else np.uint32)
        rows.append((i, pack(keys[own]), small.tobytes(), used.tobytes(), sizes[own][first].tobytes(), planes(number[own])))
    kinds = (pa.int32(), *[pa.binary()] * 5)
    columns = zip(*rows) if rows else [[]] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["part", "keys", "member", "sets", "sizes", "df"])


def _marks(keys: np.ndarray, at: np.ndarray, sets: int) -> pa.StructArray:
    """The parity of each set's shingles on every bit."""
    words = np.zeros((sets, MARKS), np.uint64)
    bit = keys.view(np.uint64) % np.uint64(64 * MARKS)
    np.bitwise_xor.at(words, (at, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(w).view(np.int64)) for w in words.T], [f"m{i}" for i in range(MARKS)])


def _rank(table: pa.Table) -> pa.Table:
    """Sets of a range whose prefix reaches a shared shingle, their shared shingles from rare to frequent."""
    keys, sets, sizes, number = _gather(table, with_df=True)
    order = np.lexsort((keys, number, sets))
    keys = keys[order].view(np.int64)
    ids, first, at, shared = np.unique(sets[order], return_index=True, return_inverse=True, return_counts=True)
    n = sizes[order][first].astype(np.int64)
    # n - shared shingles are the set's own and stand first; the prefix has n - ceil(PERCENT n / 100) + 1.
    prefix = shared + (n * PERCENT + 99) // 100 * -1 + 1
    kept = prefix > 0
    offsets = np.concatenate([[0], np.cumsum(shared[kept])])
    ranked = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[kept[at]]))
    marks = _marks(keys, at, len(ids)).filter(pa.array(kept))
    columns = [pa.array(ids[kept]), pa.array(n[kept].astype(np.int32)), pa.array((n - shared)[kept].astype(np.int32)), ranked, pa.array(prefix[kept].astype(np.int32)), marks]
    return pa.table(columns, ["set", "n", "alone", "ranked", "prefix", "marks"])


def _ranked_sets(docs: DataFrame, text: str) -> DataFrame:
    """(set, n, alone, ranked, prefix, marks): sets whose prefix reaches a shared shingle. ``alone`` shingles of their own come
    first in the order, then ``ranked``, the shared ones from rare to frequent; ``prefix`` of these are in the prefix."""
    shards = max(1, -(-text_bytes(docs, text) // SHARD))

    def send(batches):
        return _send(batches, shards)

    def shared(table: pa.Table) -> pa.Table:
        return _shared(table, shards)

    marks = ", ".join(f"m{i}: long" for i in range(MARKS))
    packed = "keys binary, member binary, sets binary, sizes binary"
    sent = docs.select(F.col(text).alias("text")).mapInArrow(send, f"shard int, {packed}")
    returned = sent.groupBy("shard").applyInArrow(shared, f"part int, {packed}, df binary")
    ranked = returned.groupBy("part").applyInArrow(_rank, f"set long, n int, alone int, ranked array<long>, prefix int, marks struct<{marks}>")
    return materialise(ranked, "jaccard-sets")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The groups of the pairs (a, b) whose sets pass the threshold, by the exact size of their intersection."""
    met = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    sets = materialise(sets.join(materialise(met, "jaccard-met"), "set", "left_semi"), "jaccard-met-sets")  # only these are dealt out
    left = sets.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("ranked").alias("keys_b"))
    right = sets.select(F.col("set").alias("a"), F.col("n").alias("n_a"), F.col("ranked").alias("keys_a"))
    both = pairs.join(left, "b").join(right, "a")
    common = F.size(F.array_intersect("keys_a", "keys_b"))
    return both.where(100 * common >= PERCENT * (F.col("n_a") + F.col("n_b") - common)).select("group_a", "group_b")


def _relabel(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels after groups were merged: ``merged`` maps groups, which go by the id of one of their sets."""
    onward = merged.select(F.col("node").alias("component"), F.col("component").alias("onward"))
    moved = labels.join(onward, "component", "left").select("node", F.coalesce("onward", "component").alias("component"))
    return moved.unionByName(merged.join(labels, "node", "left_anti"))


def _sizes_fit(a: str, b: str):
    return 100 * F.least(F.col(a), F.col(b)) >= PERCENT * F.greatest(F.col(a), F.col(b))


def _marks_fit(a: str, b: str):
    """Whether sets may pass whose marks differ as they do: n less alone shingles are shared, and each bit that differs
    is one of these that is not in both."""
    differ = sum(F.bit_count(F.col(f"marks_{a}.m{i}").bitwiseXOR(F.col(f"marks_{b}.m{i}"))) for i in range(MARKS))
    both, shared = F.col(f"n_{a}") + F.col(f"n_{b}"), F.col(f"n_{a}") + F.col(f"n_{b}") - F.col(f"alone_{a}") - F.col(f"alone_{b}")
    return (100 + PERCENT) * (shared - differ) >= 2 * PERCENT * both


def _with_groups(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of sets with the group each is in by now: its own id where it has no link."""
    known = labels.select(F.col("node").alias("set"), F.col("component").alias("known"))
    return sets.drop("group").join(known, "set", "left").withColumn("group", F.coalesce("known", "set")).drop("known")


def _open_lists(entries: DataFrame, turn: int) -> tuple[DataFrame, int, int]:
    """Lists that hold two groups or more, with a leader each; entries in them; pairs of different groups in them.

    The leader is of the largest group, whose answers are then derived for the rest of the list; in it, the least set
    by a hash of the turn, so lists of the same sets have the same leader.
    """
    lead = F.min(F.struct(F.xxhash64("set", F.lit(turn)).alias("h"), "set", "n")).alias("lead")
    cells = entries.groupBy("key", "group").agg(F.count("*").alias("c"), lead)
    lists = cells.groupBy("key").agg(
        F.count("*").alias("groups"), F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("cc"),
        F.min(F.struct((-F.col("c")).alias("less"), "lead", "group")).alias("lead"))
    lists = materialise(lists.where("groups > 1").select("key", "c", "cc", F.col("lead.lead.set").alias("a"), F.col("lead.lead.n").alias("n_a"), F.col("lead.group").alias("group_a")), "jaccard-open")
    pairs = F.sum((F.col("c") * F.col("c") - F.col("cc")) / 2)
    return lists, *lists.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(pairs, F.lit(0))).first()


def _merge(met: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels after the pairs that met and pass the threshold merged their groups."""
    pairs = met.where((F.col("group_a") != F.col("group_b")) & _sizes_fit("n_a", "n_b")).select("a", "b", "group_a", "group_b")
    found = _similar(materialise(pairs.distinct(), "jaccard-pairs"), sets)
    merged = components(found.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
    return materialise(_relabel(labels, materialise(merged, "jaccard-merged")), "jaccard-groups")


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, component) of the sets that have a link; enough pairs are compared that no link between groups is missed."""
    spark = docs.sparkSession
    sets = _ranked_sets(docs, text)
    labels = spark.createDataFrame([], "node long, component long")
    before, size = None, F.least("prefix", F.lit(SEEDS))
    # First only the most frequent shingles of each prefix: families of near copies meet there, at SEEDS entries a set.
    seeds = sets.select("set", "n", F.explode(F.slice("ranked", F.col("prefix") - size + 1, size)).alias("key"))
    for turn in range(ROUNDS):
        lists, entries, left = _open_lists(_with_groups(seeds, labels), turn)
        if not entries or (before is not None and left > 0.7 * before):
            break
        one = _with_groups(seeds, labels).select("key", F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("group").alias("group_b"))
        labels, before = _merge(lists.select("key", "a", "n_a", "group_a").join(one, "key"), sets, labels), left
    # Then the whole prefixes, in lists that are still open.
    heads = sets.select("set", "n", "alone", F.slice("ranked", 1, F.col("prefix")).alias("head"))  # no more than that is dealt out
    full = _with_groups(heads, labels).select("set", "n", "alone", "group", F.posexplode("head").alias("i", "key"))
    waiting = full.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key")
    full = materialise(full.join(materialise(waiting, "jaccard-waiting"), "key", "left_semi"), "jaccard-lists")
    full, before = full.select("key", "set", "n", "alone", (F.col("alone") + F.col("i")).alias("place")), None
    for turn in range(ROUNDS + 1):
        grouped = _with_groups(full, labels)
        lists, entries, left = _open_lists(grouped, turn)
        if not entries:
            break
        full = materialise(full.join(lists.select("key"), "key", "left_semi"), "jaccard-lists")
        grouped = _with_groups(full, labels)
        one = grouped.select("key", F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("group").alias("group_b"))
        if left <= FEW * entries or turn == ROUNDS or (before is not None and left > 0.7 * before):
            grouped = grouped.join(sets.select("set", "marks"), "set")
            rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
            one, two = (grouped.select("key", F.col("set").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "alone", "place", "group", "marks")]) for x in "ab")
            both = one.join(two, "key").where((F.col("a") < F.col("b")) & (F.col("group_a") != F.col("group_b")) & ((100 + PERCENT) * rest >= PERCENT * (F.col("n_a") + F.col("n_b"))))
            both = both.where(_marks_fit("a", "b"))
            return _merge(both, sets, labels)
        labels, before = _merge(lists.select("key", "a", "n_a", "group_a").join(one, "key"), sets, labels), left
    return labels


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id): one row per input row; the component is the smallest id reachable by links."""
    on_workers(docs.sparkSession)
    members = materialise(sets_of(docs, key, text), "jaccard-members")
    labels = links(docs, text).select(F.col("node").alias("set"), F.col("component").alias("linked"))
    placed = members.join(labels, "set", "left").withColumn("group", F.coalesce("linked", "set"))
    lowest = placed.where("group is not null").groupBy("group").agg(F.min("key").alias("lowest"))
    out = placed.join(lowest, "group", "left")
    return out.select(F.col("key").alias(key), "n_shingles", F.coalesce("lowest", "key").alias("component_id"))


def first_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of which each group linked by Jaccard similarity keeps one, all columns.

    Rows are judged by their own text, whatever their key: the row kept is the one of the least key, then of the least
    hash of the text and of the row; rows without a key come last. Rows without words are linked with nothing and stay; of
    rows that are equal in all columns, key included, one stays, unless they have neither key nor words.
    """
    on_workers(docs.sparkSession)
    names, mark = docs.columns, "row"
    docs, key, text = numbered(docs), f"c{names.index(key)}", f"c{names.index(text)}"
    # Maps have no hash and are hashed as JSON.
    columns = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    order = F.struct(
        F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("t1"), F.hash(F.col(text)).alias("t2"),
        F.xxhash64(F.col(key).isNull(), *columns).alias("t3"))
    marked = docs.withColumn(mark, order)
    # ASCII white space, as in the words of shingles.
    worded = F.coalesce(F.col(text).rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    members = materialise(sets_of(marked.where(worded), mark, text), "jaccard-members")
    labels = links(docs, text).select(F.col("node").alias("set"), F.col("component").alias("linked"))
    placed = members.join(labels, "set", "left").groupBy(F.coalesce("linked", "set").alias("group")).agg(F.min("key").alias("first"))
    hashes = ["t1", "t2", "t3"]
    flat = marked.select("*", *[F.col(f"{mark}.{h}").alias(f"{mark}_{h}") for h in hashes])
    keys = [f"{mark}_{h}" for h in hashes]
    first = materialise(placed.select(*[F.col(f"first.{h}").alias(k) for h, k in zip(hashes, keys)]).distinct(), "jaccard-first")
    kept = flat.where(worded).join(first, keys, "left_semi").dropDuplicates([key, *keys])
    kept = kept.unionByName(flat.where(~worded & F.col(key).isNotNull()).dropDuplicates([key, *keys]))
    return kept.drop(mark, *keys).unionByName(docs.where(~worded & F.col(key).isNull())).toDF(*names)
