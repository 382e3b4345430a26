"""How quality filters interact: what each removes, alone, after others, and over all orders.

One scan of the texts gives every document a mask of the filters that it fails, all but the duplicate filter, and writes it
with two hashes of the text; texts themselves never move. Duplicates go through a counting-Bloom prepass: each text counts
in HASHES slots of one segment of a sketch with SLOTS_PER_TEXT slots for each text. Spark's partial aggregation makes the
sketch of each task and the shuffle merges them; what stays is one bit per slot, set where two texts or more met. A text
with an unset bit is unique for certain, and only the others are shuffled by the SHA-256 of their whole text for the
smallest id. So segments are rows of 4 KB that Spark joins by its own measure of size: sent to all tasks while they are few.

Documents that fail the duplicate filter then move from one mask to another: counts by (part, mask) are sums of signed rows,
at most 32 for a part, and all orders and steps are answered from these sums.

Null and empty texts are one text, null parts the empty one. A null id is no smaller id, and has none smaller: it neither makes nor is a
duplicate. Rows of a repeated id and text are not smaller than each other, so they are duplicates only of another id.
A document has a label if any of its rows in ``labels`` has it. Other columns are ignored; no documents give no rows.
"""

from __future__ import annotations

import json
import string
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import materialise

#: Filters in the order of their bits.
FILTERS = "ABCDE"
_DUPLICATE = 1 << FILTERS.index("E")
_GAP = r"[\x20\x09-\x0D]+"
#: Slots of a segment (a bitmap of 4 KB), slots of the sketch for each text, and slots that a text counts in.
SEGMENT, SLOTS_PER_TEXT, HASHES = 1 << 15, 16, 3


def failures(text: Column) -> list[Column]:
    """Failure conditions of A (short), B (repetitive), C (capitals) and D (markup signs) for a text that is not null."""
    words = F.array_remove(F.split(text, _GAP), "")
    letters = F.char_length(text) - F.char_length(F.translate(text, string.ascii_uppercase, ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * letters > 2 * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]


def facts(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(id, part, mask, hash, digest): one row per document, without its text."""
    rows = docs.select(
        F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failures(F.col("text")))]
    return rows.select(
        "id", "part", sum(bits[1:], bits[0]).alias("mask"), F.xxhash64("text").alias("hash"), F.unhex(F.sha2("text", 256)).alias("digest"))


def _slots(hashed: Column) -> list[Column]:
    again = F.xxhash64(hashed)
    return [F.shiftrightunsigned(again, 15 * i).bitwiseAND(SEGMENT - 1) for i in range(HASHES)]


def sketch(hashes: DataFrame, texts: int) -> DataFrame:
    """(segment, bits): the slots in which at least two of the ``hash`` rows met; segments without any are left out."""
    slots = hashes.select(_segment(texts).alias("segment"), F.explode(F.array_distinct(F.array(*_slots(F.col("hash"))))).alias("slot"))
    crowded = slots.groupBy("segment", "slot").agg(F.count("*").alias("n")).where("n > 1")
    return crowded.groupBy("segment").agg(F.bitmap_construct_agg("slot").alias("bits"))


def _segment(texts: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(texts * SLOTS_PER_TEXT // SEGMENT + 1))


def _is_set(bits: Column, slot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(slot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), slot.bitwiseAND(7).cast("int") + 1)) > 0


def possible_repeats(rows: DataFrame, segments: DataFrame, texts: int) -> DataFrame:
    """The rows whose text may occur twice; every other row's text is unique."""
    met = rows.withColumn("segment", _segment(texts)).join(segments, "segment")
    for slot in _slots(F.col("hash")):
        met = met.where(_is_set(F.col("bits"), slot))
    return met.drop("segment", "bits")


def duplicates(rows: DataFrame) -> DataFrame:
    """(id, part, mask) of the facts whose whole text a smaller id has too."""
    texts = rows.count()
    segments = materialise(sketch(rows, texts), "audit-sketch")
    possible = materialise(possible_repeats(rows, segments, texts).where("id is not null").select("id", "part", "mask", "digest"), "audit-possible")
    least = possible.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    least = materialise(least.select("digest", "least"), "audit-least")
    return possible.join(least, "digest").where("id > least").select("id", "part", "mask")


def mask_counts(rows: DataFrame, repeated: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic), with the duplicate filter in the mask."""
    one = rows.select("id", "part", "mask", F.lit(1).alias("sign"))
    less = repeated.select("id", "part", "mask", F.lit(-1).alias("sign"))
    more = repeated.select("id", "part", F.col("mask").bitwiseOR(_DUPLICATE).alias("mask"), F.lit(1).alias("sign"))
    signed = one.unionByName(less).unionByName(more)

    def has(column: str) -> Column:
        return F.max(F.when(F.col(column) == 1, 1).otherwise(0))

    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(has("quality").alias("good"), has("toxic").alias("toxic"))
    # Only documents with a label of interest meet the join; rows without an id fall out before it is dealt.
    marked = signed.join(known.where("good + toxic > 0"), "id")
    all_rows = signed.groupBy("part", "mask").agg(F.sum("sign").alias("n"), F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    labelled = marked.groupBy("part", "mask").agg(
        F.lit(0).alias("n"), F.sum(F.col("sign") * F.col("good")).alias("good"), F.sum(F.col("sign") * F.col("toxic")).alias("toxic"))
    return all_rows.unionByName(labelled).groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])


def _steps() -> list[dict]:
    """Every order of the filters, step by step: the filter's bit and the mask of those before it."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            found.append({"filter_order": "".join(order), "step": step, "own": bit, "before": before})
            before |= bit
    return found


def interactions(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step from the counts of each mask.

    ``passing[s]`` counts the documents that fail none of the filters in mask s: a step removes the difference of two of these.
    """
    masks = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # one for each mask

    def total(value, where) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda done, cell: done + F.when(where(cell["mask"]), value(cell)).otherwise(0))

    def passing(name: str) -> Column:
        return F.transform(masks, lambda s: total(lambda cell: cell[name], lambda mask: mask.bitwiseAND(s) == 0)).alias(name)

    # Of the orders in which a document's failing filters stand, each of them comes first equally often.
    each = F.array(*[F.lit(len(list(permutations(FILTERS))) // k) for k in range(1, len(FILTERS) + 1)])
    alone = F.transform(masks, lambda s: total(lambda cell: cell["n"], lambda mask: mask == s))
    shares = F.transform(masks, lambda s: total(
        lambda cell: cell["n"] * F.element_at(each, F.greatest(F.bit_count(cell["mask"]), F.lit(1))), lambda mask: (s > 0) & (mask.bitwiseAND(s) == s)))
    sums = cells.select("part", passing("n"), passing("good"), passing("toxic"), alone.alias("alone"), shares.alias("shares"))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order string, step int, own int, before int>>")
    rows = sums.select("*", F.inline(steps))

    def at(name: str, mask) -> Column:
        return F.col(name)[mask]

    after = F.col("before").bitwiseOR(F.col("own"))
    removed = at("n", F.col("before")) - at("n", after)
    return rows.select(
        "part", "filter_order", "step", at("n", after).alias("kept"), removed.alias("removed"),
        (at("n", F.lit(0)) - at("n", F.col("own")) - removed).alias("redundant"), at("alone", F.col("own")).alias("unique_fails"),
        (at("good", F.col("before")) - at("good", after)).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", after)).alias("toxic_lost"),
        at("shares", F.col("own")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Interactions of the five filters over whole texts, for each part of the documents."""
    rows = materialise(facts(docs, key, text, part), "audit-facts")
    repeated = materialise(duplicates(rows), "audit-duplicates")
    return interactions(materialise(mask_counts(rows, repeated, labels, key), "audit-counts"))
