"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is WINDOW words of an item in a row; a shorter item is one window. Fingerprints are hashes of GRAM words; of the
GRAM hashes in each run of WINDOW - GRAM + 1 the least is kept, so any shared run of WINDOW words or more shares a kept
hash. Texts that share a fingerprint with the benchmark are suspects; their windows are then compared with the
items' as strings, and hits are extended to the words they cover. Items of fewer words than the window are found by
the hash of their whole length. Fingerprints are of texts, not of documents, so copies meet the benchmark once.

Null texts and items have no words. Rows of a repeated id stay separate rows. An item without an id is one whose id is empty
text: its windows hit like any other's.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import materialise

#: Words in a window, and words in a hashed gram.
WINDOW, GRAM = 13, 6
#: A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Words of a text column: ASCII letters in lower case, runs of letters, digits and all beyond ASCII."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, _GAP), "")


def _runs(array: str, width: int, value) -> Column:
    """``value`` of each run of ``width`` elements; empty where the array is shorter."""
    n = F.size(array)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: value(F.slice(array, i, width)))).otherwise(
        F.array().cast("array<bigint>"))


def fingerprints(df: DataFrame, gram: int, window: int, out: str = "fingerprint") -> DataFrame:
    """Winnowed fingerprints of the ``words`` of each row: the least gram hash of every window, one row for each distinct."""
    hashed = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    grams = hashed.withColumn("grams", _runs("hashes", gram, lambda s: F.xxhash64(s))).drop("hashes", "words")
    least = grams if window == gram else grams.withColumn("grams", _runs("grams", window - gram + 1, F.array_min))
    return least.withColumn(out, F.explode(F.array_distinct("grams"))).drop("grams")


def _windows(df: DataFrame, width: int) -> DataFrame:
    """Every run of ``width`` words as a string, with its place."""
    n = F.size("words")
    runs = F.when(n >= width, F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: F.array_join(F.slice("words", i, width), " ")))
    return df.select("*", F.posexplode(runs).alias("place", "window")).drop("words")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, n_words, n_hit, n_items, items, contaminated): one row per document.

    ``n_hit`` counts the words inside any occurrence of an item's window; ``items`` are the ids, sorted as strings.
    """
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("t1"), F.hash(F.col(text)).alias("t2"))
    split = texts.select("key", "t1", "t2", words("text").alias("words"))
    items = materialise(benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words(item_text).alias("words")).where(F.size("words") > 0), "benchmark-words")
    short = [r[0] for r in items.where(F.size("words") < window).select(F.size("words")).distinct().collect()]  # fewer than ``window`` values
    found = None
    for width in [*sorted(short), window]:
        own = items.where(F.size("words") >= window if width == window else F.size("words") == width)
        k = gram if width == window else width
        marks = materialise(fingerprints(own.select("words"), k, width).distinct(), "benchmark-fingerprints")
        met = fingerprints(split.select("t1", "t2", "words"), k, width).join(marks, "fingerprint")
        # Written, so that its size is known before the join below is planned: texts are only dealt out where it is large.
        suspects = materialise(met.select("t1", "t2").distinct(), "benchmark-suspects")
        targets = materialise(_windows(own, width).select("window", "item").distinct(), "benchmark-windows")
        # One of all copies of a text.
        some = texts.join(suspects, ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(F.first("text").alias("text")).select("t1", "t2", words("text").alias("words"))
        hits = _windows(some, width).join(targets, "window").select("t1", "t2", "place", F.lit(width).alias("width"), "item")
        found = hits if found is None else found.unionByName(hits)
    hit = found.groupBy("t1", "t2").agg(F.collect_set(F.struct("place", "width")).alias("spans"), F.collect_set("item").alias("items"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def cover(done: Column, span: Column) -> Column:
        end = span["place"] + span["width"]
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["n"] + F.greatest(F.lit(0), end - F.greatest(done["end"], span["place"]))).alias("n"))

    hit = hit.select("t1", "t2", F.aggregate(F.array_sort("spans"), start, cover)["n"].alias("hit"), F.array_sort("items").alias("items"))
    sizes = split.select("key", "t1", "t2", F.size("words").cast("long").alias("n_words"))
    out = sizes.join(hit, ["t1", "t2"], "left").withColumn("n_hit", F.coalesce("hit", F.lit(0)).cast("long"))
    return out.select(
        F.col("key").alias(key), "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def digests(result: DataFrame, key: str = "doc_id") -> DataFrame:
    """The result with the items as a digest of their comma-joined ids."""
    return result.select(key, "n_words", "n_hit", F.when(F.col("n_items") > 0, F.col("n_items")).otherwise(0).cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
