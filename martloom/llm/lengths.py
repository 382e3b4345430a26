"""Token counts from an exact histogram of encoded lengths.

Documents are counted by their encoded length once; suffix sums over the histogram then answer, for every
context limit, how many documents reach it, how many tokens they hold, and what is left after truncation.
Lengths are summed in ranges first, so no task holds more than one range of lengths and the only ordered
pass over everything is over one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm import bpe
from martloom.session import materialise

#: Lengths in one range of the two-level suffix sums.
RANGE = 128


def histogram(counts: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(length, docs): null lengths count as 0."""
    rows = counts.select(F.coalesce(F.col(length), F.lit(0)).cast("long").alias("length"))
    return rows.groupBy("length").agg(F.count("*").alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row per length that occurs: docs and tokens of it, of all documents at least and at most as long, the
    tokens left when every document is cut at this length, and the share of documents not longer."""
    cells = hist.withColumn("part", F.floor(F.col("length") / RANGE)).withColumn("tokens", F.col("length") * F.col("docs"))
    parts = cells.groupBy("part").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"),
    )
    down = Window.partitionBy("part").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cells.join(parts, "part")
    docs_from = F.sum("docs").over(down) + F.col("d_after")
    tokens_from = F.sum("tokens").over(down) + F.col("t_after")
    out = joined.select("length", "docs", "tokens", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "d_all", "t_all")
    return out.select(
        "length", "docs", "tokens", "docs_from", "tokens_from",
        (F.col("d_all") - F.col("docs_from") + F.col("docs")).alias("docs_to"),
        (F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_from") + F.col("docs")) / F.col("d_all")).alias("share_to"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens) for any limits, also those that no document has as its length."""
    sums_of = []
    for i, limit in enumerate(map(int, limits)):
        sums_of.append(F.sum(F.when(F.col("length") > limit, F.col("docs")).otherwise(0)).alias(f"d{i}"))
        sums_of.append(F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("docs")).alias(f"t{i}"))
    answers = F.array(*[
        F.struct(F.lit(int(x)).cast("long").alias("context_limit"), F.coalesce(F.col(f"d{i}"), F.lit(0)).alias("docs_over"),
                 F.coalesce(F.col(f"t{i}"), F.lit(0)).alias("truncated_tokens"))
        for i, x in enumerate(limits)
    ])
    return sums.agg(*sums_of).select(F.explode(answers).alias("x")).select("x.*")


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of the documents does not exceed."""
    picked = [F.min(F.when(F.col("share_to") >= float(q), F.col("length"))).alias(f"q{i}") for i, q in enumerate(shares)]
    pairs = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length")) for i, q in enumerate(shares)]))
    return sums.agg(*picked).select(pairs.alias("x")).select("x.share", "x.length")


def token_lengths(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Histogram with suffix sums of the encoded lengths of whole texts; null text has length 0, no rows give none."""
    # One row for each length: written once, as the sums read it twice and the encoding is the cost.
    return suffix_sums(materialise(histogram(bpe.token_counts(docs, path, key, text)), "token-lengths"))
