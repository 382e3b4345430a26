"""Ranking and running operators.

``row_number() = 1`` plans as WindowGroupLimit: every map task keeps one row per key before
the shuffle, so a key that holds a third of the rows does not travel whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialise


def _columns(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order; name a tie-break last."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_columns(order_by)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def nearest_per_key(df: DataFrame, keys: Sequence[str], distance: str, tie: str) -> DataFrame:
    return first_per_key(df, keys, [distance, tie])


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(ts).desc(), F.col(tie).desc()])


def best_per_key(df: DataFrame, keys: Sequence[str], metric: str, tie: str) -> DataFrame:
    return first_per_key(df, keys, [F.col(metric).desc(), F.col(tie)])


def running_count(df: DataFrame, keys: Sequence[str], order_by: str, name: str) -> DataFrame:
    """How many rows of the key come up to this one. Feed it de-duplicated rows of bounded groups (days)."""
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys).orderBy(order_by)))


def numbered_steps(df: DataFrame, keys: Sequence[str], ts: str, tie: str, name: str, ranges: int | None = None) -> DataFrame:
    """Position of every row within its key in time order, without sorting a whole key in one task.

    Rows are dealt by sampled bounds of (key, time, tie) into ranges of like size, whatever the keys hold, and written. Each
    range is numbered by itself; the counts of (key, range), one small row each, give the offset of a key's later ranges.
    A key with most of the rows, even at one hour, spreads over ranges.
    """
    order = [*keys, ts, tie]
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    dealt = materialise(dealt.withColumn("_range", F.spark_partition_id()), "steps")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    offsets = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_range") == F.col("_r")]
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(ts, tie)))
    return ranked.join(offsets, same).select(*df.columns, (F.col("_rank") + F.col("_offset")).alias(name))


def changes(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, slice_by: str = "hour") -> DataFrame:
    """The rows whose ``value`` differs from that of the row before in their key; the first row of a key is one of them.

    Neighbours are compared inside (key, time slice); the first row of a slice is compared with the last value of the slice
    before, of which there is one small row for each slice. A hot key is sorted slice by slice, in parallel.
    """
    sliced = df.withColumn("_slice", F.date_trunc(slice_by, F.col(ts)))
    within = Window.partitionBy(*keys, "_slice").orderBy(ts, tie)
    ends = sliced.groupBy(*keys, "_slice").agg(F.max_by(value, F.struct(ts, tie)).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice")
    ends = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"), F.lag("_end").over(earlier).alias("_end"), F.row_number().over(earlier).alias("_nth"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_slice").eqNullSafe(F.col("_s"))]
    numbered = sliced.withColumns({"_before": F.lag(value).over(within), "_at": F.row_number().over(within)})
    joined = numbered.join(ends, same)
    first = F.col("_at") == 1
    differs = ~F.col(value).eqNullSafe(F.when(first, F.col("_end")).otherwise(F.col("_before")))
    return joined.where(differs | (first & (F.col("_nth") == 1))).select(*df.columns)


def top_n(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows; plans as TakeOrderedAndProject, which keeps ``n`` rows per task."""
    return df.orderBy(*_columns(order_by)).limit(n)


def oldest_n(df: DataFrame, ts: str, tie: str, n: int = 10) -> DataFrame:
    return top_n(df, [ts, tie], n)


def lowest_n(df: DataFrame, metric: str, tie: str, n: int = 10) -> DataFrame:
    return top_n(df, [metric, tie], n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)
