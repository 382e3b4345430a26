"""Stable dense integer ids for business keys, without a global window over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def surrogate_key(
    df: DataFrame,
    business_key: str,
    existing: DataFrame | None = None,
    id_col: str = "id",
    digits: int = 3,
) -> DataFrame:
    """(id, business key) for every key: known keys keep their id, new ones follow the highest.

    New keys are dealt into ``16**digits`` slices by the first hex digits of their sha-256 and
    numbered within each slice in parallel. Only the slice sizes, at most ``16**digits`` rows,
    pass through a single task to become offsets.
    """
    keys = df.select(business_key).where(F.col(business_key).isNotNull()).distinct()
    known, start = None, 0
    if existing is not None:
        known = existing.select(id_col, business_key)
        keys = keys.join(known, business_key, "left_anti")
        start = known.agg(F.max(id_col)).first()[0] or 0
    sliced = keys.withColumn("_slice", F.substring(F.sha2(F.col(business_key).cast("string"), 256), 1, digits))
    sizes = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(business_key))
    # At most 16**digits rows, so the broadcast is bounded by the argument.
    numbered = sliced.withColumn("_rank", within).join(F.broadcast(offsets), "_slice")
    fresh = numbered.select((F.col("_rank") + F.col("_offset")).cast("long").alias(id_col), business_key)
    return fresh if known is None else known.unionByName(fresh)
