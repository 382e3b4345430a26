"""Group aggregates. All combine on the map side, so a hot key reaches its reducer as one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, keys: Sequence[str], kind: str, labels: Mapping[str, str]) -> DataFrame:
    """One row per key with a count per label: ``{"message": "week_message"}``."""
    return df.groupBy(*keys).agg(*[F.count_if(F.col(kind) == label).alias(name) for label, name in labels.items()])


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str, approximate: bool = False) -> DataFrame:
    """Distinct values per key. The exact form de-duplicates on (key, value) first, which spreads a hot key."""
    if approximate:
        return df.groupBy(*keys).agg(F.approx_count_distinct(column).alias(name))
    return df.groupBy(*keys).agg(F.count_distinct(F.col(column)).alias(name))


def sum_avg(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    averages: Mapping[str, str],
    sum_type: str = "decimal(19,5)",
    average_type: str = "decimal(4,2)",
) -> DataFrame:
    """Sums and averages cast to their declared scales."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).cast(sum_type).alias(n) for c, n in sums.items()],
        *[F.avg(c).cast(average_type).alias(n) for c, n in averages.items()],
    )


def first_seen(df: DataFrame, key: str, ts: str, lat: str, lon: str) -> DataFrame:
    """Earliest time per key and the position held at that time; the lower position among equal times."""
    at = F.when(F.col(ts).isNotNull(), F.struct(ts, lat, lon))
    return df.groupBy(key).agg(F.min(at).alias("at")).select(key, *[F.col("at")[c].alias(c) for c in (ts, lat, lon)])


def max_by_group(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias(column))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
