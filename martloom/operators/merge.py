"""Keyed merges of a batch into a target, as plans over two DataFrames.

Targets hold each key once. A batch may hold a key many times: it is reduced to one row per
key first (on the map side), so a hot key in the batch never meets the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.windows import first_per_key

_TARGET, _SOURCE = "_t", "_s"


def newest(source: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None) -> DataFrame:
    """Last row per key; without an order the batch is taken to hold each key once."""
    if not order_by:
        return source
    return first_per_key(source, keys, [F.col(c).desc_nulls_last() for c in order_by])


def _full_join(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides of every key as structs ``_t`` and ``_s`` (null where a side is missing)."""
    t = target.select(*keys, F.struct(*target.columns).alias(_TARGET))
    s = source.select(*keys, F.struct(*source.columns).alias(_SOURCE))
    return t.join(s, list(keys), "full_outer")


def _merged(
    target: DataFrame, source: DataFrame, keys: Sequence[str], updated: Sequence[str], when: Column
) -> DataFrame:
    joined = _full_join(target, source, keys)
    new = F.col(_TARGET).isNull()
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        old = F.col(f"{_TARGET}.{name}")
        fresh = F.col(f"{_SOURCE}.{name}") if name in source.columns else F.lit(None)
        take = (new | when) if name in updated else new
        columns.append(F.when(take, fresh).otherwise(old).alias(name))
    return joined.select(*columns)


def _non_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def merge_overwrite(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Insert or update by key; the last row of the batch wins; columns not listed keep the old value."""
    updated = list(update_cols) if update_cols is not None else _non_keys(source, keys)
    return _merged(target, newest(source, keys, order_by), keys, updated, F.col(_SOURCE).isNotNull())


def merge_if_changed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """As ``merge_overwrite``, but a row whose compared columns are the same stays untouched."""
    same = reduce(
        lambda a, b: a & b, [F.col(f"{_TARGET}.{c}").eqNullSafe(F.col(f"{_SOURCE}.{c}")) for c in compare]
    )
    changed = F.col(_SOURCE).isNotNull() & ~same
    return _merged(target, newest(source, keys, order_by), keys, _non_keys(source, keys), changed)


def new_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Rows of the batch whose key the target lacks; the first per key wins.

    The target's keys are first cut down to those of the batch. With a batch small enough to be
    broadcast this scans only the key column of the target and shuffles none of it.
    """
    first = first_per_key(source, keys, order_by) if order_by else source.dropDuplicates(list(keys))
    known = target.select(*keys).join(first.select(*keys), list(keys), "left_semi")
    return first.join(known, list(keys), "left_anti")


def insert_new(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """The target and the rows whose key it lacked."""
    return target.unionByName(new_rows(target, source, keys, order_by))


def batch_totals(
    source: DataFrame, keys: Sequence[str], sum_cols: Sequence[str], latest_cols: Sequence[str], order_by: str | None
) -> DataFrame:
    """One row per key: the sums, and the latest of the descriptive columns."""
    latest = [
        (F.max_by(c, order_by) if order_by else F.max(c)).alias(c) for c in latest_cols
    ]
    return source.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sum_cols], *latest)


def merge_add(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    sum_cols: Sequence[str],
    latest_cols: Sequence[str] = (),
    order_by: str | None = None,
) -> DataFrame:
    """Additive upsert: sums grow by the batch, descriptive columns take its latest value."""
    joined = _full_join(target, batch_totals(source, keys, sum_cols, latest_cols, order_by), keys)
    columns = []
    for name in target.columns:
        old, fresh = F.col(f"{_TARGET}.{name}"), F.col(f"{_SOURCE}.{name}") if name not in keys else None
        if name in keys:
            columns.append(F.col(name))
        elif name in sum_cols:
            columns.append((F.coalesce(old, F.lit(0)) + F.coalesce(fresh, F.lit(0))).alias(name))
        elif name in latest_cols:
            columns.append(F.coalesce(fresh, old).alias(name))
        else:
            columns.append(old.alias(name))
    return joined.select(*columns)
