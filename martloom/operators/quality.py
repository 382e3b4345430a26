"""Constraints as audits, since files enforce none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.lookups import absent


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``violations``: the names of the rules a row breaks (a rule that yields null is broken only
    by an explicit null test, as in a SQL CHECK)."""
    failed = F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("violations", F.filter(failed, lambda v: v.isNotNull()))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the audit column, rejected rows with it)."""
    broken = F.size("violations") > 0
    return checked.where(~broken).drop("violations"), checked.where(broken)


def orphans(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose foreign key is set but not found in the parent."""
    referenced = df
    for column in on:
        referenced = referenced.where(F.col(column).isNotNull())
    return absent(referenced, parent, on)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fail before any work when a column, or a nested ``struct.field``, is missing."""
    missing = []
    for name in names:
        fields = df.schema
        for part in name.split("."):
            if not hasattr(fields, "names") or part not in fields.names:
                missing.append(name)
                break
            fields = fields[part].dataType
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
