"""Projections and filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.geo import usable_position
from martloom.functions.temporal import OPEN_END, parse_time, previous_month


def flatten(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select nested fields under new names: ``{"event.message_from": "user_id"}``."""
    return df.select(*[F.col(path).alias(name) for path, name in mapping.items()])


def with_event_time(df: DataFrame, sources: Sequence[str], ts: str = "event_time", date: str = "date") -> DataFrame:
    """Add the event time, taken from the first of the text columns that parses, and its date."""
    timed = df.withColumn(ts, parse_time(*[F.col(s) for s in sources]))
    return timed.withColumn(date, F.to_date(ts))


def valid_messages(df: DataFrame, kind: str, lat: str, lon: str, required: Sequence[str], label: str = "message") -> DataFrame:
    """Messages with a usable position and every required column present."""
    keep = (F.col(kind) == label) & usable_position(F.col(lat), F.col(lon))
    for name in required:
        keep = keep & F.col(name).isNotNull()
    return df.where(keep)


def valid_subscriptions(df: DataFrame, kind: str, channel: str, user: str, label: str = "subscription") -> DataFrame:
    """(channel, user) rows of subscription events that carry both."""
    rows = df.where((F.col(kind) == label) & F.col(channel).isNotNull() & F.col(user).isNotNull())
    return rows.select(F.col(channel).alias("channel_id"), F.col(user).cast("long").alias("user_id"))


def in_period(df: DataFrame, ts: str, start: str | dt.datetime, end: str | dt.datetime) -> DataFrame:
    """Half-open period ``[start, end)``."""
    at = F.col(ts)
    return df.where((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp")))


def between_dates(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Closed date range; on a partition column this prunes folders."""
    return df.where(F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def pad_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; those ``df`` lacks become typed nulls."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def in_previous_month(df: DataFrame, year: str, month: str, today: dt.date | None = None) -> DataFrame:
    """Rows of the calendar month before ``today``; January looks back to December."""
    y, m = previous_month(today)
    return df.where((F.col(year) == y) & (F.col(month) == m))


def active_now(df: DataFrame, start: str, end: str, now: int | Column | None = None) -> DataFrame:
    """Rows whose closed epoch-second interval holds ``now``.

    Left out, ``now`` is the clock of each batch or micro-batch, not of the program start.
    """
    moment = F.unix_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
    return df.where((F.col(start) <= moment) & (F.col(end) >= moment))


def with_status(df: DataFrame, status: str, value: str = "CLOSED") -> DataFrame:
    return df.where(F.col(status) == value)


def messages_with_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    return df.where(F.col(payload).isNotNull())


def inviter_on_add(event: Column, inviter: Column, label: str = "add") -> Column:
    """The inviting user, kept for join events only."""
    return F.when(event == label, inviter)


def rename_drop(df: DataFrame, renames: Mapping[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(dict(renames or {})).drop(*drop)


def stamp(df: DataFrame, load_src: str, load_dt: dt.datetime | None = None) -> DataFrame:
    """Add the load time and the name of the source system."""
    at = F.current_timestamp() if load_dt is None else F.lit(load_dt).cast("timestamp")
    return df.withColumns({"load_dt": at, "load_src": F.lit(load_src)})


def with_validity(df: DataFrame, active_from: str) -> DataFrame:
    """Validity interval that is still open."""
    return df.withColumns({"active_from": F.col(active_from), "active_to": F.lit(OPEN_END).cast("timestamp")})
