"""The nested event log as flat, typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.temporal import parse_time
from martloom.operators.columns import valid_messages, valid_subscriptions
from martloom.operators.quality import require_columns

MESSAGE_TIME_FIRST = ("message_ts", "datetime")
DATETIME_FIRST = ("datetime", "message_ts")


def actor(event: str = "event") -> Column:
    """Who did it: sender, reactor, subscriber, or the plain user, as a number."""
    names = ("message_from", "reaction_from", "subscription_user", "user")
    return F.coalesce(*[F.col(f"{event}.{n}").try_cast("long") for n in names])


def flatten_log(events: DataFrame, time_order: tuple[str, ...] = MESSAGE_TIME_FIRST) -> DataFrame:
    """``event_id, kind, user_id, message_to, channel_id, lat, lon, event_time, date``.

    Without an ``event_id`` column the id is a hash of the row, so that two events of one user in the
    same instant stay two events.
    """
    require_columns(events, ["event_type", "lat", "lon", "event.message_from", "event.message_ts"])
    if "event_id" in events.columns:
        row_id = F.col("event_id")
    else:
        row_id = F.xxhash64(*[c for c in events.columns])
    return events.select(
        row_id.alias("event_id"),
        F.col("event_type").alias("kind"),
        actor().alias("user_id"),
        F.col("event.message_to").alias("message_to"),
        F.col("event.subscription_channel").alias("channel_id"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        parse_time(*[F.col(f"event.{n}") for n in time_order]).alias("event_time"),
    ).withColumn("date", F.to_date("event_time"))


def messages(log: DataFrame) -> DataFrame:
    """Messages that can be placed: sender, time and position present."""
    return valid_messages(log, "kind", "lat", "lon", ["user_id", "event_time"])


def subscriptions(log: DataFrame) -> DataFrame:
    return valid_subscriptions(log, "kind", "channel_id", "user_id")
