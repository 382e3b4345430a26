"""Activity by zone, week and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.geo import usable_position
from martloom.operators.aggregates import pivot_counts
from martloom.operators.columns import in_period
from martloom.operators.sets import union_by_name
from martloom.plans import geo_log
from martloom.plans.profiles import assign_city
from martloom.session import materialise

# Event kinds and the names of their counts.
KINDS = {"message": "message", "reaction": "reaction", "subscription": "subscription", "registration": "user"}
DEFAULT_ZONE_ID = 1


def first_and_last(log: DataFrame) -> DataFrame:
    """Per sender: time and position of the first message, and the last known position.

    One pass over the messages serves both the synthetic registrations and the missing positions.
    """
    sent = log.where((F.col("kind") == "message") & F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
    row = F.struct("event_time", "event_id", "lat", "lon")
    ends = sent.groupBy("user_id").agg(
        F.min(row).alias("first"), F.max(F.when(usable_position(F.col("lat"), F.col("lon")), row)).alias("last")
    )
    return ends.select(
        "user_id", F.col("first.event_time").alias("event_time"),
        F.col("first.lat").alias("lat"), F.col("first.lon").alias("lon"),
        F.col("last.lat").alias("last_lat"), F.col("last.lon").alias("last_lon"),
    )


def _position(df: DataFrame) -> DataFrame:
    return df.withColumns({"lat": F.coalesce("lat", "last_lat"), "lon": F.coalesce("lon", "last_lon")})


def _as_registrations(first: DataFrame) -> DataFrame:
    return first.withColumns(
        {
            "kind": F.lit("registration"),
            "event_id": F.xxhash64(F.lit("registration"), "user_id"),
            "date": F.to_date("event_time"),
        }
    )


def registrations(log: DataFrame) -> DataFrame:
    """One synthetic event per sender, at the time and place of the first message of the period."""
    first = first_and_last(log).select("user_id", "event_time", "lat", "lon")
    return _as_registrations(first)


def fill_positions(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Events without a position take their user's last message position.

    Only those events go through the join; the rest pass by without a shuffle.
    """
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    positions = (first_and_last(log) if known is None else known).select("user_id", "last_lat", "last_lon")
    filled = _position(log.where(~placed).join(positions, "user_id", "left")).select(*log.columns)
    return log.where(placed).unionByName(filled)


def zone_activity(placed: DataFrame, year_aware: bool = False) -> DataFrame:
    """``month, week, zone_id`` with four counts of the week and four of the month.

    One shuffle of pre-aggregated rows by (zone, week, month); both totals are then sums over that
    small table. Weeks carry no year unless ``year_aware``, as in the published mart.
    """
    dated = placed.select(
        F.coalesce(F.col("zone_id").cast("int"), F.lit(DEFAULT_ZONE_ID)).alias("zone_id"),
        "kind",
        F.weekofyear("event_time").alias("week"),
        F.extract(F.lit("YEAROFWEEK"), "event_time").alias("week_year"),
        F.date_format("event_time", "yyyy-MM").alias("month"),
    )
    week_key = ["zone_id", "week", *(["week_year"] if year_aware else [])]
    cells = pivot_counts(dated, [*week_key, "month"], "kind", {k: f"n_{k}" for k in KINDS})
    by_week, by_month = Window.partitionBy(*week_key), Window.partitionBy("zone_id", "month")
    return cells.select(
        "month", *week_key[2:], "week", "zone_id",
        *[F.sum(f"n_{k}").over(by_week).alias(f"week_{n}") for k, n in KINDS.items()],
        *[F.sum(f"n_{k}").over(by_month).alias(f"month_{n}") for k, n in KINDS.items()],
    )


def user_activity_zones(
    events: DataFrame, cities: DataFrame, date_from: str, date_to: str, year_aware: bool = False
) -> DataFrame:
    """The zone mart of a half-open period, registrations included."""
    log = in_period(geo_log.flatten_log(events, geo_log.DATETIME_FIRST), "event_time", date_from, date_to)
    ends = materialise(first_and_last(log), "ends")
    everything = union_by_name(fill_positions(log, ends), _as_registrations(_position(ends)))
    return zone_activity(assign_city(everything, cities, ["zone_id"]), year_aware)
