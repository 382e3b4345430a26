"""Friend recommendations: same channel, never talked, near each other."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.temporal import local_time
from martloom.operators.pairs import close_pairs, exclude_pairs
from martloom.operators.spatial import nearest_centre
from martloom.plans import geo_log
from martloom.plans.profiles import centres, city_timezones, last_position

MAX_KM = 1.0
ZONE_BOX_DEGREES = 0.1
DEFAULT_ZONE = "Australia/Brisbane"


def nearby_pairs(subscriptions: DataFrame, positions: DataFrame, km: float = MAX_KM, carry: tuple[str, ...] = ()) -> DataFrame:
    """Distinct pairs that share a channel and whose last positions lie within ``km``.

    Positions are attached to the subscriptions before any pair exists, so pairs are formed only
    between neighbours and never across a whole channel.
    """
    members = subscriptions.distinct().join(positions, "user_id")
    pairs = close_pairs(members, ["channel_id"], "user_id", km, carry=carry)
    return pairs.withColumnsRenamed({"user_id_left": "user_left", "user_id_right": "user_right"})


def not_yet_talked(pairs: DataFrame, messages: DataFrame) -> DataFrame:
    """Drop pairs with a message in either direction."""
    talked = messages.select(F.col("user_id").alias("user_left"), F.col("message_to").alias("user_right"))
    known = talked.where(F.col("user_left").isNotNull() & F.col("user_right").isNotNull())
    return exclude_pairs(pairs, known, "user_left", "user_right")


def zoned_positions(positions: DataFrame, cities: DataFrame) -> DataFrame:
    """Positions with the zone of the nearest city in a narrow box, null where there is none."""
    return nearest_centre(
        positions, centres(cities), "zone_id", ["timezone"],
        box_degrees=ZONE_BOX_DEGREES, inclusive=False, keep_unmatched=True,
    )


def friend_recommendations(
    events: DataFrame, cities: DataFrame, km: float = MAX_KM, processed_dttm: dt.datetime | None = None,
    default_zone: str = DEFAULT_ZONE, time_as_text: bool = True,
) -> DataFrame:
    """``user_left, user_right, processed_dttm, zone_id, local_time``; zone of the left user, else of
    the right, else the default."""
    log = geo_log.flatten_log(events, geo_log.MESSAGE_TIME_FIRST)
    sent = geo_log.messages(log)
    zones = city_timezones(cities, default=default_zone)
    positions = zoned_positions(last_position(sent), zones)
    pairs = nearby_pairs(geo_log.subscriptions(log), positions, km, carry=("timezone", "location_ts"))
    # Of both sides' columns, only what is shown of a pair goes on.
    zone = F.coalesce("timezone_left", "timezone_right", F.lit(default_zone))
    fresh = not_yet_talked(pairs.select("user_left", "user_right", zone.alias("zone_id"), F.coalesce("location_ts_left", "location_ts_right").alias("_at")), sent)
    now = F.current_timestamp() if processed_dttm is None else F.lit(processed_dttm).cast("timestamp")
    return fresh.select(
        "user_left", "user_right", now.alias("processed_dttm"), "zone_id", local_time(F.col("_at"), F.col("zone_id"), time_as_text).alias("local_time"),
    )
