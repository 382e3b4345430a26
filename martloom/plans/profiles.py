"""User profiles: active city, home city, travels, local time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.geo import km_to_degrees
from martloom.functions.temporal import city_zone, local_time
from martloom.operators.spatial import nearest_centre
from martloom.operators.windows import first_per_key, latest_per_key, numbered_steps
from martloom.plans import geo_log

HOME_MIN_DAYS = 27
CITY_BOX_KM = 100.0


def city_timezones(
    cities: DataFrame, region: str = "Australia", default: str = "Australia/Sydney", city: str = "city"
) -> DataFrame:
    """Cities with their time zone, ``default`` where no zone bears the city's name."""
    return cities.withColumn("timezone", city_zone(F.col(city), region, default))


def centres(cities: DataFrame) -> DataFrame:
    return cities.withColumnsRenamed({"lat": "c_lat", "lon": "c_lon", "id": "zone_id"})


def assign_city(
    events: DataFrame, cities: DataFrame, payload: list[str], max_km: float | None = None,
    distance: str | None = None, keep_unmatched: bool = False, **options,
) -> DataFrame:
    """Nearest city per event; with ``max_km`` only cities inside a degree box of that size count."""
    box = None if max_km is None else km_to_degrees(max_km)
    return nearest_centre(
        events, centres(cities), "zone_id", payload, box_degrees=box,
        distance=distance, keep_unmatched=keep_unmatched, **options,
    )


def last_position(messages: DataFrame) -> DataFrame:
    """Where and when each user wrote last."""
    latest = latest_per_key(messages.select("user_id", "event_id", "event_time", "lat", "lon"), ["user_id"], "event_time", "event_id")
    return latest.select("user_id", "lat", "lon", F.col("event_time").alias("location_ts"))


def city_visits(placed: DataFrame) -> DataFrame:
    """One row per (user, city): distinct days, first and last time, visits, zone.

    Two partial aggregations: the first shuffle carries at most one row per user, city and day from
    each task, the second one row per user and city. Everything in a profile follows from it.
    """
    days = placed.groupBy("user_id", "city", "timezone", "date").agg(
        F.min("event_time").alias("first_ts"), F.max("event_time").alias("last_ts"), F.count("*").alias("n")
    )
    return days.groupBy("user_id", "city", "timezone").agg(
        F.count("*").alias("days"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.sum("n").alias("visits"),
    )


def home_city(visits: DataFrame, min_days: int = HOME_MIN_DAYS) -> DataFrame:
    """The city with the most distinct days, if they reach ``min_days``; ties by name."""
    enough = visits.where(F.col("days") >= min_days)
    best = first_per_key(enough, ["user_id"], [F.col("days").desc(), F.col("city")])
    return best.select("user_id", F.col("city").alias("home_city"))


def _itinerary():
    """Cities by first visit. One entry per city, so its length is bounded by the city list."""
    ordered = F.array_sort(F.collect_list(F.struct("first_ts", "city")))
    return F.transform(ordered, lambda stop: stop["city"])


def travel_history(visits: DataFrame) -> DataFrame:
    """``travel_count`` distinct cities and ``travel_array``, those cities in the order first visited."""
    return visits.groupBy("user_id").agg(
        F.count("*").alias("travel_count"), _itinerary().alias("travel_array")
    )


def travel_steps(placed: DataFrame) -> DataFrame:
    """The whole sequence of a user's cities, one row per message: ``user_id, step, city, event_time``.

    The unabridged itinerary has no bound, so it is kept as rows and not as one array.
    """
    rows = placed.select("user_id", "event_id", "event_time", "city")
    return numbered_steps(rows, ["user_id"], "event_time", "event_id", "step").select("user_id", "step", "city", "event_time")


def profiles_of(visits: DataFrame, min_days: int = HOME_MIN_DAYS, time_as_text: bool = False) -> DataFrame:
    """Profiles from city visits in one aggregation per user, with no join."""
    last = F.max(F.struct("last_ts", "city", "timezone"))
    # Most days first, then the name: ranks grow, so the minimum of (-days, city) is the best.
    home = F.min(F.when(F.col("days") >= min_days, F.struct((-F.col("days")).alias("rank"), F.col("city").alias("city"))))
    users = visits.groupBy("user_id").agg(
        last.alias("last"), home.alias("home"), F.count("*").alias("travel_count"), _itinerary().alias("travel_array")
    )
    return users.select(
        "user_id",
        F.col("last.city").alias("act_city"),
        F.coalesce("home.city", "last.city").alias("home_city"),
        "travel_count",
        "travel_array",
        local_time(F.col("last.last_ts"), F.col("last.timezone"), time_as_text).alias("local_time"),
    )


def place_messages(log: DataFrame, cities: DataFrame, max_km: float = CITY_BOX_KM, **options) -> DataFrame:
    """Messages with the city they were written in; those far from every city are left out."""
    return assign_city(geo_log.messages(log), cities, ["city", "timezone"], max_km, **options)


def user_profiles(
    events: DataFrame, cities: DataFrame, min_days: int = HOME_MIN_DAYS, max_km: float = CITY_BOX_KM,
    default_zone: str = "Australia/Sydney", time_as_text: bool = False,
) -> DataFrame:
    """``user_id, act_city, home_city, travel_count, travel_array, local_time``."""
    log = geo_log.flatten_log(events, geo_log.MESSAGE_TIME_FIRST)
    placed = place_messages(log, city_timezones(cities, default=default_zone), max_km)
    return profiles_of(city_visits(placed), min_days, time_as_text)
