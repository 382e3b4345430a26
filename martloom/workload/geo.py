"""Geo and social-graph queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.functions.geo import haversine_km, km_to_degrees
from martloom.functions.temporal import local_time
from martloom.operators.spatial import box_join, nearest_centre
from martloom.operators.windows import numbered_steps, running_count
from martloom.plans import geo_log, pipelines, profiles, recommendations, zones
from martloom.session import work_dir
from martloom.sources.files import land_events
from martloom.workload import adapters as a

MIN_DAYS = 2
PAIR_KM = 200.0
_DEGREES = km_to_degrees(profiles.CITY_BOX_KM)


def _log(spark, sf, all_messages=False):
    return geo_log.flatten_log(a.geo_log(spark, sf, all_messages))


def _placed(spark, sf):
    """Every event as a message, with its boxed nearest city."""
    return profiles.place_messages(_log(spark, sf, True), profiles.city_timezones(a.cities(spark, sf)))


def haversine_pairs(spark, sf):
    """Distance of every event from the city with its id modulo 25."""
    cities = a.cities(spark, sf).select(F.col("id"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))
    log = _log(spark, sf).where(F.col("lat").isNotNull())
    joined = log.join(cities, F.col("event_id") % 25 == F.col("id"))
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    return joined.select("event_id", F.col("id").cast("long").alias("city_id"), F.round(km, 3).alias("km"))


def box_pairs(spark, sf):
    joined = box_join(_log(spark, sf), profiles.centres(a.cities(spark, sf)), _DEGREES)
    return joined.select("event_id", F.col("zone_id").cast("long").alias("city_id"))


def _nearest(spark, sf, max_km):
    placed = profiles.assign_city(_log(spark, sf), a.cities(spark, sf), ["zone_id"], max_km, distance="km")
    return placed.select("event_id", F.col("zone_id").cast("long").alias("city_id"), F.round("km", 3).alias("km"))


def nearest_city(spark, sf):
    return _nearest(spark, sf, None)


def nearest_city_in_box(spark, sf):
    return _nearest(spark, sf, profiles.CITY_BOX_KM)


def nearest_city_many_centres(spark, sf):
    """Nearest of all customers' places, half of them in one town and the others over the whole sphere; found down the tree of cells."""
    key = F.col("c_custkey")
    town = key % 2 == 0
    centres = a.table(spark, sf, "customer").select(
        key.alias("customer"),
        F.when(town, F.lit(-33.8) + key % 997 / F.lit(10007.0)).otherwise(F.lit(-88.0) + key * 37 % 1759 / F.lit(10.0)).alias("c_lat"),
        F.when(town, F.lit(151.2) + key % 991 / F.lit(10009.0)).otherwise(F.lit(-179.0) + key * 53 % 3581 / F.lit(10.0)).alias("c_lon"))
    placed = nearest_centre(_log(spark, sf), centres, "customer", ["customer"], distance="km", list_limit=100)
    return placed.select("event_id", F.col("customer").cast("long").alias("customer"), F.round("km", 3).alias("km"))


def local_times(spark, sf):
    cities = profiles.city_timezones(a.cities(spark, sf)).select("id", "timezone")
    joined = _log(spark, sf).join(cities, F.col("event_id") % 25 == F.col("id"))
    return joined.select("event_id", "timezone", local_time(F.col("event_time"), F.col("timezone"), True).alias("local_time"))


def last_position(spark, sf):
    last = profiles.last_position(geo_log.messages(_log(spark, sf)))
    return last.select("user_id", "lat", "lon", F.date_format("location_ts", "yyyy-MM-dd HH:mm:ss").alias("location_ts"))


def running_day_count(spark, sf):
    """n-th distinct day of a user in a city."""
    days = _placed(spark, sf).select("user_id", "city", "date").distinct()
    counted = running_count(days, ["user_id", "city"], "date", "days_in_city")
    return counted.select("user_id", "city", F.date_format("date", "yyyy-MM-dd").alias("day"), "days_in_city")


def home_city(spark, sf):
    return profiles.home_city(profiles.city_visits(_placed(spark, sf)), MIN_DAYS)


def travel_history(spark, sf):
    history = profiles.travel_history(profiles.city_visits(_placed(spark, sf)))
    return history.withColumn("travel_array", F.array_join("travel_array", " > "))


def travel_steps(spark, sf):
    return profiles.travel_steps(_placed(spark, sf)).select("user_id", F.col("step").cast("long").alias("step"), "city")


def travel_steps_hot(spark, sf):
    """Every event numbered, with half of them moved to one user and one hour."""
    hot = F.col("event_id") % 2 == 0
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") % 3600)
    events = a.table(spark, sf, "events").select(
        F.when(hot, 7).otherwise(F.col("user_id")).cast("long").alias("user_id"), "event_id", F.when(hot, at).otherwise(F.col("ts").cast("timestamp")).alias("at"))
    return numbered_steps(events, ["user_id"], "at", "event_id", "step", ranges=16).select("user_id", "event_id", "step")


def zone_run_files(spark, sf):
    """The zone mart of a run over files: day folders of which some events are weeks older, landed with their time ranges."""
    base = work_dir(spark, "zone-run")
    log = a.geo_log(spark, sf).drop("event_id")
    late = F.when(F.xxhash64("event") % 10 == 0, F.date_add("date", 45)).otherwise(F.col("date"))
    land_events(log.withColumn("date", late), f"{base}/events")
    a.cities(spark, sf).write.option("header", True).csv(f"{base}/cities")
    run = pipelines.GeoRun(f"{base}/events", f"{base}/cities", f"{base}/marts", "2024-01-03", "2024-01-28")
    pipelines.run_geo_marts(spark, run, ("zones",))
    mart = spark.read.parquet(f"{base}/marts/user_activity_zones")
    return mart.select("month", F.col("week").cast("long").alias("week"), F.col("zone_id").cast("long").alias("zone_id"), *mart.columns[3:])


#: Days of the profile run over files.
_PROFILE_DAYS = ("2024-01-05", "2024-01-24")


def profile_run_files(spark, sf):
    """The profile mart of a run over day folders and a CSV of cities, by its own defaults."""
    base = work_dir(spark, "profile-run")
    land_events(a.geo_log(spark, sf, True).drop("event_id"), f"{base}/events")
    a.cities(spark, sf).write.option("header", True).csv(f"{base}/cities")
    pipelines.run_geo_marts(spark, pipelines.GeoRun(f"{base}/events", f"{base}/cities", f"{base}/marts", *_PROFILE_DAYS), ("profiles",))
    mart = spark.read.parquet(f"{base}/marts/user_profiles")
    return mart.withColumns({"travel_array": F.array_join("travel_array", " > "), "local_time": F.date_format("local_time", "yyyy-MM-dd HH:mm:ss")})


def user_profiles(spark, sf):
    mart = profiles.user_profiles(a.geo_log(spark, sf, True), a.cities(spark, sf), MIN_DAYS, time_as_text=True)
    return mart.withColumn("travel_array", F.array_join("travel_array", " > "))


def registrations(spark, sf):
    first = zones.registrations(_log(spark, sf))
    return first.select("user_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("registered"), "lat", "lon")


def fill_positions(spark, sf):
    return zones.fill_positions(_log(spark, sf)).select("event_id", "kind", "lat", "lon")


def zone_activity(spark, sf):
    mart = zones.user_activity_zones(a.geo_log(spark, sf), a.cities(spark, sf), "2024-01-03", "2024-01-28")
    return mart.select("month", F.col("week").cast("long").alias("week"), F.col("zone_id").cast("long").alias("zone_id"), *mart.columns[3:])


def _pairs(spark, sf):
    log = _log(spark, sf)
    positions = profiles.last_position(geo_log.messages(log))
    return log, recommendations.nearby_pairs(geo_log.subscriptions(log), positions, PAIR_KM)


def nearby_pairs(spark, sf):
    return _pairs(spark, sf)[1].select("user_left", "user_right")


def not_yet_talked(spark, sf):
    log, pairs = _pairs(spark, sf)
    return recommendations.not_yet_talked(pairs, geo_log.messages(log)).select("user_left", "user_right")


def friend_recommendations(spark, sf):
    mart = recommendations.friend_recommendations(
        a.geo_log(spark, sf), a.cities(spark, sf), PAIR_KM, dt.datetime(2024, 2, 1)
    )
    return mart.withColumn("processed_dttm", F.date_format("processed_dttm", "yyyy-MM-dd HH:mm:ss"))


QUERIES = {
    f.__name__: f
    for f in (
        haversine_pairs, box_pairs, nearest_city, nearest_city_in_box, nearest_city_many_centres, local_times, last_position, running_day_count,
        home_city, travel_history, travel_steps, travel_steps_hot, user_profiles, profile_run_files, registrations, fill_positions, zone_activity, zone_run_files,
        nearby_pairs, not_yet_talked, friend_recommendations,
    )
}

_WITH = f"WITH {a.GEO_SQL.strip()}, {a.CITIES_SQL.strip()}"
_KM = a.km_sql("g.lat", "g.lon", "c.lat", "c.lon")
_BOX = f"abs(g.lat - c.lat) <= {_DEGREES!r}::DOUBLE AND abs(g.lon - c.lon) <= {_DEGREES!r}::DOUBLE"


def _placed_sql(min_days, period="true"):
    return f"""{_WITH},
placed AS (
  SELECT g.event_id, g.user_id, g.event_time, CAST(g.event_time AS DATE) AS day, c.city, c.zoned
  FROM geo g JOIN cities c ON {_BOX} AND {period}
  QUALIFY row_number() OVER (PARTITION BY g.event_id ORDER BY round({_KM}, 6), c.id) = 1),
visits AS (
  SELECT user_id, city, zoned, count(DISTINCT day) AS days, min(event_time) AS first_ts, max(event_time) AS last_ts
  FROM placed GROUP BY ALL),
home AS (
  SELECT user_id, city AS home_city FROM visits WHERE days >= {min_days}
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY days DESC, city) = 1),
travel AS (
  SELECT user_id, count(*) AS travel_count, string_agg(city, ' > ' ORDER BY first_ts, city) AS travel_array
  FROM visits GROUP BY user_id)"""


_ALL_MESSAGES_PLACED = _placed_sql(MIN_DAYS)
_PROFILES = """
      SELECT v.user_id, v.city AS act_city, coalesce(h.home_city, v.city) AS home_city, t.travel_count, t.travel_array, {local} AS local_time
      FROM (SELECT * FROM visits QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY last_ts DESC, city DESC) = 1) v
      LEFT JOIN home h ON h.user_id = v.user_id JOIN travel t ON t.user_id = v.user_id"""
_LOCAL = "strftime(timezone({zone}, timezone('UTC', {ts})), '%Y-%m-%d %H:%M:%S')"
_LOCAL_OF_VISIT = _LOCAL.format(zone=a.zone_sql("Australia/Sydney", "v.city", "v.zoned"), ts="v.last_ts")
_LAST = """last AS (
  SELECT user_id, lat, lon, event_time AS location_ts FROM geo WHERE kind = 'message' AND lat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) = 1)"""
_PAIRS = f"""{_WITH}, {_LAST},
subs AS (SELECT DISTINCT channel_id, user_id FROM geo WHERE kind = 'subscription'),
near AS (
  SELECT DISTINCT a.user_id AS user_left, b.user_id AS user_right
  FROM subs a JOIN subs b ON a.channel_id = b.channel_id AND a.user_id < b.user_id
  JOIN last p ON p.user_id = a.user_id JOIN last q ON q.user_id = b.user_id
  WHERE {a.km_sql('p.lat', 'p.lon', 'q.lat', 'q.lon')} <= {PAIR_KM}),
fresh AS (
  SELECT * FROM near n WHERE NOT EXISTS (
    SELECT 1 FROM geo m WHERE m.kind = 'message' AND m.lat IS NOT NULL
      AND ((m.user_id = n.user_left AND m.message_to = n.user_right) OR (m.user_id = n.user_right AND m.message_to = n.user_left))))"""

_ZONES = f"""{_WITH},
period AS (SELECT * FROM geo WHERE event_time >= TIMESTAMP '2024-01-03' AND event_time < TIMESTAMP '2024-01-28'),
last AS (
  SELECT user_id, lat, lon FROM period WHERE kind = 'message' AND lat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) = 1),
filled AS (
  SELECT p.event_id, p.user_id, p.kind, p.event_time, coalesce(p.lat, l.lat) AS lat, coalesce(p.lon, l.lon) AS lon
  FROM period p LEFT JOIN last l ON l.user_id = p.user_id),
everything AS (
  SELECT event_id, kind, event_time, lat, lon FROM filled
  UNION ALL
  SELECT -1 - user_id, 'registration', event_time, lat, lon FROM filled WHERE kind = 'message'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time) = 1),
zoned_events AS (
  SELECT g.kind, g.event_time, c.id AS zone_id, week(g.event_time) AS week, strftime(g.event_time, '%Y-%m') AS month
  FROM everything g JOIN cities c ON g.lat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY g.event_id ORDER BY round({_KM}, 6), c.id) = 1),
weekly AS (
  SELECT zone_id, week, count(*) FILTER (kind = 'message') AS week_message, count(*) FILTER (kind = 'reaction') AS week_reaction,
         count(*) FILTER (kind = 'subscription') AS week_subscription, count(*) FILTER (kind = 'registration') AS week_user
  FROM zoned_events GROUP BY ALL),
monthly AS (
  SELECT zone_id, month, count(*) FILTER (kind = 'message') AS month_message, count(*) FILTER (kind = 'reaction') AS month_reaction,
         count(*) FILTER (kind = 'subscription') AS month_subscription, count(*) FILTER (kind = 'registration') AS month_user
  FROM zoned_events GROUP BY ALL)"""

ORACLE = {
    "haversine_pairs": f"{_WITH} SELECT g.event_id, CAST(c.id AS BIGINT) AS city_id, round({_KM}, 3) AS km "
    "FROM geo g JOIN cities c ON g.event_id % 25 = c.id WHERE g.lat IS NOT NULL",
    "box_pairs": f"{_WITH} SELECT g.event_id, CAST(c.id AS BIGINT) AS city_id FROM geo g JOIN cities c ON {_BOX}",
    "nearest_city": f"{_WITH} SELECT g.event_id, CAST(c.id AS BIGINT) AS city_id, round({_KM}, 3) AS km "
    "FROM geo g JOIN cities c ON g.lat IS NOT NULL "
    f"QUALIFY row_number() OVER (PARTITION BY g.event_id ORDER BY round({_KM}, 6), c.id) = 1",
    "nearest_city_in_box": f"{_WITH} SELECT g.event_id, CAST(c.id AS BIGINT) AS city_id, round({_KM}, 3) AS km "
    f"FROM geo g JOIN cities c ON {_BOX} "
    f"QUALIFY row_number() OVER (PARTITION BY g.event_id ORDER BY round({_KM}, 6), c.id) = 1",
    "nearest_city_many_centres": f"""WITH {a.GEO_SQL.strip()},
      c AS (
        SELECT c_custkey AS id,
               CASE WHEN c_custkey % 2 = 0 THEN -33.8::DOUBLE + c_custkey % 997 / 10007.0::DOUBLE ELSE -88.0::DOUBLE + c_custkey * 37 % 1759 / 10.0::DOUBLE END AS lat,
               CASE WHEN c_custkey % 2 = 0 THEN 151.2::DOUBLE + c_custkey % 991 / 10009.0::DOUBLE ELSE -179.0::DOUBLE + c_custkey * 53 % 3581 / 10.0::DOUBLE END AS lon
        FROM customer),
      g AS (SELECT DISTINCT lat, lon FROM geo WHERE lat IS NOT NULL),
      near AS (
        SELECT g.lat, g.lon, min([round({_KM}, 9), c.id, {_KM}]) AS best FROM g, c GROUP BY g.lat, g.lon)
      SELECT event_id, CAST(best[2] AS BIGINT) AS customer, round(best[3], 3) AS km FROM geo JOIN near USING (lat, lon)""",
    "local_times": f"""{_WITH} SELECT event_id, {a.zone_sql('Australia/Sydney')} AS timezone,
      {_LOCAL.format(zone=a.zone_sql('Australia/Sydney'), ts='event_time')} AS local_time
      FROM geo JOIN cities ON event_id % 25 = id""",
    "last_position": f"{_WITH}, {_LAST} SELECT user_id, lat, lon, strftime(location_ts, '%Y-%m-%d %H:%M:%S') AS location_ts FROM last",
    "running_day_count": f"""{_ALL_MESSAGES_PLACED}
      SELECT user_id, city, strftime(day, '%Y-%m-%d') AS day, count(*) OVER (PARTITION BY user_id, city ORDER BY day) AS days_in_city
      FROM (SELECT DISTINCT user_id, city, day FROM placed)""",
    "home_city": f"{_ALL_MESSAGES_PLACED} SELECT * FROM home",
    "travel_history": f"{_ALL_MESSAGES_PLACED} SELECT * FROM travel",
    "travel_steps_hot": """WITH e AS (
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 7 ELSE user_id END AS user_id,
               CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-01' + to_seconds(event_id % 3600) ELSE ts END AS sent FROM events)
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY sent, event_id) AS step FROM e""",
    "travel_steps": f"""{_ALL_MESSAGES_PLACED}
      SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS step, city FROM placed""",
    "user_profiles": _ALL_MESSAGES_PLACED + _PROFILES.format(local=_LOCAL_OF_VISIT),
    "profile_run_files": _placed_sql(profiles.HOME_MIN_DAYS, f"CAST(g.event_time AS DATE) BETWEEN '{_PROFILE_DAYS[0]}' AND '{_PROFILE_DAYS[1]}'") + _PROFILES.format(local=_LOCAL_OF_VISIT),
    "registrations": f"""{_WITH} SELECT user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS registered, lat, lon
      FROM geo WHERE kind = 'message' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time) = 1""",
    "fill_positions": f"""{_WITH}, {_LAST} SELECT g.event_id, g.kind, coalesce(g.lat, l.lat) AS lat, coalesce(g.lon, l.lon) AS lon
      FROM geo g LEFT JOIN last l ON l.user_id = g.user_id""",
    "zone_activity": f"""{_ZONES}
      SELECT month, CAST(week AS BIGINT) AS week, CAST(zone_id AS BIGINT) AS zone_id,
             week_message, week_reaction, week_subscription, week_user,
             month_message, month_reaction, month_subscription, month_user
      FROM (SELECT DISTINCT zone_id, week, month FROM zoned_events) JOIN weekly USING (zone_id, week) JOIN monthly USING (zone_id, month)""",
    "zone_run_files": f"""{_ZONES}
      SELECT month, CAST(week AS BIGINT) AS week, CAST(zone_id AS BIGINT) AS zone_id,
             week_message, week_reaction, week_subscription, week_user,
             month_message, month_reaction, month_subscription, month_user
      FROM (SELECT DISTINCT zone_id, week, month FROM zoned_events) JOIN weekly USING (zone_id, week) JOIN monthly USING (zone_id, month)""",
    "nearby_pairs": f"{_PAIRS} SELECT user_left, user_right FROM near",
    "not_yet_talked": f"{_PAIRS} SELECT user_left, user_right FROM fresh",
    "friend_recommendations": f"""{_PAIRS},
      zone_of AS (
        SELECT g.user_id, g.location_ts, {a.zone_sql('Australia/Brisbane')} AS zone
        FROM last g JOIN cities c ON abs(g.lat - c.lat) < 0.1::DOUBLE AND abs(g.lon - c.lon) < 0.1::DOUBLE
        QUALIFY row_number() OVER (PARTITION BY g.user_id ORDER BY round({_KM}, 6), c.id) = 1),
      named AS (
        SELECT user_left, user_right, l.location_ts, coalesce(p.zone, q.zone, 'Australia/Brisbane') AS zone_id
        FROM fresh JOIN last l ON l.user_id = user_left
        LEFT JOIN zone_of p ON p.user_id = user_left LEFT JOIN zone_of q ON q.user_id = user_right)
      SELECT user_left, user_right, '2024-02-01 00:00:00' AS processed_dttm, zone_id,
             {_LOCAL.format(zone='zone_id', ts='location_ts')} AS local_time FROM named""",
}
