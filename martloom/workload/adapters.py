"""The given tables seen as the inputs the products expect.

Every adapter is a narrow projection or one grouping of whole tables, and has a SQL twin (``*_SQL``,
common table expressions) for the comparison.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2024-02-01 00:00:00"
TODAY = "1997-02-10"

# Names of the first cities; the others keep the nation's name, which is no time zone.
CITY_NAMES = (
    "Sydney", "Perth", "Broken Hill", "Adelaide", "Darwin", "Hobart",
    "Melbourne", "Brisbane", "Eucla", "Lord Howe", "Currie", "Lindeman",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- geo -----------------------------------------------------------------------------------------


def cities(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in CITY_NAMES])
    key = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        key.alias("id"),
        F.coalesce(F.get(names, key), F.col("n_name")).alias("city"),
        (F.lit(-40.0) + key).alias("lat"),
        (F.lit(115.0) + key * F.lit(1.5)).alias("lon"),
    )


_LISTED = ", ".join(f"'{n}'" for n in CITY_NAMES)
CITIES_SQL = f"""
cities AS (
  SELECT n_nationkey AS id, coalesce(list_extract([{_LISTED}], n_nationkey + 1), n_name) AS city,
         -40.0::DOUBLE + n_nationkey AS lat, 115.0::DOUBLE + n_nationkey * 1.5::DOUBLE AS lon,
         n_nationkey < {len(CITY_NAMES)} AS zoned
  FROM nation)"""


def zone_sql(default: str, city: str = "city", zoned: str = "zoned") -> str:
    return f"CASE WHEN {zoned} THEN 'Australia/' || replace({city}, ' ', '_') ELSE '{default}' END"


def km_sql(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    return (
        f"(2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({lat_b} - {lat_a}) / 2), 2) + "
        f"cos(radians({lat_a})) * cos(radians({lat_b})) * pow(sin(radians({lon_b} - {lon_a}) / 2), 2)))))"
    )


# How an event type of the test table reads in the geo log.
KIND_OF = {"view": "message", "click": "reaction", "purchase": "subscription"}


def _position(column: str, start: float, steps: int):
    value = F.lit(start) + (F.col("event_id") % steps) / F.lit(10.0)
    return F.when(F.col("event_id") % 11 != 0, value).alias(column)


def geo_log(spark: SparkSession, sf: str, all_messages: bool = False) -> DataFrame:
    """The nested event log, with an ``event_id``."""
    kind = F.col("event_type")
    known = F.create_map(*[F.lit(x) for pair in KIND_OF.items() for x in pair])
    label = F.lit("message") if all_messages else F.coalesce(F.try_element_at(known, kind), F.lit("other"))
    events = table(spark, sf, "events").select("*", label.alias("kind"))
    user, stamp = F.col("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    channel = F.get_json_object("props", "$.k").cast("long") % 20

    def of(name: str, value):
        return F.when(F.col("kind") == name, value)

    event = F.struct(
        of("message", user).alias("message_from"),
        of("message", F.col("event_id")).alias("message_id"),
        of("message", (user * 7 + F.col("event_id")) % 150).alias("message_to"),
        of("message", stamp).alias("message_ts"),
        F.when(F.col("kind") != "message", stamp).alias("datetime"),
        of("reaction", user.cast("string")).alias("reaction_from"),
        of("subscription", channel).alias("subscription_channel"),
        of("subscription", user.cast("string")).alias("subscription_user"),
        of("other", user.cast("string")).alias("user"),
    )
    return events.select(
        "event_id", event.alias("event"), F.col("kind").alias("event_type"),
        _position("lat", -40.0, 250), _position("lon", 115.0, 370), F.to_date("ts").alias("date"),
    )


GEO_SQL = """
geo AS (
  SELECT event_id, user_id, ts AS event_time,
         CASE event_type WHEN 'view' THEN 'message' WHEN 'click' THEN 'reaction'
              WHEN 'purchase' THEN 'subscription' ELSE 'other' END AS kind,
         CASE WHEN event_id % 11 <> 0 THEN -40.0::DOUBLE + (event_id % 250) / 10.0::DOUBLE END AS lat,
         CASE WHEN event_id % 11 <> 0 THEN 115.0::DOUBLE + (event_id % 370) / 10.0::DOUBLE END AS lon,
         (user_id * 7 + event_id) % 150 AS message_to,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS channel_id
  FROM events)"""


# --- couriers, restaurants, products ---------------------------------------------------------------


def _money(column):
    return column.cast("decimal(19,5)")


def courier_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order and supplier: the supplier as courier, with amounts, rating and order date."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey",
        _money(F.col("l_extendedprice")).alias("price"),
        _money(F.col("l_tax") * 100).alias("tip"),
        (500 - F.round(F.col("l_discount") * 100).cast("long") * 20).alias("points"),
    )
    sums = lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("price").alias("order_sum"), F.sum("tip").alias("order_tip_sum"),
        F.sum("points").alias("points"), F.count("*").alias("n"),
    )
    # Average rating in hundredths, rounded half up in whole numbers.
    cents = F.floor((F.col("points") * 2 + F.col("n")) / (F.col("n") * 2))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("ts"))
    return sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("courier_id"), F.col("l_orderkey").alias("order_key"), "ts",
        _money(F.col("order_sum")).alias("order_sum"), (cents / 100).cast("decimal(4,2)").alias("rate"),
        _money(F.col("order_tip_sum")).alias("order_tip_sum"),
    )


COURIER_ORDERS_SQL = """
courier_orders AS (
  SELECT l_suppkey AS courier_id, l_orderkey AS order_key, any_value(o_orderdate) AS ts,
         sum(CAST(l_extendedprice AS DECIMAL(19,5))) AS order_sum,
         sum(CAST(l_tax * 100 AS DECIMAL(19,5))) AS order_tip_sum,
         (sum(500 - CAST(round(l_discount * 100) AS BIGINT) * 20) * 2 + count(*)) // (count(*) * 2) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY ALL)"""


def couriers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("courier_name"))


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as sales of an order."""
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), _money(price).alias("total_sum"),
        _money(price * F.col("l_discount")).alias("bonus_payment"), _money(price * F.col("l_tax")).alias("bonus_grant"),
    )


def fulfilled_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Fulfilled orders as closed ones, the customer as restaurant."""
    return table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("restaurant"), F.to_date("o_orderdate").alias("settlement_date")
    )


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(key.alias("id"), key.cast("string").alias("restaurant_id"), F.col("c_name").alias("restaurant_name"))


# --- staged documents -------------------------------------------------------------------------------


def staged_users(spark: SparkSession, sf: str) -> DataFrame:
    users = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("object_id")).distinct()
    return users.select(
        "object_id", F.concat(F.lit("User "), "object_id").alias("user_name"),
        F.concat(F.lit("u"), "object_id").alias("user_login"),
    )


def staged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order documents: opened at the order date, closed or cancelled some hours later, or still cooking."""
    status = F.when(F.col("o_orderstatus") == "F", "CLOSED").when(F.col("o_orderstatus") == "O", "CANCELLED").otherwise("COOKING")
    shape = "yyyy-MM-dd HH:mm:ss"
    opened = F.col("o_orderdate").cast("timestamp")
    ended = F.timestamp_add("HOUR", F.col("o_orderkey") % 5 + 1, opened)

    def step(name, at):
        return F.struct(name.alias("status"), F.date_format(at, shape).alias("dttm"))

    def ref(value):
        return F.struct(F.struct(value.cast("string").alias("$oid")).alias("id"))

    document = F.struct(
        status.alias("final_status"),
        F.array(step(F.lit("OPEN"), opened), step(status, ended)).alias("statuses"),
        ref(F.col("o_custkey")).alias("restaurant"),
        ref(F.col("o_orderkey") % 150).alias("user"),
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("object_id"),
        F.to_json(document).alias("object_value"), opened.alias("update_ts"),
    )


ORDER_TIMES_SQL = """
closed_orders AS (
  SELECT o_orderkey, o_custkey, o_orderkey % 150 AS user_id, o_orderdate + to_hours(o_orderkey % 5 + 1) AS ts,
         CASE o_orderstatus WHEN 'F' THEN 'CLOSED' ELSE 'CANCELLED' END AS status
  FROM orders WHERE o_orderstatus IN ('F', 'O'))"""


def staged_restaurants(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as restaurants with a menu of three items."""
    items = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct(
            (F.col("c_custkey") * 3 + i).cast("string").alias("_id"),
            F.concat(F.lit("dish "), i.cast("string")).alias("name"),
            ((F.col("c_custkey") % 7 + 1) * (i + 1)).cast("decimal(9,2)").alias("price"),
        ),
    )
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("object_id"),
        F.to_json(F.struct(F.col("c_name").alias("name"), items.alias("menu"))).alias("object_value"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("update_ts"),
    )


def staged_couriers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("object_id"),
        F.to_json(F.struct(F.col("s_name").alias("name"))).alias("object_value"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("update_ts"),
    )


def raw_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """One delivery record (JSON text) per order, by the order's smallest supplier."""
    grouped = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", _money(F.col("l_extendedprice")).alias("price"), _money(F.col("l_tax") * 100).alias("tip")
    ).groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("courier"), F.sum("price").alias("total"), F.sum("tip").alias("tips"), F.count("*").alias("n")
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shape = "yyyy-MM-dd HH:mm:ss"
    record = F.struct(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_orderkey") % 3 != 0, F.date_format("o_orderdate", shape)).alias("order_ts"),
        F.concat(F.lit("d"), F.col("l_orderkey").cast("string")).alias("delivery_id"),
        F.date_format(F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate").cast("timestamp")), shape).alias("delivery_ts"),
        F.col("courier").cast("string").alias("courier_id"),
        F.concat(F.lit("Street "), (F.col("l_orderkey") % 100).cast("string")).alias("address"),
        F.col("total").cast("string").alias("sum"),
        F.col("tips").cast("string").alias("tip_sum"),
        F.when(F.col("n") > 1, (F.lit(3) + F.col("n") % 3).cast("string")).alias("rate"),
    )
    return grouped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("restaurant_id"), F.to_json(record).alias("value")
    )


DELIVERIES_SQL = """
deliveries AS (
  SELECT l_orderkey AS order_id, any_value(o_orderdate) AS o_orderdate, min(l_suppkey) AS courier_id, any_value(o_custkey) AS restaurant_id,
         sum(CAST(l_extendedprice AS DECIMAL(19,5))) AS total, sum(CAST(l_tax * 100 AS DECIMAL(19,5))) AS tips,
         CASE WHEN count(*) > 1 THEN 3 + count(*) % 3 ELSE 0 END AS rate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey)"""


def bonus_events(spark: SparkSession, sf: str) -> DataFrame:
    """One bonus event per order and part; returns carry no payments."""
    price = F.col("l_extendedprice")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_quantity", _money(price).alias("unit"),
        _money(price * F.col("l_discount")).alias("paid"), _money(price * F.col("l_tax")).alias("granted"),
    )
    # Whether the least flag is R, by what can be grouped without sorting.
    flag, returned = F.col("l_returnflag"), F.lit("R")
    grouped = lines.groupBy("l_orderkey", "l_partkey").agg(
        F.max(flag < returned).alias("before"), F.max(flag == returned).alias("at"), F.max(flag > returned).alias("behind"), F.sum("l_quantity").cast("long").alias("quantity"),
        F.max("unit").alias("price"), F.sum("paid").alias("paid"), F.sum("granted").alias("granted"),
    )
    payment = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"), F.col("quantity").cast("string").alias("quantity"),
        F.col("price").cast("string").alias("price"), F.col("paid").cast("string").alias("bonus_payment"),
        F.when(F.col("l_partkey") % 4 != 0, F.col("granted").cast("string")).alias("bonus_grant"),
    )
    payments = F.when(F.col("before") | (F.col("behind") & ~F.col("at")), F.array(payment))
    return grouped.select(
        F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("order_id"), payments.alias("product_payments"))).alias("event_value")
    )


# --- social network ----------------------------------------------------------------------------------


def dialogs(spark: SparkSession, sf: str) -> DataFrame:
    """Views as messages into the group named by ``k`` modulo 10."""
    group = F.get_json_object("props", "$.k").cast("int") % 10
    return table(spark, sf, "events").where("event_type = 'view'").select(
        F.col("event_id").alias("message_id"), F.col("ts").alias("message_ts"), F.col("user_id").alias("message_from"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 150).alias("message_to"), F.col("props").alias("message"), group.alias("message_group"),
    )


def group_log(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups as joins, invited by ``user_id % 40``; errors as leaving."""
    group = F.get_json_object("props", "$.k").cast("int") % 10
    kind = F.when(F.col("event_type") == "signup", "add").otherwise("leave")
    return table(spark, sf, "events").where("event_type in ('signup', 'error')").select(
        group.alias("group_id"), "user_id", (F.col("user_id") % 40).alias("user_id_from"), kind.alias("event"), F.col("ts").alias("datetime")
    )


def social_users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(F.min("ts").alias("registration_dt")).select(
        "id", F.concat(F.lit("chat "), F.col("id").cast("string")).alias("chat_name"), "registration_dt",
        F.when(F.col("id") % 2 == 0, "AU").otherwise("NZ").alias("country"), (F.col("id") % 60 + 18).cast("int").alias("age"),
    )


def social_groups(spark: SparkSession, sf: str) -> DataFrame:
    group = F.get_json_object("props", "$.k").cast("int") % 10
    return table(spark, sf, "events").groupBy(group.alias("id")).agg(F.min("ts").alias("registration_dt")).select(
        "id", (F.col("id") * 3).cast("long").alias("admin_id"), F.concat(F.lit("group "), F.col("id").cast("string")).alias("group_name"),
        "registration_dt", (F.col("id") % 2 == 0).alias("is_private"),
    )


SOCIAL_SQL = """
logged AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS group_id FROM events)"""


# --- order messages ------------------------------------------------------------------------------------


def order_messages(spark: SparkSession, sf: str) -> DataFrame:
    """One order message per line: order, customer as user, supplier as restaurant, part as product."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    product = F.struct(
        F.col("l_partkey").cast("string").alias("id"), F.concat("p_name", F.lit(" "), F.col("l_partkey").cast("string")).alias("name"),
        F.col("p_brand").alias("category"), F.lit(None).cast("long").alias("quantity"),
    )
    cost = F.col("o_totalprice").cast("decimal(19,2)").cast("string")
    key = F.col("o_custkey").cast("string")
    payload = F.struct(
        F.col("l_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), cost.alias("cost"), cost.alias("payment"),
        F.when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN").alias("status"),
        F.struct(key.alias("id"), F.concat(F.lit("User "), key).alias("name"), F.lit(None).cast("string").alias("login")).alias("user"),
        F.struct(F.col("l_suppkey").cast("string").alias("id"), F.concat(F.lit("Kitchen "), F.col("l_suppkey").cast("string")).alias("name")).alias("restaurant"),
        F.array(product).alias("products"),
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_orderkey").alias("object_id"), F.lit("order").alias("object_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("sent_dttm"), payload.alias("payload"),
    )


ORDER_LINES_SQL = """
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, o_custkey, o_orderdate, o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(19,2)) AS VARCHAR) AS cost,
         p_name || ' ' || l_partkey AS p_name, p_brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def uuid5_sql(name: str) -> str:
    digest = f"sha1(from_hex('{uuid.NAMESPACE_DNS.hex}') || encode({name}))"
    variant = f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"{variant} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12))"
    )


# --- campaigns --------------------------------------------------------------------------------------------

# 2024-01-16 00:00:00 UTC, the middle of the month of events.
CAMPAIGN_NOW = 1705363200


def campaign_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as campaign messages (text ``value``), ten days long, each written twice."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    restaurant = F.concat(F.lit("r"), (F.get_json_object("props", "$.k").cast("long") % 100).cast("string"))
    message = F.struct(
        restaurant.alias("restaurant_id"), F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("adv_campaign_id"),
        F.lit("offer").alias("adv_campaign_content"), F.concat(F.lit("owner "), F.col("user_id").cast("string")).alias("adv_campaign_owner"),
        F.lit("owner@example.org").alias("adv_campaign_owner_contact"),
        at.alias("adv_campaign_datetime_start"), (at + 864000).alias("adv_campaign_datetime_end"), at.alias("datetime_created"),
    )
    rows = table(spark, sf, "events").where("event_type = 'purchase'").select(F.to_json(message).alias("value"))
    return rows.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")


def subscribers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers following the restaurant of their key modulo 100."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("id"), F.concat(F.lit("client "), key.cast("string")).alias("client_id"),
        F.concat(F.lit("r"), (key % 100).cast("string")).alias("restaurant_id"),
    )
