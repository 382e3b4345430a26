"""Staged documents, dimensions, facts and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.functions.documents import canonical_json, field, first_status_time, has_key
from martloom.plans import marts, warehouse
from martloom.session import materialise
from martloom.sources.increments import land_payloads, trailing_window
from martloom.workload import adapters as a

_TODAY = dt.date.fromisoformat(a.TODAY)
_LANDED = dt.datetime(2024, 1, 1)


def _text(column, shape="yyyy-MM-dd HH:mm:ss"):
    return F.date_format(column, shape)


def _deliveries(spark, sf):
    return land_payloads(a.raw_deliveries(spark, sf), ["order_id"], ["restaurant_id"], at=_LANDED)


def json_extract(spark, sf):
    doc = F.col("props")
    return a.table(spark, sf, "events").select(
        "event_id", field(doc, "k", dtype="long").alias("k"), has_key(doc, "k").alias("has_k"), has_key(doc, "z").alias("has_z")
    )


def first_status_times(spark, sf):
    rows = a.staged_orders(spark, sf).select("object_id", first_status_time(F.col("object_value")).alias("ts"))
    return rows.select("object_id", _text("ts").alias("closed_at"))


def canonical_documents(spark, sf):
    """Sorted-key JSON of every order, by its fingerprint."""
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return orders.select("o_orderkey", F.sha2(canonical_json(orders.columns), 256).alias("digest"))


def landed_deliveries(spark, sf):
    return _deliveries(spark, sf).select(
        "restaurant_id", "object_id", field(F.col("object_value"), "courier_id").alias("courier_id"),
        field(F.col("object_value"), "address").alias("address"),
    )


def recent_deliveries(spark, sf):
    """Deliveries of the four weeks before a given day whose restaurant is known."""
    rows = a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("restaurant_id"), F.col("o_orderdate").alias("ts"))
    known = a.table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("restaurant_id"))
    return trailing_window(rows, "ts", 28, known, "restaurant_id", dt.datetime(1997, 2, 10)).select("order_id", "restaurant_id")


def user_dim(spark, sf):
    return warehouse.dim_users(a.staged_users(spark, sf)).select("user_id", "user_name", "user_login")


def restaurant_dim(spark, sf):
    dim = warehouse.dim_restaurants(a.staged_restaurants(spark, sf))
    return dim.select("restaurant_id", "restaurant_name", _text("active_from").alias("active_from"), _text("active_to").alias("active_to"))


def courier_dim(spark, sf):
    return warehouse.dim_couriers(a.staged_couriers(spark, sf)).select("courier_id", "courier_name")


def delivery_dim(spark, sf):
    return warehouse.dim_deliveries(_deliveries(spark, sf)).select("delivery_id", "delivery_address")


def _timestamps(spark, sf):
    return warehouse.dim_timestamps(a.staged_orders(spark, sf), _deliveries(spark, sf))


def timestamp_dim(spark, sf):
    dim = _timestamps(spark, sf)
    return dim.select(
        _text("ts").alias("ts"), *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")],
        _text("date", "yyyy-MM-dd").alias("date"), "time",
    )


def product_dim_explode(spark, sf):
    staged = a.staged_restaurants(spark, sf)
    restaurants = warehouse.dim_restaurants(staged)
    named = restaurants.select(F.col("id").alias("restaurant_id"), F.col("restaurant_id").alias("restaurant_key"))
    products = warehouse.dim_products(staged, restaurants).join(named, "restaurant_id")
    return products.select("product_id", "product_name", F.col("product_price").cast("double").alias("product_price"), "restaurant_key")


def _orders(spark, sf):
    """(orders, timestamps) built from staged order and delivery tables, which are written first as in a real load."""
    staged = materialise(a.staged_orders(spark, sf), "staged-orders")
    deliveries = materialise(_deliveries(spark, sf), "staged-deliveries")
    # Read for the times and again for the orders: the documents are parsed once.
    closed = materialise(warehouse.closed_orders(staged), "closed-orders")
    sent = materialise(warehouse.deliveries_of_orders(deliveries), "sent-orders")
    timestamps = materialise(warehouse.dim_timestamps(closed, sent), "timestamps")
    orders = warehouse.dim_orders(
        closed, sent, timestamps, warehouse.dim_restaurants(a.staged_restaurants(spark, sf)),
        warehouse.dim_users(a.staged_users(spark, sf)), warehouse.dim_couriers(a.staged_couriers(spark, sf)),
    )
    return orders, timestamps


def order_dim(spark, sf):
    """Orders of the dimension, shown with business keys in place of ids."""
    orders, timestamps = _orders(spark, sf)
    times = timestamps.select(F.col("id").alias("timestamp_id"), "ts")
    restaurants = warehouse.dim_restaurants(a.staged_restaurants(spark, sf)).select(F.col("id").alias("restaurant_id"), F.col("restaurant_id").alias("restaurant_key"))
    couriers = warehouse.dim_couriers(a.staged_couriers(spark, sf)).select(F.col("id").alias("courier_id"), F.col("courier_id").alias("courier_key"))
    shown = orders.join(times, "timestamp_id").join(restaurants, "restaurant_id").join(couriers, "courier_id", "left")
    return shown.select("order_key", "order_status", _text("ts").alias("ts"), "restaurant_key", "courier_key")


def courier_order_sums(spark, sf):
    sums = warehouse.courier_order_sums(_deliveries(spark, sf))
    return sums.select("order_id", *[F.col(c).cast("double").alias(c) for c in ("order_sum", "order_tip_sum", "rate")])


def product_sales(spark, sf):
    """Sales read from bonus events, joined to parts and orders."""
    products = a.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("product_id"))
    orders = a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("order_key"))
    sales = warehouse.product_sales(a.bonus_events(spark, sf), products, orders)
    money = ("price", "total_sum", "bonus_payment", "bonus_grant")
    return sales.select("product_id", "order_id", F.col("count").cast("long").alias("quantity"), *[F.col(c).cast("double").alias(c) for c in money])


def _payments(spark, sf):
    return warehouse.courier_payments(a.courier_orders(spark, sf))


def courier_payments(spark, sf):
    return _payments(spark, sf).select(
        "courier_id", *[F.col(c).cast("long").alias(c) for c in ("settlement_year", "settlement_month", "orders_count")],
        *[F.col(c).cast("double").alias(c) for c in ("orders_total_sum", "rate_avg", "courier_tips_sum")],
    )


def courier_ledger(spark, sf):
    ledger = marts.courier_ledger(_payments(spark, sf), a.couriers(spark, sf), _TODAY)
    money = ("orders_total_sum", "rate_avg", "order_processing_fee", "courier_order_sum", "courier_tips_sum", "courier_reward_sum")
    return ledger.select(
        "courier_id", "courier_name", *[F.col(c).cast("long").alias(c) for c in ("settlement_year", "settlement_month", "orders_count")],
        *[F.col(c).cast("double").alias(c) for c in money],
    )


def settlement_report(spark, sf):
    report = marts.settlement_report(a.sales(spark, sf), a.fulfilled_orders(spark, sf), a.restaurants(spark, sf))
    return report.select(
        "restaurant_id", "restaurant_name", _text("settlement_date", "yyyy-MM-dd").alias("settlement_date"),
        "orders_count", *[F.col(c).cast("double").alias(c) for c in report.columns[4:]],
    )


def settlement_from_documents(spark, sf):
    """The report over the warehouse built from documents: orders, bonus events, dimensions."""
    orders, timestamps = _orders(spark, sf)
    orders = materialise(orders, "orders")  # for the sales and for the closed days
    products = a.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("product_id"))
    sales = warehouse.product_sales(a.bonus_events(spark, sf), products, orders)
    closed = marts.closed_order_days(orders, timestamps)
    report = marts.settlement_report(sales, closed, warehouse.dim_restaurants(a.staged_restaurants(spark, sf)))
    return report.select(
        "restaurant_id", "restaurant_name", _text("settlement_date", "yyyy-MM-dd").alias("settlement_date"),
        "orders_count", *[F.col(c).cast("double").alias(c) for c in report.columns[4:]],
    )


QUERIES = {
    f.__name__: f
    for f in (
        courier_ledger, courier_payments, settlement_report, settlement_from_documents, product_sales, order_dim,
        timestamp_dim, product_dim_explode, user_dim, restaurant_dim, courier_dim, delivery_dim, courier_order_sums,
        json_extract, first_status_times, canonical_documents, landed_deliveries, recent_deliveries,
    )
}

_PAYMENTS = f"""WITH {a.COURIER_ORDERS_SQL.strip()},
payments AS (
  SELECT courier_id, year(ts) AS settlement_year, month(ts) AS settlement_month, count(DISTINCT order_key) AS orders_count,
         sum(order_sum) AS orders_total_sum, sum(order_tip_sum) AS courier_tips_sum,
         CAST((sum(cents) * 2 + count(*)) // (count(*) * 2) AS BIGINT) AS rate_cents
  FROM courier_orders GROUP BY ALL)"""

_REPORT_COLUMNS = """
  count(*) AS orders_count,
  CAST(CAST(sum(total) AS DECIMAL(14,2)) AS DOUBLE) AS orders_total_sum,
  CAST(CAST(sum(paid) AS DECIMAL(14,2)) AS DOUBLE) AS orders_bonus_payment_sum,
  CAST(CAST(sum(granted) AS DECIMAL(14,2)) AS DOUBLE) AS orders_bonus_granted_sum,
  CAST(CAST(CAST(sum(total) AS DECIMAL(28,5)) * 0.25 AS DECIMAL(14,2)) AS DOUBLE) AS order_processing_fee,
  CAST(CAST(CAST(sum(total) AS DECIMAL(28,5)) * 0.75 - sum(paid) AS DECIMAL(14,2)) AS DOUBLE) AS restaurant_reward_sum"""

_BONUS = """bonus AS (
  SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, max(CAST(l_extendedprice AS DECIMAL(19,5))) AS price,
         sum(CAST(l_extendedprice * l_discount AS DECIMAL(19,5))) AS paid,
         CASE WHEN l_partkey % 4 <> 0 THEN sum(CAST(l_extendedprice * l_tax AS DECIMAL(19,5))) ELSE 0 END AS granted
  FROM lineitem GROUP BY l_orderkey, l_partkey HAVING min(l_returnflag) <> 'R')"""

_TIMES = f"""WITH {a.ORDER_TIMES_SQL.strip()}, {a.DELIVERIES_SQL.strip()},
times AS (
  SELECT ts FROM closed_orders
  UNION
  SELECT CASE WHEN order_id % 3 <> 0 THEN o_orderdate ELSE o_orderdate + to_hours(1) END FROM deliveries)"""

ORACLE = {
    "json_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
      json_exists(props, '$.k') AS has_k, json_exists(props, '$.z') AS has_z FROM events""",
    "first_status_times": f"""WITH {a.ORDER_TIMES_SQL.strip()}
      SELECT CAST(o.o_orderkey AS VARCHAR) AS object_id, strftime(c.ts, '%Y-%m-%d %H:%M:%S') AS closed_at
      FROM orders o LEFT JOIN closed_orders c USING (o_orderkey)""",
    "canonical_documents": """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
      || '","o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS digest FROM orders""",
    "landed_deliveries": f"""WITH {a.DELIVERIES_SQL.strip()}
      SELECT CAST(restaurant_id AS VARCHAR) AS restaurant_id, CAST(order_id AS VARCHAR) AS object_id,
             CAST(courier_id AS VARCHAR) AS courier_id, 'Street ' || (order_id % 100) AS address FROM deliveries""",
    "recent_deliveries": """SELECT o_orderkey AS order_id, o_custkey AS restaurant_id FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE c_mktsegment <> 'BUILDING' AND o_orderdate BETWEEN TIMESTAMP '1997-01-13' AND TIMESTAMP '1997-02-10'""",
    "user_dim": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, 'User ' || user_id AS user_name, 'u' || user_id AS user_login FROM events""",
    "restaurant_dim": """SELECT CAST(c_custkey AS VARCHAR) AS restaurant_id, c_name AS restaurant_name,
      '2024-01-01 00:00:00' AS active_from, '2099-12-31 00:00:00' AS active_to FROM customer""",
    "courier_dim": "SELECT CAST(s_suppkey AS VARCHAR) AS courier_id, s_name AS courier_name FROM supplier",
    "delivery_dim": "SELECT DISTINCT 'd' || l_orderkey AS delivery_id, 'Street ' || (l_orderkey % 100) AS delivery_address FROM lineitem",
    "timestamp_dim": f"""{_TIMES} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, year(ts) AS year, month(ts) AS month, day(ts) AS day,
      strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time FROM times""",
    "product_dim_explode": """SELECT CAST(c_custkey * 3 + i AS VARCHAR) AS product_id, 'dish ' || i AS product_name,
      CAST((c_custkey % 7 + 1) * (i + 1) AS DOUBLE) AS product_price, CAST(c_custkey AS VARCHAR) AS restaurant_key
      FROM customer, unnest([0, 1, 2]) AS t(i)""",
    "order_dim": f"""{_TIMES}
      SELECT CAST(o_orderkey AS VARCHAR) AS order_key, status AS order_status, strftime(c.ts, '%Y-%m-%d %H:%M:%S') AS ts,
             CAST(o_custkey AS VARCHAR) AS restaurant_key, CAST(d.courier_id AS VARCHAR) AS courier_key
      FROM closed_orders c JOIN (SELECT DISTINCT user_id FROM events) u ON u.user_id = c.user_id
      LEFT JOIN deliveries d ON d.order_id = c.o_orderkey""",
    "courier_order_sums": f"""WITH {a.DELIVERIES_SQL.strip()}
      SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(total AS DOUBLE) AS order_sum, CAST(tips AS DOUBLE) AS order_tip_sum,
             CAST(rate AS DOUBLE) AS rate FROM deliveries""",
    "product_sales": f"""WITH {_BONUS}
      SELECT p_partkey AS product_id, o_orderkey AS order_id, quantity, CAST(price AS DOUBLE) AS price,
             CAST(quantity * price AS DOUBLE) AS total_sum, CAST(paid AS DOUBLE) AS bonus_payment, CAST(granted AS DOUBLE) AS bonus_grant
      FROM bonus JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "courier_payments": f"""{_PAYMENTS}
      SELECT courier_id, settlement_year, settlement_month, orders_count, CAST(orders_total_sum AS DOUBLE) AS orders_total_sum,
             rate_cents / 100 AS rate_avg, CAST(courier_tips_sum AS DOUBLE) AS courier_tips_sum FROM payments""",
    "courier_ledger": f"""{_PAYMENTS},
      paid AS (
        SELECT *, CAST(greatest(
          orders_total_sum * CASE WHEN rate_cents < 400 THEN 0.05 WHEN rate_cents < 450 THEN 0.07 WHEN rate_cents < 490 THEN 0.08 ELSE 0.10 END,
          CASE WHEN rate_cents < 400 THEN 100 WHEN rate_cents < 450 THEN 150 WHEN rate_cents < 490 THEN 175 ELSE 200 END) AS DECIMAL(19,5)) AS payout
        FROM payments WHERE settlement_year = 1997 AND settlement_month = 1)
      SELECT courier_id, s_name AS courier_name, settlement_year, settlement_month, orders_count,
             CAST(orders_total_sum AS DOUBLE) AS orders_total_sum, rate_cents / 100 AS rate_avg,
             CAST(CAST(orders_total_sum * 0.25 AS DECIMAL(19,5)) AS DOUBLE) AS order_processing_fee,
             CAST(payout AS DOUBLE) AS courier_order_sum, CAST(courier_tips_sum AS DOUBLE) AS courier_tips_sum,
             CAST(CAST(payout + courier_tips_sum * 0.95 AS DECIMAL(19,5)) AS DOUBLE) AS courier_reward_sum
      FROM paid JOIN supplier ON s_suppkey = courier_id""",
    "settlement_report": f"""WITH per_order AS (
        SELECT o_custkey, o_orderdate, l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(19,5))) AS total,
               sum(CAST(l_extendedprice * l_discount AS DECIMAL(19,5))) AS paid, sum(CAST(l_extendedprice * l_tax AS DECIMAL(19,5))) AS granted
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY ALL)
      SELECT CAST(c_custkey AS VARCHAR) AS restaurant_id, c_name AS restaurant_name, strftime(o_orderdate, '%Y-%m-%d') AS settlement_date,
        {_REPORT_COLUMNS}
      FROM per_order JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name, o_orderdate""",
    "settlement_from_documents": f"""{_TIMES}, {_BONUS},
      per_order AS (
        SELECT o_custkey, CAST(c.ts AS DATE) AS day, l_orderkey, sum(quantity * price) AS total, sum(paid) AS paid, sum(granted) AS granted
        FROM bonus JOIN part ON l_partkey = p_partkey JOIN closed_orders c ON l_orderkey = c.o_orderkey
        WHERE status = 'CLOSED' AND user_id IN (SELECT user_id FROM events) GROUP BY ALL)
      SELECT CAST(c_custkey AS VARCHAR) AS restaurant_id, c_name AS restaurant_name, strftime(day, '%Y-%m-%d') AS settlement_date,
        {_REPORT_COLUMNS}
      FROM per_order JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name, day""",
}
