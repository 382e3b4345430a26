"""Data Vault loads and the questions asked of the vault."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martloom.functions.keys import hash_diff
from martloom.plans import counters, social, vault
from martloom.session import materialise, work_dir
from martloom.streaming.order_vault import new_states, read_vault, vault_sink
from martloom.workload import adapters as a

_LOADED = dt.datetime(2024, 2, 1)
_ALGO = "sha256"


def _social_inputs(spark, sf):
    """Users, groups, messages and group log, written once: made where they are read, each table of the vault would parse the documents of all events again."""
    return [materialise(source(spark, sf), source.__name__) for source in (a.social_users, a.social_groups, a.dialogs, a.group_log)]


def _social(spark, sf):
    return vault.social_vault(*_social_inputs(spark, sf), _LOADED, _ALGO)


def _customer_hub(spark, sf):
    customers = a.table(spark, sf, "customer").select("c_custkey", "c_name")
    return vault.load_hub(customers, "c_custkey", "hk_customer", {"c_name": "c_name"}, "batch", _LOADED, algo=_ALGO)


def _order_hub(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return vault.load_hub(orders, "o_orderkey", "hk_order", {"o_orderstatus": "o_orderstatus"}, "batch", _LOADED, algo=_ALGO)


def hub_load(spark, sf):
    """Customers named by orders, into a hub that already has the BUILDING segment."""
    known = vault.load_hub(
        a.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey"), "c_custkey", "hk_customer", {}, "first", _LOADED, algo=_ALGO
    )
    seen = a.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    rows = vault.load_hub(seen, "c_custkey", "hk_customer", {}, "orders", _LOADED, known, _ALGO)
    return rows.select("hk_customer", "c_custkey", F.date_format("load_dt", "yyyy-MM-dd").alias("load_dt"), "load_src")


def link_load(spark, sf):
    """Order-part relations of all lines, each once, kept where both hubs know their side."""
    parts = vault.load_hub(a.table(spark, sf, "part").select("p_partkey"), "p_partkey", "hk_part", {}, "batch", _LOADED, algo=_ALGO)
    lines = a.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    hubs = [(_order_hub(spark, sf), "hk_order", "o_orderkey", "l_orderkey"), (parts, "hk_part", "p_partkey", "l_partkey")]
    return vault.load_link(lines, hubs, "hk_link", "lines", _LOADED, algo=_ALGO).select("hk_link", "hk_order", "hk_part")


def satellite_load(spark, sf):
    customers = a.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows = vault.load_satellite(
        customers, _customer_hub(spark, sf), ("c_custkey", "c_custkey"), "hk_customer", {"name": "c_name", "segment": "c_mktsegment"}, "batch", _LOADED
    )
    return rows.select("hk_customer", "name", "segment", "hashdiff")


def hashdiff_changes(spark, sf):
    """Order statuses against those stored before: only parents whose fingerprint differs."""
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    old = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    stored = orders.select("o_orderkey", hash_diff(old).alias("hashdiff"), F.col("o_orderdate").alias("load_dt"))
    batch = orders.select("o_orderkey", "o_orderstatus", hash_diff(F.col("o_orderstatus")).alias("hashdiff"), F.col("o_orderdate").alias("at"))
    return vault.changed_states(batch, stored, "o_orderkey", "at", "hashdiff").select("o_orderkey", "o_orderstatus", "hashdiff")


def auth_history(spark, sf):
    tables = _social(spark, sf)
    rows = tables["s_auth_history"].select("hk_l_user_group_activity", "user_id_from", "event", F.date_format("event_dt", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_dt"))
    return rows


def social_satellites(spark, sf):
    """Row counts of every table of the social vault."""
    tables = vault.social_vault(*_social_inputs(spark, sf), _LOADED, _ALGO, write=materialise)
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _hub_groups(tables):
    return tables["h_groups"].select("hk_group_id", F.col("group_id").cast("long").alias("group_id"))


def _with_group(rows, tables):
    return rows.join(_hub_groups(tables), "hk_group_id").drop("hk_group_id")


def users_with_messages(spark, sf):
    t = _social(spark, sf)
    return _with_group(social.users_with_messages(t["l_user_message"], t["l_groups_dialogs"]), t)


def added_users(spark, sf):
    t = _social(spark, sf)
    return _with_group(social.added_users(t["s_auth_history"], t["l_user_group_activity"], t["h_groups"], 5), t)


def group_conversion(spark, sf):
    t = _social(spark, sf)
    added = social.added_users(t["s_auth_history"], t["l_user_group_activity"], t["h_groups"], 5)
    mart = social.group_conversion(added, social.users_with_messages(t["l_user_message"], t["l_groups_dialogs"]))
    return _with_group(mart.withColumn("group_conversion", F.round("group_conversion", 9)), t)


def ordered_group_conversion(spark, sf):
    t = _social(spark, sf)
    added = social.added_users(t["s_auth_history"], t["l_user_group_activity"], t["h_groups"], 5)
    mart = social.group_conversion(added, social.users_with_messages(t["l_user_message"], t["l_groups_dialogs"]))
    return _with_group(social.ordered_conversion(mart).select("place", "hk_group_id"), t)


def _vault_counts(spark, sf, name):
    return vault.order_vault(a.order_messages(spark, sf), "orders", _LOADED)[name]


def order_vault_hubs(spark, sf):
    """User and product hub of the order vault, with their version-5 keys."""
    tables = vault.order_vault(a.order_messages(spark, sf), "orders", _LOADED)
    users = tables["h_user"].select(F.lit("user").alias("hub"), F.col("h_user_pk").alias("pk"), F.col("user_id").alias("business_key"))
    products = tables["h_product"].select(F.lit("product").alias("hub"), F.col("h_product_pk").alias("pk"), F.col("product_id").alias("business_key"))
    return users.unionByName(products)


def order_vault_links(spark, sf):
    return _vault_counts(spark, sf, "l_order_product").select("hk_order_product_pk", "h_order_pk", "h_product_pk")


def order_vault_costs(spark, sf):
    return _vault_counts(spark, sf, "s_order_cost").select("h_order_pk", "cost", "payment", "hk_order_cost_hashdiff")


def order_vault_files(spark, sf):
    """The whole vault written twice by the loader, as two batches; the second must add nothing."""
    base, messages = work_dir(spark, "vault"), a.order_messages(spark, sf)
    load = vault_sink(base, "orders", _LOADED, run="files")
    for batch_id in (0, 1):
        load(messages, batch_id)
    return vault_rows(spark, base)


def vault_rows(spark, base):
    """Every row of the fourteen tables: name, key, two further columns (keys, names or values), fingerprint."""
    out = None
    for name in vault.ORDER_VAULT_KEYS:
        rows = read_vault(spark, base, name)
        plain = [c for c in rows.columns[1:] if c not in ("load_dt", "load_src", vault.STATE_TIME) and not c.endswith("_hashdiff")]
        diff = [c for c in rows.columns if c.endswith("_hashdiff")]
        shown = [F.col(c).cast("string") for c in (rows.columns[0], *plain)] + [F.lit(None).cast("string")] * (2 - len(plain))
        named = rows.select(F.lit(name).alias("name"), *[c.alias(n) for c, n in zip(shown, ("pk", "a", "b"))], (F.col(diff[0]) if diff else F.lit(None).cast("string")).alias("diff"))
        out = named if out is None else out.unionByName(named)
    return out


def satellite_returns(spark, sf):
    """Chains of event types by user, loaded in two batches of time: every change is a state, returns included."""
    events = a.table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias(vault.STATE_TIME))
    states = events.distinct().withColumn("fingerprint", F.concat("event_type", F.lit("")))
    cut = F.lit("2024-01-12").cast("timestamp")
    stored = materialise(new_states(states.limit(0), states.where(F.col(vault.STATE_TIME) < cut), "user_id", "fingerprint"), "chains")
    # The second batch brings the last day before the cut again.
    fresh = new_states(stored, states.where(F.col(vault.STATE_TIME) >= F.date_sub(cut, 1)), "user_id", "fingerprint")
    return stored.unionByName(fresh).select("user_id", "event_type", F.date_format(vault.STATE_TIME, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("since"))


def social_vault_twice(spark, sf):
    """What a second load of the same social tables adds to the first: nothing, and one row for every renamed group."""
    users, groups, dialogs, group_log = _social_inputs(spark, sf)
    tables = vault.social_vault(users, groups, dialogs, group_log, _LOADED, _ALGO, write=materialise)
    tables = {name: rows if name in vault.SOCIAL_PARENTS else materialise(rows, name) for name, rows in tables.items()}
    renamed = groups.withColumn("group_name", F.when(F.col("id") % 2 == 0, F.concat("group_name", F.lit("!"))).otherwise(F.col("group_name")))
    again = vault.social_vault(users, renamed, dialogs, group_log, _LOADED, _ALGO, tables, materialise)
    counts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in again.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _counted(spark, sf, counter):
    return counters.count_order_messages(a.order_messages(spark, sf), counter)


def user_product_counters(spark, sf):
    return _counted(spark, sf, "user_product_counters")


def user_category_counters(spark, sf):
    return _counted(spark, sf, "user_category_counters")


QUERIES = {
    f.__name__: f
    for f in (
        hub_load, link_load, satellite_load, hashdiff_changes, auth_history, social_satellites, users_with_messages,
        added_users, group_conversion, ordered_group_conversion, order_vault_hubs, order_vault_links, order_vault_costs, order_vault_files, satellite_returns, social_vault_twice,
        user_product_counters, user_category_counters,
    )
}

_U = a.uuid5_sql


def _pk(entity: str, column: str) -> str:
    return _U(f"('h_{entity}_' || {column})")


_SOCIAL = f"""WITH {a.SOCIAL_SQL.strip()},
added AS (
  SELECT group_id, count(DISTINCT user_id % 40) AS cnt_added_users FROM logged WHERE event_type = 'signup'
    AND group_id IN (SELECT group_id FROM logged GROUP BY group_id ORDER BY min(ts), group_id LIMIT 5) GROUP BY group_id),
writing AS (SELECT group_id, count(DISTINCT user_id) AS cnt_users_in_group_with_messages FROM logged WHERE event_type = 'view' GROUP BY group_id)"""

_LINES = f"WITH {a.ORDER_LINES_SQL.strip()}"
_VAULT_ROWS = f"""{_LINES}, n AS (
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS o, CAST(l_partkey AS VARCHAR) AS p, CAST(l_suppkey AS VARCHAR) AS r, CAST(o_custkey AS VARCHAR) AS u, p_brand AS c, p_name, cost,
               CASE o_orderstatus WHEN 'F' THEN 'CLOSED' ELSE 'OPEN' END AS status, strftime(o_orderdate, '%Y-%m-%d') AS day FROM lines),
      k AS (SELECT *, {_pk('order', 'o')} AS ok, {_pk('product', 'p')} AS pk, {_pk('restaurant', 'r')} AS rk, {_pk('user', 'u')} AS uk, {_pk('category', 'c')} AS ck FROM n),
      rows AS (
        SELECT DISTINCT 'h_user' AS name, uk AS pk, u AS a, NULL AS b, NULL AS diff FROM k
        UNION SELECT 'h_restaurant', rk, r, NULL, NULL FROM k
        UNION SELECT 'h_order', ok, o, day, NULL FROM k
        UNION SELECT 'h_product', pk, p, NULL, NULL FROM k
        UNION SELECT 'h_category', ck, c, NULL, NULL FROM k
        UNION SELECT 'l_order_product', {_U("('l_order_product_' || ok || '_' || pk)")}, ok, pk, NULL FROM k
        UNION SELECT 'l_order_user', {_U("('l_order_user_' || ok || '_' || uk)")}, ok, uk, NULL FROM k
        UNION SELECT 'l_product_category', {_U("('l_product_category_' || pk || '_' || ck)")}, pk, ck, NULL FROM k
        UNION SELECT 'l_product_restaurant', {_U("('l_product_restaurant_' || pk || '_' || rk)")}, pk, rk, NULL FROM k
        UNION SELECT 's_order_cost', ok, cost, cost, {_U("sha256(cost || '|' || cost)")} FROM k
        UNION SELECT 's_order_status', ok, status, NULL, {_U("sha256(status)")} FROM k
        UNION SELECT 's_user_names', uk, 'User ' || u, u, {_U("sha256('User ' || u || '|' || u)")} FROM k
        UNION SELECT 's_product_names', pk, p_name, NULL, {_U("sha256(p_name)")} FROM k
        UNION SELECT 's_restaurant_names', rk, 'Kitchen ' || r, NULL, {_U("sha256('Kitchen ' || r)")} FROM k)
      SELECT * FROM rows"""

_PRODUCT_COUNTERS = f"""{_LINES},
      counted AS (SELECT o_custkey, l_partkey, max(p_name) AS p_name, count(*) AS n FROM lines GROUP BY ALL)
      SELECT {_pk('user', 'o_custkey')} AS user_id, {_pk('product', 'l_partkey')} AS product_id, p_name AS product_name, n AS order_cnt FROM counted"""
_CATEGORY_COUNTERS = f"""{_LINES},
      counted AS (SELECT o_custkey, p_brand, count(*) AS n FROM lines GROUP BY ALL)
      SELECT {_pk('user', 'o_custkey')} AS user_id, {_pk('category', 'p_brand')} AS category_id, p_brand AS category_name, n AS order_cnt FROM counted"""

ORACLE = {
    "hub_load": """SELECT DISTINCT sha256(CAST(o_custkey AS VARCHAR)) AS hk_customer, o_custkey AS c_custkey, '2024-02-01' AS load_dt, 'orders' AS load_src
      FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "link_load": """WITH l AS (SELECT DISTINCT sha256(CAST(l_orderkey AS VARCHAR)) AS hk_order, sha256(CAST(l_partkey AS VARCHAR)) AS hk_part
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
      SELECT sha256(hk_order || '_' || hk_part) AS hk_link, hk_order, hk_part FROM l""",
    "satellite_load": f"""SELECT sha256(CAST(c_custkey AS VARCHAR)) AS hk_customer, c_name AS name, c_mktsegment AS segment,
      {_U("sha256(c_name || '|' || c_mktsegment)")} AS hashdiff FROM customer""",
    "hashdiff_changes": f"""SELECT o_orderkey, o_orderstatus, {_U("sha256(o_orderstatus)")} AS hashdiff FROM orders WHERE o_orderstatus = 'P'""",
    "auth_history": f"""WITH {a.SOCIAL_SQL.strip()}
      SELECT sha256(sha256(CAST(user_id AS VARCHAR)) || '_' || sha256(CAST(group_id AS VARCHAR))) AS hk_l_user_group_activity,
             CASE WHEN event_type = 'signup' THEN user_id % 40 END AS user_id_from,
             CASE WHEN event_type = 'signup' THEN 'add' ELSE 'leave' END AS event, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_dt
      FROM logged WHERE event_type IN ('signup', 'error')""",
    "social_satellites": f"""WITH {a.SOCIAL_SQL.strip()},
      u AS (SELECT count(DISTINCT user_id) AS n FROM logged), g AS (SELECT count(DISTINCT group_id) AS n FROM logged),
      m AS (SELECT count(*) AS n FROM logged WHERE event_type = 'view'),
      adm AS (SELECT count(*) AS n FROM (SELECT DISTINCT group_id FROM logged) WHERE group_id * 3 IN (SELECT user_id FROM logged)),
      act AS (SELECT count(DISTINCT (user_id, group_id)) AS n FROM logged WHERE event_type IN ('signup', 'error')),
      log AS (SELECT count(*) AS n FROM logged WHERE event_type IN ('signup', 'error'))
      SELECT 'h_users' AS name, n FROM u UNION ALL SELECT 'h_groups', n FROM g UNION ALL SELECT 'h_dialogs', n FROM m
      UNION ALL SELECT 'l_user_message', n FROM m UNION ALL SELECT 'l_groups_dialogs', n FROM m
      UNION ALL SELECT 'l_admins', n FROM adm UNION ALL SELECT 's_admins', n FROM adm
      UNION ALL SELECT 'l_user_group_activity', n FROM act UNION ALL SELECT 's_auth_history', n FROM log
      UNION ALL SELECT 's_user_chatinfo', n FROM u UNION ALL SELECT 's_user_socdem', n FROM u
      UNION ALL SELECT 's_group_private_status', n FROM g UNION ALL SELECT 's_group_name', n FROM g
      UNION ALL SELECT 's_dialog_info', n FROM m""",
    "users_with_messages": f"{_SOCIAL} SELECT * FROM writing",
    "added_users": f"{_SOCIAL} SELECT * FROM added",
    "group_conversion": f"""{_SOCIAL} SELECT group_id, cnt_added_users, coalesce(cnt_users_in_group_with_messages, 0) AS cnt_users_in_group_with_messages,
      round(coalesce(cnt_users_in_group_with_messages / nullif(cnt_added_users, 0), 0), 9) AS group_conversion
      FROM added LEFT JOIN writing USING (group_id)""",
    "ordered_group_conversion": f"""{_SOCIAL} SELECT group_id, row_number() OVER (
        ORDER BY coalesce(cnt_users_in_group_with_messages / nullif(cnt_added_users, 0), 0) DESC, sha256(CAST(group_id AS VARCHAR))) AS place
      FROM added LEFT JOIN writing USING (group_id)""",
    "order_vault_hubs": f"""{_LINES}
      SELECT DISTINCT 'user' AS hub, {_pk('user', 'o_custkey')} AS pk, CAST(o_custkey AS VARCHAR) AS business_key FROM lines
      UNION ALL SELECT DISTINCT 'product', {_pk('product', 'l_partkey')}, CAST(l_partkey AS VARCHAR) FROM lines""",
    "order_vault_links": f"""{_LINES}, p AS (SELECT DISTINCT {_pk('order', 'l_orderkey')} AS h_order_pk, {_pk('product', 'l_partkey')} AS h_product_pk FROM lines)
      SELECT {_U("('l_order_product_' || h_order_pk || '_' || h_product_pk)")} AS hk_order_product_pk, h_order_pk, h_product_pk FROM p""",
    "order_vault_costs": f"""{_LINES}, o AS (SELECT DISTINCT l_orderkey, cost FROM lines)
      SELECT {_pk('order', 'l_orderkey')} AS h_order_pk, cost, cost AS payment, {_U("sha256(cost || '|' || cost)")} AS hk_order_cost_hashdiff FROM o""",
    "order_vault_files": _VAULT_ROWS,
    "satellite_returns": """WITH e AS (SELECT DISTINCT user_id, event_type, ts FROM events)
      SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS since FROM e
      QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type)
           OR row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) = 1""",
    "social_vault_twice": f"""WITH {a.SOCIAL_SQL.strip()}
      SELECT name, CASE WHEN name = 's_group_name' THEN (SELECT count(DISTINCT group_id) FROM logged WHERE group_id % 2 = 0) ELSE 0 END AS n
      FROM (VALUES ('h_users'), ('h_groups'), ('h_dialogs'), ('l_user_message'), ('l_groups_dialogs'), ('l_admins'), ('l_user_group_activity'), ('s_admins'),
        ('s_user_chatinfo'), ('s_user_socdem'), ('s_group_private_status'), ('s_group_name'), ('s_dialog_info'), ('s_auth_history')) t(name)""",
    "user_product_counters": _PRODUCT_COUNTERS,
    "user_category_counters": _CATEGORY_COUNTERS,
}
