"""Data Vault loads: hubs, links, satellites; the social and the order vault.

Every load returns only the rows that are new, to be appended. Keys are hashes of business keys,
so links and satellites compute parent keys themselves; a join to the hub remains where the row may
only be kept if the hub knows the key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import hash_diff, hash_key, uuid5
from martloom.operators.columns import inviter_on_add, messages_with_payload, stamp
from martloom.operators.merge import new_rows
from martloom.operators.windows import changes, latest_per_key


def load_hub(
    staged: DataFrame, business_key: str, hub_key: str, attrs: Mapping[str, str], load_src: str,
    load_dt: dt.datetime | None = None, existing: DataFrame | None = None, algo: str = "xxhash64", name: str | None = None,
) -> DataFrame:
    """New business keys. ``attrs`` maps target names to staged columns; the smallest value wins in a batch."""
    source = staged.where(F.col(business_key).isNotNull())
    keyed = source.groupBy(F.col(business_key).alias(name or business_key))
    described = keyed.agg(*[F.min(c).alias(n) for n, c in attrs.items()]) if attrs else source.select(F.col(business_key).alias(name or business_key)).distinct()
    rows = described.select(hash_key(F.col(name or business_key), algo=algo).alias(hub_key), "*")
    return _only_new(stamp(rows, load_src, load_dt), existing, [hub_key])


def load_link(
    staged: DataFrame, hubs: Sequence[tuple[DataFrame, str, str, str]], link_key: str, load_src: str,
    load_dt: dt.datetime | None = None, existing: DataFrame | None = None, algo: str = "xxhash64",
) -> DataFrame:
    """New relations. Each hub is ``(hub, hub_key, hub_business_key, staged_column)``; rows that miss a hub drop out.

    Relations are made distinct on their business keys before the lookups, so a pair repeated
    over many staged rows reaches the joins once.
    """
    columns = [column for _, _, _, column in hubs]
    rows = staged.select(*columns)
    for column in columns:
        rows = rows.where(F.col(column).isNotNull())
    rows = rows.distinct()
    for hub, hub_key, business_key, column in hubs:
        rows = rows.join(hub.select(F.col(hub_key), F.col(business_key).alias(column)), column)
    hub_keys = [hub_key for _, hub_key, _, _ in hubs]
    linked = rows.select(hash_key(*[F.col(k) for k in hub_keys], algo=algo).alias(link_key), *hub_keys)
    return _only_new(stamp(linked, load_src, load_dt), existing, [link_key])


def load_satellite(
    staged: DataFrame, parent: DataFrame, on: tuple[str, str], parent_key: str, attrs: Mapping[str, str | Column],
    load_src: str, load_dt: dt.datetime | None = None, existing: DataFrame | None = None,
) -> DataFrame:
    """Descriptive rows of known parents. ``on`` is (staged column, parent's business key).

    With ``existing`` (which then must carry ``hashdiff``) only states the parent never had are returned.
    """
    staged_column, business_key = on
    known = parent.select(F.col(parent_key), F.col(business_key).alias(staged_column))
    values = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in attrs.items()]
    rows = staged.select(staged_column, *values).join(known, staged_column).select(parent_key, *attrs)
    rows = rows.withColumn("hashdiff", hash_diff(*[F.col(n) for n in attrs]))
    stamped = stamp(rows, load_src, load_dt)
    return stamped if existing is None else new_rows(existing, stamped, [parent_key, "hashdiff"])


def changed_states(
    batch: DataFrame, existing: DataFrame, parent_key: str, order_by: str, tie: str, load_order: str = "load_dt"
) -> DataFrame:
    """The latest state per parent in ``batch`` where it differs from the latest one stored.

    Unlike an insert of unseen states this also records a return to an earlier state.
    """
    last_seen = latest_per_key(existing.select(parent_key, "hashdiff", load_order), [parent_key], load_order, "hashdiff")
    stored = last_seen.select(parent_key, F.col("hashdiff").alias("_stored"))
    joined = latest_per_key(batch, [parent_key], order_by, tie).join(stored, parent_key, "left")
    return joined.where(~F.col("hashdiff").eqNullSafe(F.col("_stored"))).drop("_stored")


def _only_new(rows: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    return rows if existing is None else new_rows(existing, rows, keys)


#: Tables of the social vault that others are made from.
SOCIAL_PARENTS = ("h_users", "h_groups", "h_dialogs", "l_admins", "l_user_group_activity")


def social_vault(
    users: DataFrame, groups: DataFrame, dialogs: DataFrame, group_log: DataFrame,
    load_dt: dt.datetime | None = None, algo: str = "xxhash64", existing: Mapping[str, DataFrame] | None = None,
    write: Callable[[DataFrame, str], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Hubs, links and satellites of users, groups, messages and group membership.

    With ``existing``, the tables so far, only what they lack is returned: new keys, states other than the parent's last one,
    and membership events that are not there. ``write`` (``materialise``) gets each of ``SOCIAL_PARENTS`` and its name, and gives back
    what the other tables are made from; without it every table that is used makes its parents anew.
    """
    tables = _social_vault(users, groups, dialogs, group_log, load_dt, algo, write or (lambda rows, name: rows))
    return tables if existing is None else {name: _not_stored(name, rows, existing[name]) for name, rows in tables.items()}


def _not_stored(name: str, rows: DataFrame, stored: DataFrame) -> DataFrame:
    key = rows.columns[0]
    if "hashdiff" in rows.columns:
        return changed_states(rows, stored, key, "load_dt", "hashdiff")
    # Membership events and administrators are rows of their own; hubs and links go by their key.
    row = [c for c in rows.columns if c not in ("load_dt", "load_src")] if name.startswith("s_") else [key]
    return rows.join(stored.select(*row), reduce(lambda a, b: a & b, [rows[c].eqNullSafe(stored[c]) for c in row]), "left_anti")


def _social_vault(
    users: DataFrame, groups: DataFrame, dialogs: DataFrame, group_log: DataFrame, load_dt: dt.datetime | None, algo: str,
    write: Callable[[DataFrame, str], DataFrame],
) -> dict[str, DataFrame]:
    src, log_src = "s3", "group_log"
    h_users = write(load_hub(users, "id", "hk_user_id", {"registration_dt": "registration_dt"}, src, load_dt, algo=algo, name="user_id"), "h_users")
    h_groups = write(load_hub(groups, "id", "hk_group_id", {"registration_dt": "registration_dt"}, src, load_dt, algo=algo, name="group_id"), "h_groups")
    h_dialogs = write(load_hub(dialogs, "message_id", "hk_message_id", {"message_ts": "message_ts"}, src, load_dt, algo=algo), "h_dialogs")
    user = (h_users, "hk_user_id", "user_id")
    group = (h_groups, "hk_group_id", "group_id")
    message = (h_dialogs, "hk_message_id", "message_id")
    admins = write(load_link(groups, [(*group, "id"), (*user, "admin_id")], "hk_l_admin_id", src, load_dt, algo=algo), "l_admins")
    activity = write(
        load_link(group_log, [(*user, "user_id"), (*group, "group_id")], "hk_l_user_group_activity", log_src, load_dt, algo=algo), "l_user_group_activity"
    )

    def satellite(staged, parent, column, attrs):
        hub, hub_key, business_key = parent
        return load_satellite(staged, hub, (column, business_key), hub_key, attrs, src, load_dt)

    return {
        "h_users": h_users,
        "h_groups": h_groups,
        "h_dialogs": h_dialogs,
        "l_user_message": load_link(dialogs, [(*user, "message_from"), (*message, "message_id")], "hk_l_user_message", src, load_dt, algo=algo),
        "l_groups_dialogs": load_link(dialogs, [(*message, "message_id"), (*group, "message_group")], "hk_l_groups_dialogs", src, load_dt, algo=algo),
        "l_admins": admins,
        "l_user_group_activity": activity,
        "s_admins": stamp(
            admins.select("hk_l_admin_id", "hk_group_id")
            .join(h_groups.select("hk_group_id", F.col("registration_dt").alias("admin_from")), "hk_group_id")
            .select(F.col("hk_l_admin_id").alias("hk_admin_id"), F.lit(True).alias("is_admin"), "admin_from"),
            src, load_dt,
        ),
        "s_user_chatinfo": satellite(users, user, "id", {"chat_name": "chat_name"}),
        "s_user_socdem": satellite(users, user, "id", {"country": "country", "age": "age"}),
        "s_group_private_status": satellite(groups, group, "id", {"is_private": "is_private"}),
        "s_group_name": satellite(groups, group, "id", {"group_name": "group_name"}),
        "s_dialog_info": satellite(dialogs, message, "message_id", {"message": "message", "message_from": "message_from", "message_to": "message_to"}),
        "s_auth_history": auth_history(group_log, activity, log_src, load_dt, algo),
    }


def auth_history(
    group_log: DataFrame, activity: DataFrame, load_src: str = "group_log", load_dt: dt.datetime | None = None,
    algo: str = "xxhash64",
) -> DataFrame:
    """Every membership event of a known (user, group) relation; the inviter is kept on joining only.

    The relation's key is computed from the log itself, once for each pair of a user and a group. One semi join of these pairs with
    the link, which holds only users and groups of the hubs, replaces the lookups in hubs and link; events meet them by the short ids.
    """
    pair, link = ["user_id", "group_id"], "hk_l_user_group_activity"
    user, group = hash_key(F.col("user_id"), algo=algo), hash_key(F.col("group_id"), algo=algo)
    pairs = group_log.select(*pair).where("user_id is not null and group_id is not null").distinct()
    keyed = pairs.select(*pair, hash_key(user, group, algo=algo).alias(link))
    # Null-safe, though no key is null: a test for null would be pushed down to the events and hash each of them.
    known = keyed.join(activity.select(link), keyed[link].eqNullSafe(activity[link]), "left_semi")
    events = group_log.select(
        *pair, inviter_on_add(F.col("event"), F.col("user_id_from")).alias("user_id_from"), "event", F.col("datetime").alias("event_dt")
    )
    return stamp(events.join(known, pair).select(link, "user_id_from", "event", "event_dt"), load_src, load_dt)


# When a satellite's state was sent; null before every other time.
STATE_TIME = "state_dt"

# Table -> its key columns. A satellite has the chain of its parent's states, a fingerprint for each.
ORDER_VAULT_KEYS = {
    "h_user": ["h_user_pk"],
    "h_restaurant": ["h_restaurant_pk"],
    "h_order": ["h_order_pk"],
    "h_product": ["h_product_pk"],
    "h_category": ["h_category_pk"],
    "l_order_product": ["hk_order_product_pk"],
    "l_order_user": ["hk_order_user_pk"],
    "l_product_category": ["hk_product_category_pk"],
    "l_product_restaurant": ["hk_product_restaurant_pk"],
    "s_order_cost": ["h_order_pk", "hk_order_cost_hashdiff"],
    "s_order_status": ["h_order_pk", "hk_order_status_hashdiff"],
    "s_user_names": ["h_user_pk", "hk_user_names_hashdiff"],
    "s_product_names": ["h_product_pk", "hk_product_names_hashdiff"],
    "s_restaurant_names": ["h_restaurant_pk", "hk_restaurant_names_hashdiff"],
}


#: Entity -> the column of its business key. Rows are told apart by these, and keys computed of what is left: they are five times as long.
BUSINESS_KEYS = {"order": "order_id", "user": "user_id", "restaurant": "restaurant_id", "product": "product_id", "category": "category_name"}

#: Satellite -> (entity, what it holds by the columns of orders or lines).
ORDER_SATELLITES = {
    "s_order_cost": ("order", {"cost": "cost", "payment": "payment"}),
    "s_order_status": ("order", {"status": "status"}),
    "s_user_names": ("user", {"username": "username", "userlogin": "userlogin"}),
    "s_product_names": ("product", {"name": "product_name"}),
    "s_restaurant_names": ("restaurant", {"name": "restaurant_name"}),
}


def _hub_pk(entity: str, column: Column) -> Column:
    return uuid5(F.lit(f"h_{entity}"), column).alias(f"h_{entity}_pk")


def _pk_of(entity: str) -> Column:
    return _hub_pk(entity, F.col(BUSINESS_KEYS[entity]))


def flat_orders(messages: DataFrame) -> DataFrame:
    """Order messages that carry a payload, flattened."""
    p = messages_with_payload(messages).select("sent_dttm", "payload.*")
    return p.select(
        F.try_to_timestamp("sent_dttm").alias(STATE_TIME),
        F.col("id").alias("order_id"), F.col("date").alias("order_dt"), "cost", "payment", "status",
        F.col("user.id").alias("user_id"), F.col("user.name").alias("username"),
        F.coalesce("user.login", "user.id").alias("userlogin"),
        F.col("restaurant.id").alias("restaurant_id"), F.col("restaurant.name").alias("restaurant_name"),
        F.coalesce("products", F.expr("array()")).alias("products"),
    )


def order_heads(orders: DataFrame) -> DataFrame:
    """What flat orders say beside restaurant and products, each once: an order sent as many messages, one for each product, is one row."""
    return orders.drop("products", "restaurant_id", "restaurant_name").distinct()


def flat_lines(orders: DataFrame) -> DataFrame:
    """One row per order and product."""
    lines = orders.withColumn("product", F.explode("products")).drop("products")
    return lines.select(
        F.col("product.id").alias("product_id"), F.col("product.name").alias("product_name"),
        F.col("product.category").alias("category_name"), F.coalesce("product.quantity", F.lit(1)).alias("quantity"),
        "order_id", "user_id", "restaurant_id", STATE_TIME,
    )


def _hub(rows: DataFrame, entity: str, *attrs: str) -> DataFrame:
    key = BUSINESS_KEYS[entity]
    named = rows.where(F.col(key).isNotNull())
    return named.groupBy(key).agg(*[F.min(a).alias(a) for a in attrs]) if attrs else named.select(key).distinct()


def _link(rows: DataFrame, left: str, right: str) -> DataFrame:
    sides = [BUSINESS_KEYS[left], BUSINESS_KEYS[right]]
    return rows.select(*sides).where(" and ".join(f"{c} is not null" for c in sides)).distinct()


def keyed_rows(rows: DataFrame, name: str, load_src: str, load_dt: dt.datetime | None = None) -> DataFrame:
    """Rows of a hub or link, by business keys, with the keys of the vault before them and stamps behind."""
    sides = name.split("_")[1:]
    keyed = rows.select(*[_pk_of(entity) for entity in sides], "*")
    if name.startswith("l_"):
        keyed = keyed.select(uuid5(F.lit(name), *[F.col(f"h_{entity}_pk") for entity in sides]).alias(ORDER_VAULT_KEYS[name][0]), "*")
    return stamp(keyed, load_src, load_dt)


def order_vault(
    messages: DataFrame, load_src: str, load_dt: dt.datetime | None = None
) -> dict[str, DataFrame]:
    """Five hubs, four links and five satellites of a batch of order messages: each key once, and every change of a state."""
    orders = flat_orders(messages)
    lines = flat_lines(orders)
    tables = {name: keyed_rows(rows, name, load_src, load_dt).select(*vault_columns(rows, name)) for name, rows in hubs_and_links(orders, orders, lines).items()}
    for name, rows in order_states(orders, orders, lines).items():
        parent, fingerprint = ORDER_VAULT_KEYS[name]
        states = keyed_states(rows.distinct(), name, load_src, load_dt).drop(BUSINESS_KEY)
        tables[name] = changes(states, [parent], STATE_TIME, fingerprint, fingerprint, "day")
    return tables


def vault_columns(rows: DataFrame, name: str) -> list[str]:
    """Columns of a hub or link that is made of such rows: a link holds no business keys."""
    keys = [f"h_{entity}_pk" for entity in name.split("_")[1:]]
    return [*(keys + rows.columns if name.startswith("h_") else ORDER_VAULT_KEYS[name] + keys), "load_dt", "load_src"]


def hubs_and_links(orders: DataFrame, heads: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Rows of the hubs and links of flat orders and lines, by business keys (see ``keyed_rows``); ``heads`` are the orders or their ``order_heads``."""
    return {
        "h_user": _hub(heads, "user"),
        "h_restaurant": _hub(orders, "restaurant"),
        "h_order": _hub(heads, "order", "order_dt"),
        "h_product": _hub(lines, "product"),
        "h_category": _hub(lines, "category"),
        "l_order_product": _link(lines, "order", "product"),
        "l_order_user": _link(heads, "order", "user"),
        "l_product_category": _link(lines, "product", "category"),
        "l_product_restaurant": _link(lines, "product", "restaurant"),
    }


#: The parent's business key in rows of states.
BUSINESS_KEY = "business_key"


def order_states(orders: DataFrame, heads: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Rows (business key, what it holds, time) of every satellite, repeated or not."""
    sources = {"order": heads, "user": heads, "restaurant": orders, "product": lines}
    return {
        name: sources[entity].select(F.col(BUSINESS_KEYS[entity]).alias(BUSINESS_KEY), *[F.col(c).alias(n) for n, c in attrs.items()], STATE_TIME).where(f"{BUSINESS_KEY} is not null")
        for name, (entity, attrs) in ORDER_SATELLITES.items()
    }


def keyed_states(rows: DataFrame, name: str, load_src: str, load_dt: dt.datetime | None = None) -> DataFrame:
    """States with their parent's key, their fingerprint and stamps, and whatever columns they came with."""
    entity, attrs = ORDER_SATELLITES[name]
    fingerprint = hash_diff(*[F.col(n) for n in attrs]).alias(ORDER_VAULT_KEYS[name][1])
    rest = [c for c in rows.columns if c not in (*attrs, STATE_TIME)]
    return stamp(rows.select(_hub_pk(entity, F.col(BUSINESS_KEY)), *attrs, STATE_TIME, fingerprint, *rest), load_src, load_dt)


def order_lines(lines: DataFrame) -> DataFrame:
    """Flat lines with all their keys."""
    return lines.select(*[_pk_of(entity) for entity in BUSINESS_KEYS], "*")


def mart_messages(messages: DataFrame) -> DataFrame:
    """One outgoing row per ordered product: user, product and category with their names."""
    return line_messages(flat_lines(flat_orders(messages)))


def line_messages(lines: DataFrame) -> DataFrame:
    return order_lines(lines).select(
        F.col("h_user_pk").alias("user_id"), F.col("h_product_pk").alias("product_id"), "product_name",
        F.col("h_category_pk").alias("category_id"), "category_name", "quantity", F.col("h_order_pk").alias("order_id"),
    )
