import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import cli, schemas
from martloom.functions.keys import hash_diff
from martloom.plans import counters, geo_log, pipelines, profiles, recommendations, social, vault, warehouse, zones
from martloom.session import work_dir
from martloom.sources import sinks
from tests.conftest import merged

SYDNEY, MELBOURNE, GOLD_COAST = (-33.865, 151.2094), (-37.8136, 144.9631), (-28.0167, 153.4)
CITIES = [(1, "Sydney", *SYDNEY), (2, "Melbourne", *MELBOURNE), (6, "Gold Coast", *GOLD_COAST)]


@pytest.fixture(scope="module")
def cities(spark):
    return spark.createDataFrame(CITIES, schemas.CITY)


def log_rows(spark, rows):
    """rows: (kind, user, time, place, extra event fields)"""
    schema = T.StructType.fromDDL(schemas.GEO_EVENT)
    out = []
    for kind, user, at, place, extra in rows:
        event = dict.fromkeys(schema["event"].dataType.names)
        event.update({"message": {"message_from": user, "message_ts": at}, "reaction": {"reaction_from": str(user), "datetime": at},
                      "subscription": {"user": str(user), "datetime": at}}[kind])
        event.update(extra)
        lat, lon = place or (None, None)
        out.append((event, kind, lat, lon, dt.date.fromisoformat(at[:10])))
    return spark.createDataFrame(out, schema)


def message(user, at, place, **extra):
    return ("message", user, at, place, {"message_id": hash((user, at)) % 10**6, **extra})


def day(i):
    return (dt.date(2022, 1, 1) + dt.timedelta(days=2 * i)).isoformat()


def test_home_needs_27_days_that_need_not_follow_each_other(spark, cities, rows):
    log = [message(1, f"{day(i)} 10:00:00", SYDNEY) for i in range(26)]
    log += [message(2, f"{day(i)} 10:00:00", SYDNEY) for i in range(27)]
    log += [message(u, "2022-06-01 09:00:00", MELBOURNE) for u in (1, 2)]
    log += [message(2, f"{day(0)} 11:00:00", SYDNEY), message(3, "2022-01-01 00:00:00", (0.0, 0.0))]
    mart = profiles.user_profiles(log_rows(spark, log), cities, time_as_text=True)
    got = rows(mart, "user_id", "act_city", "home_city", "travel_count", "travel_array", "local_time")
    assert got == [
        (1, "Melbourne", "Melbourne", 2, ["Sydney", "Melbourne"], "2022-06-01 19:00:00"),
        (2, "Melbourne", "Sydney", 2, ["Sydney", "Melbourne"], "2022-06-01 19:00:00"),
    ]


def test_home_tie_goes_to_the_name(spark, rows):
    visits = spark.createDataFrame([(1, "B", 30), (1, "A", 30), (2, "C", 5)], "user_id int, city string, days int")
    assert rows(profiles.home_city(visits)) == [(1, "A")]


def test_two_events_of_one_instant_stay_two(spark, cities, rows):
    log = [message(1, "2022-01-01 10:00:00", SYDNEY), message(1, "2022-01-01 10:00:00", MELBOURNE)]
    placed = profiles.place_messages(geo_log.flatten_log(log_rows(spark, log)), profiles.city_timezones(cities))
    assert rows(placed, "city") == [("Melbourne",), ("Sydney",)]
    assert [r[1] for r in rows(profiles.travel_steps(placed))] == [1, 2]


def test_unknown_zone_falls_back(cities, rows):
    zoned = profiles.city_timezones(cities, default="Australia/Brisbane")
    assert rows(zoned, "city", "timezone") == [
        ("Gold Coast", "Australia/Brisbane"), ("Melbourne", "Australia/Melbourne"), ("Sydney", "Australia/Sydney")
    ]


def test_zone_mart_counts_every_kind(spark, cities, rows):
    log = [
        message(1, "2022-01-03 10:00:00", SYDNEY), message(1, "2022-01-04 10:00:00", SYDNEY),
        ("reaction", 1, "2022-01-05 10:00:00", None, {}), ("subscription", 1, "2022-01-31 10:00:00", None, {"subscription_channel": 5}),
        message(2, "2022-02-01 10:00:00", SYDNEY), ("reaction", 9, "2022-01-05 10:00:00", None, {}),
    ]
    mart = zones.user_activity_zones(log_rows(spark, log), cities, "2022-01-01", "2022-03-01")
    assert rows(mart) == [
        ("2022-01", 1, 1, 2, 1, 0, 1, 2, 1, 1, 1),
        ("2022-01", 5, 1, 1, 0, 1, 1, 2, 1, 1, 1),
        ("2022-02", 5, 1, 1, 0, 1, 1, 1, 0, 0, 1),
    ]


def test_weeks_of_two_years_merge_unless_asked(spark, rows):
    placed = spark.createDataFrame(
        [("message", dt.datetime(2022, 1, 12), None), ("message", dt.datetime(2023, 1, 12), None)], "kind string, event_time timestamp, zone_id int"
    )
    assert {r[3] for r in rows(zones.zone_activity(placed))} == {2}
    assert {r[4] for r in rows(zones.zone_activity(placed, year_aware=True))} == {1}


def test_recommendations(spark, cities, rows):
    near = (SYDNEY[0] + 0.004, SYDNEY[1])
    log = [
        message(10, "2022-01-01 10:00:00", SYDNEY, message_to=30), message(9, "2022-01-01 11:00:00", near, message_to=1),
        message(30, "2022-01-01 12:00:00", SYDNEY, message_to=1), message(40, "2022-01-01 12:00:00", MELBOURNE, message_to=1),
    ]
    log += [("subscription", u, "2022-01-01 09:00:00", None, {"subscription_channel": c}) for u in (9, 10, 30, 40) for c in (1, 2)]
    at = dt.datetime(2022, 2, 1)
    got = rows(recommendations.friend_recommendations(log_rows(spark, log), cities, processed_dttm=at))
    # 10 and 30 have talked; 40 is far away; ids compare as numbers.
    assert got == [
        (9, 10, at, "Australia/Sydney", "2022-01-01 22:00:00"),
        (9, 30, at, "Australia/Sydney", "2022-01-01 22:00:00"),
    ]


PUBLISHED = [(365, 1136, 3.1123287671232876712), (279, 861, 3.0860215053763440860), (791, 2387, 3.0176991150442477876),
             (930, 2757, 2.9645161290322580645), (901, 2448, 2.7169811320754716981)]


def test_group_conversion_of_published_counts(spark):
    added = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(PUBLISHED)] + [(99, 0)], "hk_group_id int, cnt_added_users int")
    active = spark.createDataFrame([(i, b) for i, (_, b, _) in enumerate(PUBLISHED)], "hk_group_id int, cnt_users_in_group_with_messages int")
    got = {r.hk_group_id: r.group_conversion for r in social.group_conversion(added, active).collect()}
    assert got[99] == 0.0
    for i, (_, _, expected) in enumerate(PUBLISHED):
        assert got[i] == pytest.approx(expected, abs=1e-12)


def test_added_users_by_inviter_or_by_user(spark, rows):
    groups = spark.createDataFrame([(1, 1, dt.datetime(2020, 1, 1)), (2, 2, dt.datetime(2021, 1, 1))], "hk_group_id int, group_id int, registration_dt timestamp")
    links = spark.createDataFrame([(11, 1, 101), (12, 1, 102), (21, 2, 101)], "hk_l_user_group_activity int, hk_group_id int, hk_user_id int")
    history = spark.createDataFrame([(11, 7, "add"), (12, 7, "add"), (21, 7, "add"), (11, None, "leave")], "hk_l_user_group_activity int, user_id_from int, event string")
    assert rows(social.added_users(history, links, groups, 1)) == [(1, 1)]
    assert rows(social.added_users(history, links, groups, 1, "user")) == [(1, 2)]


def test_hub_link_and_satellite_load_once(spark, rows):
    staged = spark.createDataFrame([(1, "a", 10), (1, "a", 10), (2, "b", 20), (None, "c", 30), (3, "c", 99)], "u int, name string, g int")
    users = vault.load_hub(staged, "u", "hk_u", {"name": "name"}, "src")
    groups = vault.load_hub(staged.where("g < 50"), "g", "hk_g", {}, "src")
    assert rows(users, "u", "name") == [(1, "a"), (2, "b"), (3, "c")]
    assert vault.load_hub(staged, "u", "hk_u", {"name": "name"}, "src", existing=users).count() == 0
    hubs = [(users, "hk_u", "u", "u"), (groups, "hk_g", "g", "g")]
    links = vault.load_link(staged, hubs, "hk", "src")
    assert links.count() == 2 and vault.load_link(staged, hubs, "hk", "src", existing=links).count() == 0
    states = vault.load_satellite(staged, users, ("u", "u"), "hk_u", {"name": "name"}, "src", existing=users.select("hk_u", F.lit("").alias("hashdiff")).limit(0))
    assert states.count() == 3
    renamed = staged.withColumn("name", F.when(F.col("u") == 2, "B").otherwise(F.col("name")))
    more = vault.load_satellite(renamed, users, ("u", "u"), "hk_u", {"name": "name"}, "src", existing=states)
    assert rows(more, "name") == [("B",)]


def test_changed_states_records_a_return(spark, rows):
    when = dt.datetime(2022, 1, 1)
    stored = spark.createDataFrame([(1, "A", when), (1, "B", when + dt.timedelta(1)), (2, "A", when)], "p int, name string, load_dt timestamp")
    batch = spark.createDataFrame([(1, "B", 1), (1, "A", 2), (2, "A", 1), (3, "N", 1)], "p int, name string, seq int")
    fingerprint = hash_diff(F.col("name")).alias("hashdiff")
    got = vault.changed_states(batch.select("*", fingerprint), stored.select("*", fingerprint), "p", "seq", "name")
    assert rows(got, "p", "name") == [(1, "A"), (3, "N")]


def social_staging(spark, more=False):
    t = [dt.datetime(2024, 1, d) for d in range(1, 10)]
    users = [(1, "c1", t[0], "AU", 20), (2, "c2", t[1], None, None)] + ([(3, "c3", t[2], "NZ", 30)] if more else [])
    groups = [(10, 1, "g10", t[0], True), (20, 7, "g20!" if more else "g20", t[1], False)]  # 7 is no user
    dialogs = [(100, t[3], 1, 2, "hi", 10), (101, t[3], 2, 1, None, None)] + ([(102, t[4], 3, 1, "new", 20)] if more else [])
    log = [(10, 1, 2, "add", t[3]), (10, 1, None, "leave", t[4]), (10, 1, None, "leave", t[4]), (20, 2, None, "add", t[3]), (10, 9, 1, "add", t[3]), (None, 1, 1, "add", t[3]), (10, None, 1, "add", t[3])]
    log += [(10, 1, 2, "add", t[5]), (20, 3, 1, "add", t[5])] if more else []
    return (
        spark.createDataFrame(users, "id long, chat_name string, registration_dt timestamp, country string, age int"),
        spark.createDataFrame(groups, "id long, admin_id long, group_name string, registration_dt timestamp, is_private boolean"),
        spark.createDataFrame(dialogs, "message_id long, message_ts timestamp, message_from long, message_to long, message string, message_group long"),
        spark.createDataFrame(log, "group_id long, user_id long, user_id_from long, event string, datetime timestamp"),
    )


def test_social_vault_writes_the_parents_once(spark, rows):
    written = []

    def write(df, name):
        written.append(name)
        return df.localCheckpoint()

    when = dt.datetime(2024, 2, 1)
    plain = vault.social_vault(*social_staging(spark), when, "sha256")
    first = vault.social_vault(*social_staging(spark), when, "sha256", write=write)
    assert sorted(written) == sorted(vault.SOCIAL_PARENTS)
    assert {n: rows(t) for n, t in first.items()} == {n: rows(t) for n, t in plain.items()}
    sizes = {n: t.count() for n, t in first.items()}
    assert sizes["s_auth_history"] == 4 and sizes["l_user_group_activity"] == 2 and sizes["l_admins"] == sizes["s_admins"] == 1
    assert all(not rows(t) for t in vault.social_vault(*social_staging(spark), when, "sha256", first, write).values())
    again = vault.social_vault(*social_staging(spark, more=True), when, "sha256", first, write)
    assert rows(again["h_users"], "user_id") == [(3,)] and rows(again["s_user_socdem"], "country", "age") == [("NZ", 30)]
    assert rows(again["h_dialogs"], "message_id") == [(102,)] and again["h_groups"].count() == again["l_admins"].count() == again["s_admins"].count() == 0
    assert rows(again["s_group_name"], "group_name") == [("g20!",)] and again["s_group_private_status"].count() == 0
    assert again["l_user_message"].count() == again["l_groups_dialogs"].count() == again["l_user_group_activity"].count() == 1
    assert rows(again["s_auth_history"], "user_id_from", "event", "event_dt") == [(1, "add", dt.datetime(2024, 1, 6)), (2, "add", dt.datetime(2024, 1, 6))]


def test_auth_history_keys_each_pair_once(spark, rows):
    *_, log = social_staging(spark)
    activity = vault.social_vault(*social_staging(spark), algo="sha256")["l_user_group_activity"].localCheckpoint()
    history = vault.auth_history(log, activity, algo="sha256")
    assert rows(history.select("hk_l_user_group_activity").distinct()) == rows(activity, "hk_l_user_group_activity")
    # Events are as many as the log, pairs are few: keys are hashed in the result of the pairs' distinct, and nowhere below it.
    plan = history._jdf.queryExecution().optimizedPlan().toString().splitlines()
    hashed, distinct = ([i for i, line in enumerate(plan) if text in line] for text in ("sha2(", "Aggregate [user_id"))
    assert hashed and distinct and max(hashed) <= min(distinct)


def test_counters_accept_flat_and_nested_messages(spark, rows):
    nested = '{"user_id":"u","products":[{"product_id":"p","product_name":"P","category_id":"c","category_name":"C","quantity":3}]}'
    flat = '{"user_id":"u","product_id":"p","product_name":"P","category_id":"c","category_name":"C"}'
    messages = spark.createDataFrame([(nested,), (flat,), ('{"user_id":"u"}',)], "value string").select(F.from_json("value", schemas.MART_MESSAGE).alias("m")).select("m.*")
    counted = counters.count_orders(counters.normalise(messages), "user_product_counters")
    assert rows(counted) == [("u", "p", "P", 4)]


def staging(spark):
    def docs(items, extra=()):
        data = [(key, json.dumps(doc), dt.datetime(2024, 1, 1)) for key, doc in items]
        return spark.createDataFrame(data, "object_id string, object_value string, update_ts timestamp")

    def order(key, status, at, restaurant="r1", user="u1"):
        log = [{"status": "OPEN", "dttm": "2024-01-10 08:00:00"}] + ([{"status": status, "dttm": at}] if at else [])
        return key, {"final_status": status, "statuses": log, "restaurant": {"id": {"$oid": restaurant}}, "user": {"id": {"$oid": user}}}

    def paid(order_key, *items):
        return (json.dumps({"order_id": order_key, "product_payments": [dict(zip(("product_id", "quantity", "price", "bonus_payment", "bonus_grant"), i)) for i in items]}),)

    return {
        "users": spark.createDataFrame([("u1", "Ann", "ann")], "object_id string, user_name string, user_login string"),
        "restaurants": docs([("r1", {"name": "Rest", "menu": [{"_id": "p1", "name": "Soup", "price": 10}, {"_id": "p2", "name": "Pie", "price": 2.5}]}), ("r2", {"name": "No menu"})]),
        "orders": docs([order("o1", "CLOSED", "2024-01-10 09:00:00"), order("o2", "CLOSED", "2024-01-10 10:00:00"), order("o3", "CANCELLED", "2024-01-10 11:00:00"), order("o4", "COOKING", None), order("o5", "CLOSED", "2024-01-10 10:00:00", user="nobody")]),
        "couriers": docs([("c1", {"name": "Bob"})]),
        "deliveries": docs([("o1", {"order_id": "o1", "order_ts": "2024-01-10 08:00:00", "delivery_id": "d1", "courier_id": "c1", "address": "A", "sum": 1000, "tip_sum": 100, "rate": 4}), ("o2", {"order_id": "o2", "delivery_ts": "2024-01-10 10:30:00", "delivery_id": "d2", "courier_id": "c1", "address": "B", "sum": 3000, "rate": 4.5})]),
        "bonus_events": spark.createDataFrame([paid("o1", ("p1", 2, 10, 5, 1), ("p2", 4, 2.5, None, 1)), paid("o2", ("p1", 1, 10, 0, 0)), paid("o3", ("p1", 1, 10, 0, 0)), ('{"user":1}',), ('{"order_id":"o1","product_payments":"none"}',)], "event_value string"),
    }


def test_warehouse_end_to_end_and_again(spark):
    base = work_dir(spark, "house")
    for _ in range(2):
        pipelines.run_warehouse(spark, staging(spark), base, dt.date(2024, 2, 5))

    def table(name):
        return merged(spark, f"{base}/{name}")

    assert table("dm_orders").count() == 3 and table("dm_products").count() == 2
    assert table("dm_timestamps").count() == 5
    assert table("fct_product_sales").count() == 4
    report = table("dm_settlement_report").collect()
    assert [(r.orders_count, float(r.orders_total_sum), float(r.orders_bonus_payment_sum), float(r.order_processing_fee), float(r.restaurant_reward_sum)) for r in report] == [(2, 40.0, 5.0, 10.0, 25.0)]
    ledger = table("dm_courier_ledger").collect()
    assert [(r.courier_name, r.settlement_year, r.settlement_month, r.orders_count, float(r.orders_total_sum), float(r.rate_avg)) for r in ledger] == [("Bob", 2024, 1, 2, 4000.0, 4.25)]
    assert (float(ledger[0].order_processing_fee), float(ledger[0].courier_order_sum), float(ledger[0].courier_reward_sum)) == (1000.0, 280.0, 375.0)


def test_warehouse_takes_the_last_version(spark):
    s = staging(spark)
    renamed = [("r1", json.dumps({"name": n, "menu": [{"_id": "p1", "name": "Soup", "price": 10}]}), dt.datetime(2024, 1, d)) for n, d in (("Old", 1), ("Zed", 2), ("New", 3))]
    s["restaurants"] = spark.createDataFrame(renamed, s["restaurants"].schema)
    paid = [(i, json.dumps({"order_id": "o1", "product_payments": [{"product_id": "p1", "quantity": q, "price": 10, "bonus_payment": 0, "bonus_grant": 0}]}), dt.datetime(2024, 1, 10, i)) for i, q in ((1, 9), (2, 4), (3, 5))]
    s["bonus_events"] = spark.createDataFrame(paid, "id int, event_value string, event_ts timestamp")
    base = work_dir(spark, "house-versions")
    pipelines.run_warehouse(spark, s, base, dt.date(2024, 2, 5))
    assert [r.restaurant_name for r in merged(spark, f"{base}/dm_restaurants").collect()] == ["New"]
    assert [r["count"] for r in merged(spark, f"{base}/fct_product_sales").collect()] == [5]
    assert [float(r.orders_total_sum) for r in merged(spark, f"{base}/dm_settlement_report").collect()] == [50.0]


def test_orders_already_there_are_left_out(spark):
    s = staging(spark)
    dims = (warehouse.dim_timestamps(s["orders"], s["deliveries"]), warehouse.dim_restaurants(s["restaurants"]), warehouse.dim_users(s["users"]), warehouse.dim_couriers(s["couriers"]))
    orders = warehouse.dim_orders(s["orders"], s["deliveries"], *dims)
    assert orders.where("courier_id is null").count() == 1
    assert warehouse.dim_orders(s["orders"], s["deliveries"], *dims, existing=orders).count() == 0


def test_geo_command_line(spark, cities, tmp_path, monkeypatch):
    log = [message(1, f"2022-01-0{i} 10:00:00", SYDNEY, message_to=2) for i in range(1, 5)]
    sinks.write_partitioned(log_rows(spark, log), str(tmp_path / "events"), ["date"])
    cities.coalesce(1).write.option("header", True).csv(str(tmp_path / "cities"))
    monkeypatch.setattr(cli, "build_session", lambda *_: spark)
    args = ["geo", "--events-path", str(tmp_path / "events"), "--cities-path", str(tmp_path / "cities"), "--output-path", str(tmp_path / "out")]
    cli.main([*args, "--date-from", "2022-01-01", "--date-to", "2022-01-03"])
    assert spark.read.parquet(str(tmp_path / "out/user_profiles")).first().act_city == "Sydney"
    assert spark.read.parquet(str(tmp_path / "out/user_activity_zones")).agg(F.max("month_message")).first()[0] == 2
    assert spark.read.parquet(str(tmp_path / "out/friend_recommendations")).count() == 0


def test_zones_count_events_of_far_day_folders(spark, cities, tmp_path, monkeypatch):
    event = lambda i, sent: {"event": {"message_id": i, "message_from": 1, "datetime": sent}, "event_type": "message", "lat": -37.8, "lon": 144.9}
    for i, day in enumerate(["2022-01-03", "2022-02-20", "__HIVE_DEFAULT_PARTITION__"]):
        rows = spark.createDataFrame([json.dumps(event(i, "2022-01-03 08:00:00"))], "string").selectExpr("value")
        log = rows.select(F.from_json("value", T.StructType.fromDDL(schemas.GEO_EVENT)).alias("e")).select("e.*").drop("date")
        log.write.parquet(str(tmp_path / f"events/date={day}"))
    cities.drop("tz").write.option("header", True).csv(str(tmp_path / "geo.csv"))
    monkeypatch.setattr(cli, "build_session", lambda app: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    paths = ["--events-path", str(tmp_path / "events"), "--cities-path", str(tmp_path / "geo.csv")]
    for extra, n in (([], 3), (["--margin-days", "1"], 1)):
        out = str(tmp_path / f"out{n}")
        cli.main(["geo", *paths, "--output-path", out, "--date-from", "2022-01-01", "--date-to", "2022-01-31", "--only", "zones", *extra])
        assert spark.read.parquet(f"{out}/user_activity_zones").agg(F.max("month_message")).first()[0] == n


def test_documents_of_a_settlement_are_parsed_once(spark, rows):
    """The report starts from rows read once: neither times nor orders go back to the documents, and both take such rows as they are."""
    from martloom.workload import adapters, warehouse as queries

    plan = queries.settlement_from_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "final_status" not in plan and "delivery_ts" not in plan and "product_payments" in plan
    orders, sent = adapters.staged_orders(spark, "/root/testdata/sf0.001"), queries._deliveries(spark, "/root/testdata/sf0.001")
    read = warehouse.closed_orders(orders), warehouse.deliveries_of_orders(sent)
    assert rows(warehouse.dim_timestamps(*read)) == rows(warehouse.dim_timestamps(orders, sent))


def test_a_whole_run_over_the_same_staging_writes_no_bucket_again(spark):
    """Rows that a table holds as they are do not reach the merge; one that differs does."""
    from martloom.sources.buckets import BucketTable

    base, names = work_dir(spark, "same"), ("dm_orders", "fct_product_sales", "dm_settlement_report", "dm_restaurants")
    s = staging(spark)

    def versions():
        pipelines.run_warehouse(spark, s, base, dt.date(2024, 2, 5))
        return {name: BucketTable(spark, f"{base}/{name}", T.StructType(), []).manifest().version for name in names}

    before = versions()
    assert versions() == before
    s["restaurants"] = s["restaurants"].withColumn("object_value", F.regexp_replace("object_value", '"name": "', '"name": "New '))
    assert versions()["dm_restaurants"] > before["dm_restaurants"]
    assert merged(spark, f"{base}/dm_restaurants").where("restaurant_name like 'New %'").count() == merged(spark, f"{base}/dm_restaurants").count()


def test_documents_of_deliveries_are_parsed_once_for_a_table(spark, rows):
    """Not again by the filter of those that hold an order or a delivery; rows parsed beforehand give the same."""
    from martloom.plans import warehouse
    from martloom.schemas import DELIVERY_DOC

    docs = [("o1", '{"order_id":"o1","delivery_id":"d1","address":"a","sum":"1.5","tip_sum":"x","rate":"4","courier_id":"c","order_ts":"2024-01-02 00:00:00"}'),
            ("o2", '{"order_id":"o2"}'), ("o3", '{"delivery_id":"d3"}'), ("o4", "no document"), ("o5", None)]
    staged = spark.createDataFrame([(i, d, dt.datetime(2024, 1, 1)) for i, d in docs], "object_id string, object_value string, update_ts timestamp")
    before = warehouse.parsed(staged, DELIVERY_DOC)
    assert "object_value" not in before.columns
    for table, n in ((warehouse.courier_order_sums, 2), (warehouse.dim_deliveries, 2), (warehouse.deliveries_of_orders, 5)):
        found = table(staged)
        assert rows(found) == rows(table(before)) and len(rows(found)) == n
        assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_ids_of_landed_records_are_read_once(spark, rows):
    from martloom.sources.increments import land_payloads

    records = spark.createDataFrame([("1",), ("",), (None,), ("2",)], "id string").select(F.to_json(F.struct("id")).alias("value"))
    landed = land_payloads(records, ["id"], at=dt.datetime(2024, 1, 1))
    assert rows(landed, "object_id", "object_value") == [("1", '{"id":"1"}'), ("2", '{"id":"2"}')]
    assert landed._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1


def test_payments_leave_out_groups_whose_least_flag_is_a_return(spark, tmp_path, rows):
    from martloom.workload import adapters

    flags = {1: ["R"], 2: ["A", "R"], 3: ["N", "R"], 4: ["N"], 5: [None], 6: [None, "N"], 7: ["A", "N"], 8: ["R", "Z"], 9: ["Z"]}
    lines = [(order, 1, flag, 1.0, 2.0, 0.1, 0.2) for order, of in flags.items() for flag in of]
    schema = "l_orderkey long, l_partkey long, l_returnflag string, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    events = adapters.bonus_events(spark, str(tmp_path))
    assert "SortAggregate" not in events._jdf.queryExecution().sparkPlan().toString()
    paid = events.select(F.get_json_object("event_value", "$.order_id").cast("int").alias("o")).where(F.col("event_value").contains("product_payments"))
    assert [r[0] for r in rows(paid)] == [2, 3, 4, 6, 7, 9]
