"""Merges, load state, audits, keys and the smaller relational operators."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.keys import hash_diff, hash_key
from martloom.functions.money import ratio
from martloom.functions.temporal import parse_time
from martloom.functions.text import clean_text, null_tokens
from martloom.operators import aggregates, columns, lookups, merge, quality, sets, windows
from martloom.operators.surrogate import surrogate_key
from martloom.schemas import BONUS_DOC
from martloom.session import work_dir
from martloom.sources import files, sinks
from martloom.sources.buckets import BucketTable
from martloom.sources.increments import WatermarkStore, incremental_load, read_increment
from martloom.workload import adapters as a

_CUSTOMER = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def _customers(spark, sf):
    return a.table(spark, sf, "customer").select(*_CUSTOMER)


def _changed(spark, sf):
    """A batch over every customer, each listed twice (the later copy counts): some balances one higher,
    the others as they were; and a new customer for each."""
    base = _customers(spark, sf)
    known = base.withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1))))
    known = known.withColumn("c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + F.col("seq")).otherwise(F.col("c_acctbal")))
    return known.unionByName(base.withColumns({"c_custkey": F.col("c_custkey") + 1000000000, "seq": F.lit(0)}))


def upsert_overwrite(spark, sf):
    """Balances overwritten, the market segment kept."""
    batch = _changed(spark, sf).withColumn("c_mktsegment", F.lit("BATCH"))
    return merge.merge_overwrite(_customers(spark, sf), batch, ["c_custkey"], ["c_name", "c_acctbal"], ["seq"])


def upsert_if_changed(spark, sf):
    """Only rows whose balance differs take the batch's segment; every other customer comes unchanged."""
    batch = _customers(spark, sf).withColumns(
        {"c_acctbal": F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).otherwise(F.col("c_acctbal") + 1), "c_mktsegment": F.lit("BATCH")}
    )
    return merge.merge_if_changed(_customers(spark, sf), batch, ["c_custkey"], ["c_name", "c_acctbal"])


def insert_new(spark, sf):
    return merge.insert_new(_customers(spark, sf), _changed(spark, sf).select(*_CUSTOMER, "seq").drop("seq").distinct(), ["c_custkey"], ["c_acctbal"])


def additive_counters(spark, sf):
    """Event counts per user: those before mid-month, plus the rest as a batch."""
    events = a.table(spark, sf, "events").select("user_id", "event_type", F.lit(1).cast("long").alias("cnt"), "ts")
    before = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    target = events.where(before).groupBy("user_id").agg(F.sum("cnt").alias("cnt"), F.max("event_type").alias("event_type"))
    return merge.merge_add(target, events.where(~before), ["user_id"], ["cnt"], ["event_type"], "ts")


def increment_page(spark, sf):
    """A page of the feature's own size: the thousand orders after a key."""
    return read_increment(a.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 500, 1000)


def merge_into_files(spark, sf):
    """Two batches merged into a bucketed Parquet table, rewriting only touched buckets."""
    path, keys = work_dir(spark, "merged"), ["c_custkey"]
    base = _customers(spark, sf)
    for batch in (base, _changed(spark, sf)):
        plan = functools.partial(merge.merge_overwrite, keys=keys, update_cols=["c_acctbal"], order_by=["seq"] if "seq" in batch.columns else None)
        sinks.merge_into(spark, path, batch, keys, lambda t, s, plan=plan: plan(t, s), base.schema, max_rows=200)
    return sinks.read_merged(spark, path, base.schema)


def merge_many_batches(spark, sf):
    """Orders merged in five batches that overlap, into buckets that split on the way; at last one order changes, in one bucket."""
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.lit(0).cast("long").alias("version"))
    keys, last = ["o_orderkey"], orders.agg(F.max("o_orderkey")).first()[0]
    table = BucketTable(spark, work_dir(spark, "batches"), orders.schema, keys, max_rows=max(1, orders.count() // 20), filters=False)
    for i in range(5):
        part = orders.where((F.col("o_orderkey") % 7 <= i + 1) & (F.col("o_orderkey") % 7 >= i)).withColumn("version", F.lit(i + 1).cast("long"))
        table.merge(part, functools.partial(merge.merge_overwrite, keys=keys))
    before = table.manifest()
    table.merge(orders.where(F.col("o_orderkey") == last).withColumn("version", F.lit(9).cast("long")), functools.partial(merge.merge_overwrite, keys=keys))
    rewritten = len(set(before.buckets) - set(table.manifest().buckets))
    return table.read().withColumns({"rewritten": F.lit(rewritten), "split": F.lit(len(before.buckets) >= 16)})


def incremental_runs(spark, sf):
    """Three runs of one loader over a source that grows: half, all, and nothing new."""
    path = work_dir(spark, "increments")
    store, orders = WatermarkStore(spark, f"{path}/state"), a.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2

    def write(batch):
        sinks.merge_into(spark, f"{path}/orders", batch, ["o_orderkey"], lambda t, s: merge.merge_overwrite(t, s, ["o_orderkey"]), orders.schema, max_rows=2_000)

    for source in (orders.where(F.col("o_orderkey") <= half), orders, orders):
        incremental_load(store, "orders", lambda source=source: source, "o_orderkey", write)
    return sinks.read_merged(spark, f"{path}/orders", orders.schema)


def partition_rewrite(spark, sf):
    """Orders by year; then one year replaced, the others untouched."""
    path = work_dir(spark, "years")
    orders = a.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.lit(0).alias("version"))
    sinks.write_partitioned(orders, path, ["y"])
    sinks.write_partitioned(orders.where("y = 1996").withColumn("version", F.lit(1)), path, ["y"])
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("y").cast("long").alias("y"), F.col("version").cast("long").alias("version")).agg(F.count("*").alias("n"))


def constraint_audit(spark, sf):
    rules = {"balance_not_negative": F.col("c_acctbal") >= 0, "segment_known": F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE")}
    checked = quality.check_constraints(_customers(spark, sf), rules)
    rejected = quality.split_checked(checked)[1]
    return rejected.select("c_custkey", F.array_join("violations", ",").alias("violations"))


def orphan_audit(spark, sf):
    """Orders of customers outside the first segments."""
    parents = _customers(spark, sf).where("c_mktsegment <> 'BUILDING'")
    return quality.orphans(a.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), parents, {"o_custkey": "c_custkey"})


def surrogate_ids(spark, sf):
    """Dense ids: parts under key 1000 have theirs, the rest follow on."""
    parts = a.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("key"))
    older = parts.where(F.col("key").cast("long") < 100).select((F.col("key").cast("long") + 1).alias("id"), "key")
    return surrogate_key(parts, "key", older)


def hash_keys(spark, sf):
    return a.table(spark, sf, "orders").select(
        "o_orderkey", hash_key(F.col("o_custkey"), F.col("o_orderstatus"), algo="sha256").alias("sha_key"),
        hash_key(F.lit("h_order"), F.col("o_orderkey"), algo="uuid5").alias("uuid_key"),
        hash_diff(F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit(None).cast("string")).alias("diff"),
    )


def null_safe_absent(spark, sf):
    """Events whose (user, position-or-null) was not seen among page views."""
    events = a.table(spark, sf, "events").select("event_id", "event_type", "user_id", F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 25).alias("spot"))
    views = events.where("event_type = 'view'").select("user_id", "spot")
    rest = events.where("event_type <> 'view'")
    return lookups.absent(rest, views, {"user_id": "user_id", "spot": "spot"}, null_safe=True).select("event_id")


def latest_per_key(spark, sf):
    events = a.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return windows.latest_per_key(events, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


def best_per_key(spark, sf):
    counts = a.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return windows.best_per_key(counts, ["user_id"], "n", "event_type")


def oldest_n(spark, sf):
    return windows.oldest_n(a.table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")), "day", "o_orderkey", 10)


def lowest_n(spark, sf):
    counts = a.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return windows.lowest_n(counts, "n", "o_custkey", 10)


def union_distinct(spark, sf):
    orders = a.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    shipped = a.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return sets.union_distinct(orders, shipped).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


def symmetric_pairs(spark, sf):
    talks = a.dialogs(spark, sf).select(F.col("message_from").alias("a"), F.col("message_to").alias("b"))
    return sets.symmetric_pairs(talks, "a", "b")


def pad_and_union(spark, sf):
    """Orders appended to events padded with what they lack."""
    events = a.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    orders = a.table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), F.lit("order").alias("event_type"))
    return sets.union_by_name(events, orders)


def null_token_fields(spark, sf):
    """Every fourth user id spelled as a missing value, or not a number."""
    spelled = F.element_at(F.array(*[F.lit(t) for t in ("", " <NA> ", "NULL", "x1")]), (F.col("event_id") / 4 % 4).cast("int") + 1)
    text = F.when(F.col("event_id") % 4 == 0, spelled).otherwise(F.col("user_id").cast("string"))
    return a.table(spark, sf, "events").select("event_id", null_tokens(text, dtype="long").alias("user_id"))


def clean_texts(spark, sf):
    """Whole document texts with control characters put in and cleaned out again."""
    dirty = F.concat(F.col("text"), F.lit("\x01"), F.col("lang"), F.lit("\r\n"), F.col("source"))
    cleaned = clean_text(dirty)
    return a.table(spark, sf, "documents").select("doc_id", F.length(cleaned).cast("long").alias("n"), F.md5(cleaned).alias("digest"))


#: Bytes of a split of CSV at most.
_CSV_SPLIT = 64 << 20


def dirty_csv_round_trip(spark, sf):
    """Texts with line breaks, quotes and control bytes written as quoted CSV, each file read in many splits."""
    path = work_dir(spark, "csv")
    dirty = F.concat(F.lit('say "'), F.col("text"), F.lit('"\x01'), F.col("lang"), F.lit("\r\n"), F.col("source"))
    rows = a.table(spark, sf, "documents").select("doc_id", dirty.alias("text"), "lang")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    # A session of its own reads in splits of a twentieth of the whole, or of 64 MB where that is less.
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(min(size // 20 + 1, _CSV_SPLIT)))
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string")
    read = files.read_dirty_csv(reader, path, schema, "text")
    return read.select("doc_id", "lang", F.char_length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


def pivot_counts(spark, sf):
    labels = {"view": "views", "click": "clicks", "purchase": "purchases", "signup": "signups"}
    return aggregates.pivot_counts(a.table(spark, sf, "events"), ["user_id"], "event_type", labels)


def distinct_counts(spark, sf):
    return aggregates.distinct_count(a.table(spark, sf, "orders"), ["o_orderpriority"], "o_custkey", "customers")


def sums_and_averages(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderstatus", F.col("o_totalprice").cast("decimal(19,5)").alias("price"), (F.col("o_orderkey") % 5).cast("decimal(4,2)").alias("rate"))
    out = aggregates.sum_avg(orders, ["o_orderstatus"], {"price": "total"}, {"rate": "rate_avg"})
    return out.select("o_orderstatus", F.col("total").cast("double").alias("total"), F.col("rate_avg").cast("double").alias("rate_avg"))


def first_seen(spark, sf):
    events = a.table(spark, sf, "events").select("user_id", "ts", F.col("value").alias("lat"), F.col("event_id").alias("lon"))
    return aggregates.first_seen(events, "user_id", "ts", "lat", "lon").select("user_id", "lat", "lon")


def ratio_null_safe(spark, sf):
    """Purchases per error, 0 where there are none."""
    counted = aggregates.pivot_counts(a.table(spark, sf, "events"), ["user_id"], "event_type", {"purchase": "p", "error": "e"})
    thin = F.when(F.col("user_id") % 10 == 0, F.lit(0)).otherwise(F.col("e"))
    return counted.select("user_id", F.round(ratio(F.col("p"), thin), 9).alias("rate"))


def event_times(spark, sf):
    """Event time from the first of two texts that parses; every third first text is junk."""
    good = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    first = F.when(F.col("event_id") % 3 == 0, F.lit("junk")).otherwise(good)
    second = F.when(F.col("event_id") % 2 == 0, F.lit("2024-01-01 00:00:00"))
    rows = a.table(spark, sf, "events").select("event_id", parse_time(first, second).alias("at"))
    return rows.select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def period_slice(spark, sf):
    events = a.table(spark, sf, "events").select("event_id", "ts", F.to_date("ts").alias("date"))
    inside = columns.in_period(events, "ts", "2024-01-05", "2024-01-20")
    return columns.between_dates(inside, "date", "2024-01-05", "2024-01-12").select("event_id")


def previous_month_orders(spark, sf):
    orders = a.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return columns.in_previous_month(orders, "y", "m", dt.date(1997, 1, 15)).select("o_orderkey")


def flat_messages(spark, sf):
    """Messages of the nested log, flattened, timed and checked."""
    flat = columns.flatten(
        a.geo_log(spark, sf),
        {"event_id": "event_id", "event_type": "kind", "event.message_from": "sender", "event.message_to": "recipient",
         "event.message_ts": "message_ts", "event.datetime": "datetime", "lat": "lat", "lon": "lon"},
    )
    timed = columns.with_event_time(flat, ["message_ts", "datetime"])
    valid = columns.valid_messages(timed, "kind", "lat", "lon", ["sender", "event_time"])
    return valid.select("event_id", "sender", "recipient", F.date_format("date", "yyyy-MM-dd").alias("day"))


def channel_subscriptions(spark, sf):
    """(channel, user) of subscription events, each once."""
    flat = columns.flatten(a.geo_log(spark, sf), {"event_type": "kind", "event.subscription_channel": "channel", "event.subscription_user": "subscriber"})
    return sets.dedup(columns.valid_subscriptions(flat, "kind", "channel", "subscriber"), ["channel_id", "user_id"])


def pair_balances(spark, sf):
    """Balances of the two customers an order is put between."""
    pairs = a.table(spark, sf, "orders").select(F.col("o_custkey").alias("buyer"), ((F.col("o_custkey") * 7 + F.col("o_orderkey")) % 50).alias("seller"), "o_orderkey")
    return lookups.attach_both(pairs, _customers(spark, sf).select("c_custkey", "c_acctbal"), "c_custkey", "buyer", "seller")


def order_segments(spark, sf):
    """Orders with the segment of their customer where it is BUILDING, null elsewhere; and the customer's name."""
    building = _customers(spark, sf).where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    names = _customers(spark, sf).select(F.col("c_custkey").alias("o_custkey"), "c_name")
    orders = a.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return lookups.inner_lookup(lookups.left_lookup(orders, building, "o_custkey"), names, "o_custkey")


def exploded_payments(spark, sf):
    """Payments of every bonus event, kept where the part is known."""
    parsed = a.bonus_events(spark, sf).select(F.from_json("event_value", BONUS_DOC).alias("d")).select("d.order_id", "d.product_payments")
    parts = a.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("part_id"), "p_brand")
    joined = lookups.explode_join(parsed, "product_payments", "item", parts, {"item.product_id": "part_id"})
    return joined.select("order_id", "part_id", "p_brand", F.col("item.quantity").alias("quantity"))


def largest_values(spark, sf):
    events = a.table(spark, sf, "events").select("user_id", "event_type", "value")
    return aggregates.max_by_group(events, ["user_id", "event_type"], "value")


def distinct_statuses(spark, sf):
    return aggregates.distinct_rows(a.table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


QUERIES = {
    f.__name__: f
    for f in (
        flat_messages, channel_subscriptions, pair_balances, order_segments, exploded_payments, largest_values, distinct_statuses,
        upsert_overwrite, upsert_if_changed, insert_new, additive_counters, increment_page, merge_into_files, merge_many_batches,
        incremental_runs, partition_rewrite, constraint_audit, orphan_audit, surrogate_ids, hash_keys, null_safe_absent,
        latest_per_key, best_per_key, oldest_n, lowest_n, union_distinct, symmetric_pairs, pad_and_union,
        null_token_fields, clean_texts, dirty_csv_round_trip, pivot_counts, distinct_counts, sums_and_averages, first_seen, ratio_null_safe,
        event_times, period_slice, previous_month_orders,
    )
}

_BATCH = """WITH base AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
fresh AS (SELECT c_custkey + 1000000000 AS c_custkey, c_name, c_acctbal, c_mktsegment FROM base)"""

ORACLE = {
    "flat_messages": f"""WITH {a.GEO_SQL.strip()} SELECT event_id, user_id AS sender, message_to AS recipient,
      strftime(event_time, '%Y-%m-%d') AS day FROM geo WHERE kind = 'message' AND lat IS NOT NULL""",
    "channel_subscriptions": f"""WITH {a.GEO_SQL.strip()} SELECT DISTINCT channel_id, user_id FROM geo WHERE kind = 'subscription'""",
    "pair_balances": """WITH p AS (SELECT o_custkey AS buyer, (o_custkey * 7 + o_orderkey) % 50 AS seller, o_orderkey FROM orders)
      SELECT buyer, seller, o_orderkey, b.c_acctbal AS c_acctbal_left, s.c_acctbal AS c_acctbal_right
      FROM p JOIN customer b ON b.c_custkey = buyer JOIN customer s ON s.c_custkey = seller""",
    "order_segments": """SELECT o_orderkey, o_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS c_mktsegment
      FROM orders JOIN customer ON c_custkey = o_custkey""",
    "exploded_payments": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS part_id, any_value(p_brand) AS p_brand,
      CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS quantity
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_partkey HAVING min(l_returnflag) <> 'R'""",
    "largest_values": "SELECT user_id, event_type, max(value) AS value FROM events GROUP BY ALL",
    "distinct_statuses": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
    "upsert_overwrite": f"""{_BATCH}
      SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment FROM base
      UNION ALL SELECT c_custkey, c_name, c_acctbal, 'BATCH' FROM fresh""",
    "upsert_if_changed": f"""{_BATCH}
      SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 2 <> 0 THEN 1 ELSE 0 END AS c_acctbal,
             CASE WHEN c_custkey % 2 <> 0 THEN 'BATCH' ELSE c_mktsegment END AS c_mktsegment FROM base""",
    "insert_new": f"{_BATCH} SELECT * FROM base UNION ALL SELECT * FROM fresh",
    "additive_counters": """WITH late AS (
        SELECT user_id, max_by(event_type, ts) AS event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY user_id),
      early AS (SELECT user_id, max(event_type) AS event_type FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id),
      n AS (SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id)
      SELECT user_id, cnt, coalesce(late.event_type, early.event_type) AS event_type
      FROM n LEFT JOIN late USING (user_id) LEFT JOIN early USING (user_id)""",
    "increment_page": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 1000",
    "merge_into_files": f"""{_BATCH}
      SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment FROM base
      UNION ALL SELECT * FROM fresh""",
    "merge_many_batches": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 9
        ELSE least(o_orderkey % 7 + 1, 5) END AS version, 1 AS rewritten, true AS split
      FROM orders WHERE o_orderkey % 7 <= 5 OR o_orderkey = (SELECT max(o_orderkey) FROM orders)""",
    "incremental_runs": "SELECT o_orderkey, o_totalprice FROM orders",
    "partition_rewrite": """SELECT year(o_orderdate) AS y, CAST(CASE WHEN year(o_orderdate) = 1996 THEN 1 ELSE 0 END AS BIGINT) AS version,
      count(*) AS n FROM orders GROUP BY ALL""",
    "constraint_audit": """SELECT c_custkey, concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance_not_negative' END,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'segment_known' END) AS violations
      FROM customer WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')""",
    "orphan_audit": """SELECT o_orderkey, o_custkey FROM orders
      WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')""",
    "surrogate_ids": """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS key, p_partkey FROM part)
      SELECT p_partkey + 1 AS id, key FROM p WHERE p_partkey < 100
      UNION ALL
      SELECT (SELECT max(p_partkey) + 1 FROM p WHERE p_partkey < 100) + row_number() OVER (ORDER BY substr(sha256(key), 1, 3), key), key
      FROM p WHERE p_partkey >= 100""",
    "hash_keys": f"""SELECT o_orderkey, sha256(o_custkey || '_' || o_orderstatus) AS sha_key,
      {a.uuid5_sql("('h_order_' || o_orderkey)")} AS uuid_key,
      {a.uuid5_sql("sha256(o_orderstatus || '|' || o_orderpriority || '|None')")} AS diff FROM orders""",
    "null_safe_absent": """WITH e AS (SELECT event_id, event_type, user_id, CASE WHEN event_id % 11 <> 0 THEN event_id % 25 END AS spot FROM events)
      SELECT event_id FROM e WHERE event_type <> 'view' AND NOT EXISTS (
        SELECT 1 FROM e v WHERE v.event_type = 'view' AND v.user_id = e.user_id AND v.spot IS NOT DISTINCT FROM e.spot)""",
    "latest_per_key": """SELECT user_id, event_id, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "best_per_key": """SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1""",
    "oldest_n": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY day, o_orderkey LIMIT 10",
    "lowest_n": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n, o_custkey LIMIT 10",
    "union_distinct": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders UNION SELECT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem""",
    "symmetric_pairs": """WITH t AS (SELECT user_id AS a, (user_id * 7 + event_id) % 150 AS b FROM events WHERE event_type = 'view')
      SELECT a, b FROM t UNION SELECT b, a FROM t""",
    "pad_and_union": """SELECT event_id, user_id, event_type FROM events
      UNION ALL SELECT o_orderkey, NULL, 'order' FROM orders""",
    "null_token_fields": """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN user_id END AS user_id FROM events""",
    "clean_texts": """WITH d AS (SELECT doc_id, translate(text || chr(1) || lang || chr(13) || chr(10) || source, chr(1) || chr(13) || chr(10), '   ') AS t FROM documents)
      SELECT doc_id, length(t) AS n, md5(t) AS digest FROM d""",
    "dirty_csv_round_trip": """WITH d AS (SELECT doc_id, lang, translate('say "' || text || '"' || chr(1) || lang || chr(13) || chr(10) || source, chr(1) || chr(13) || chr(10), '   ') AS t FROM documents)
      SELECT doc_id, lang, length(t) AS n, md5(t) AS digest FROM d""",
    "pivot_counts": """SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
      count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'signup') AS signups FROM events GROUP BY user_id""",
    "distinct_counts": "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL",
    "sums_and_averages": """SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(19,5))) AS DOUBLE) AS total,
      CAST((sum(o_orderkey % 5) * 200 + count(*)) // (count(*) * 2) AS BIGINT) / 100 AS rate_avg FROM orders GROUP BY ALL""",
    "first_seen": "SELECT user_id, min_by(value, ts) AS lat, min_by(event_id, ts) AS lon FROM events GROUP BY user_id",
    "ratio_null_safe": """WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'error') AS e FROM events GROUP BY ALL)
      SELECT user_id, round(CASE WHEN user_id % 10 = 0 OR e = 0 THEN 0 ELSE p / e END, 9) AS rate FROM c""",
    "event_times": """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN event_id % 2 = 0 THEN '2024-01-01 00:00:00' END AS at FROM events""",
    "period_slice": "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'",
    "previous_month_orders": "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 12",
}
