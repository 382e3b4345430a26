import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom import schemas
from martloom.operators.merge import merge_overwrite
from martloom.session import work_dir
from martloom.sources import connectors, files, increments, sinks


def schema(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.fixture()
def lake(spark, tmp_path):
    events = spark.createDataFrame(
        [(i, dt.date(2022, 1, 1 + i % 3)) for i in range(30) if i % 3 != 1], "id int, date date"
    )
    path = str(tmp_path / "events")
    sinks.write_partitioned(events, path, ["date"])
    return path


def test_events_of_a_range_survive_a_missing_day(spark, lake):
    events = files.read_events(spark, lake, "2022-01-01", "2022-01-03")
    assert events.count() == 20
    assert files.read_events(spark, lake, "2022-01-02", "2022-01-02").count() == 0
    assert "PartitionFilters: [isnotnull(date" in events._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
    with pytest.raises(ValueError, match="2022, 1, 2"):
        files.read_events(spark, lake, "2022-01-01", "2022-01-03", require_all_days=True)


def test_sample_is_repeatable(spark, lake, tmp_path):
    events = spark.read.parquet(lake)
    for name in ("a", "b"):
        sinks.sample_to_lake(events, str(tmp_path / name), "2022-01-01", "2022-01-03", 0.5, 7)
    a, b = (sorted(r.id for r in spark.read.parquet(str(tmp_path / n)).collect()) for n in ("a", "b"))
    assert a == b and 0 < len(a) < 20


def test_partition_overwrite_leaves_the_others(spark, lake):
    one_day = spark.createDataFrame([(99, dt.date(2022, 1, 1))], "id int, date date")
    sinks.write_partitioned(one_day, lake, ["date"])
    assert spark.read.parquet(lake).count() == 11
    sinks.truncate_and_load(one_day.drop("date"), lake)
    assert spark.read.parquet(lake).count() == 1


def test_clustered_table_is_sorted(spark, tmp_path):
    path = str(tmp_path / "clustered")
    df = spark.range(100).select((F.col("id") % 2).alias("d"), (F.lit(100) - F.col("id")).alias("v"))
    sinks.clustered_table(df, path, "d", ["v"], ["v"])
    assert spark.read.parquet(path).count() == 100
    for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.collect_list("v").alias("v")).collect():
        assert r.v == sorted(r.v)


def test_reference_list(spark, tmp_path):
    (tmp_path / "geo.csv").write_text("id,city,lat,lon\n1,Sydney,-33.865,151.2094\n2,Nowhere,,\n3,Odd,NaN,1\n4,Bad,x,2\n")
    cities = files.read_reference_csv(spark, str(tmp_path / "geo.csv"), {"id": "city_id"})
    assert [(r.city_id, r.city, r.lat) for r in cities.collect()] == [("1", "Sydney", -33.865)]


def test_staging_csv(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "group_id,user_id,user_id_from,event,datetime\n1,2,,add,2022-01-01 10:00:00\n1,3,17.0,add,NULL\n1,x,null,leave,2022-01-02 10:00:00\n"
    )
    got = files.read_staging_csv(spark, str(tmp_path / "log.csv"), schema(schemas.GROUP_LOG_CSV)).collect()
    assert [(r.user_id, r.user_id_from) for r in got] == [(2, None), (3, 17), (None, None)]
    assert got[0].datetime == dt.datetime(2022, 1, 1, 10) and got[1].datetime is None


def test_dirty_csv(spark, tmp_path):
    (tmp_path / "dialogs.csv").write_bytes(
        b'message_id,message_ts,message_from,message_to,message,message_group\n'
        b'1,2022-01-01 10:00:00,5,6,"one, two\nthree\x01four",7\n'
        b'2,2022-01-01 10:00:00,5,6,short\n'
        b'3,2022-01-01 10:00:00,5,6,,\n'
        b'4,2022-01-01 10:00:00,5,6,"said ""hi""",8\n'
    )
    got = files.read_dirty_csv(spark, str(tmp_path / "dialogs.csv"), schema(schemas.DIALOGS_CSV), "message").collect()
    found = {r.message_id: (r.message, r.message_group) for r in got}
    assert found == {1: ("one, two three four", 7), 3: (None, None), 4: ('said "hi"', 8)}


def test_empty_and_literal_tables(spark):
    assert files.empty_like(spark, schemas.CITY).count() == 0
    assert files.literal_rows(spark, [(1, "c", "r")], schemas.SUBSCRIBER).first().client_id == "c"


def test_landing_skips_records_without_an_id(spark):
    raw = spark.createDataFrame([('{"order_id":"a","x":1}', "r1"), ('{"x":1}', "r1"), ('{"order_id":""}', "r2")], "value string, restaurant_id string")
    landed = increments.land_payloads(raw, ["order_id"], ["restaurant_id"], at=dt.datetime(2024, 1, 1)).collect()
    assert [(r.restaurant_id, r.object_id, r.object_value) for r in landed] == [("r1", "a", '{"order_id":"a","x":1}')]


def test_documents_increment_reads_ties_again(spark, tmp_path):
    (tmp_path / "docs.json").write_text('{"id":1,"update_ts":"2022-01-01 00:00:00"}\n{"id":2,"update_ts":"2022-01-02 00:00:00"}\n')
    got = increments.read_documents_increment(spark, str(tmp_path), "id int, update_ts timestamp", "update_ts", dt.datetime(2022, 1, 2))
    assert [r.id for r in got.collect()] == [2]


def test_watermarks_of_several_workflows(spark):
    store = increments.WatermarkStore(spark, work_dir(spark, "state"))
    assert store.get("a", "last", "-1") == "-1"
    store.save("a", {"last": 5})
    store.save("b", {"last": "2022-01-01"})
    store.save("a", {"last": 7})
    assert (store.get("a", "last", "-1"), store.get("b", "last", "-1")) == ("7", "2022-01-01")


def test_incremental_load_repeats_a_batch_whose_watermark_was_lost(spark, rows):
    base = work_dir(spark, "load")
    store = increments.WatermarkStore(spark, f"{base}/state")
    full = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")

    def write(batch):
        sinks.merge_into(spark, f"{base}/t", batch, ["id"], lambda t, s: merge_overwrite(t, s, ["id"]), full.schema, max_rows=4)

    assert increments.incremental_load(store, "t", lambda: full.where("id < 10"), "id", write) == "9"
    store.save("t", {"last_loaded": "4"})
    assert increments.incremental_load(store, "t", lambda: full, "id", write) == "19"
    assert increments.incremental_load(store, "t", lambda: full, "id", write) is None
    assert rows(sinks.read_merged(spark, f"{base}/t", full.schema)) == rows(full)


def test_increment_page(spark):
    page = increments.read_increment(spark.range(100).toDF("id"), "id", 10, 5)
    assert [r.id for r in page.collect()] == [11, 12, 13, 14, 15]


def test_kafka_options_hold_only_what_is_passed(spark):
    plain = connectors.kafka_options("host:1", "in")
    assert plain == {"kafka.bootstrap.servers": "host:1", "subscribe": "in", "startingOffsets": "earliest"}
    secure = connectors.kafka_options("host:1", "in", "u", "p")
    assert secure["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in secure["kafka.sasl.jaas.config"]
    assert connectors.sink_options(secure)["topic"] == "in" and "subscribe" not in connectors.sink_options(secure)


def test_messages_drop_columns_before_json(spark):
    df = spark.createDataFrame([(1, "a", "f")], "id int, v string, feedback string")
    assert [r.value for r in connectors.to_messages(df, ["feedback", "id"]).collect()] == ['{"v":"a"}']
    assert connectors.to_messages(df, key="id").first().key == "1"


def test_merge_into_casts_keys(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.range(1).selectExpr("id", "id AS v").schema

    def merge(rows):
        sinks.merge_into(spark, path, rows, ["id"], lambda t, s: merge_overwrite(t, s, ["id"]), schema, max_rows=100)

    merge(spark.range(1000).selectExpr("id", "id AS v"))
    merge(spark.createDataFrame([(5, 77)], "id int, v int"))
    table = {r.id: r.v for r in sinks.read_merged(spark, path, schema).collect()}
    assert len(table) == 1000 and table[5] == 77
    with pytest.raises(ValueError):
        merge(spark.createDataFrame([(None, 1)], "id long, v long"))
    assert sinks.read_merged(spark, path, schema).count() == 1000


def test_pages_lose_no_ties_and_get_further(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1), (2, 2), (2, 3), (2, 4), (3, 5)], "k int, v int")
    assert sorted(r.v for r in increments.read_increment(rows, "k", 0, 2).collect()) == [1, 2, 3, 4]
    times = [dt.datetime(2022, 1, 1)] * 25 + [dt.datetime(2022, 1, 2)] * 3
    spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id int, update_ts timestamp").write.json(str(tmp_path / "docs"))
    last, seen = dt.datetime(2021, 1, 1), set()
    for _ in range(2):
        page = increments.read_documents_increment(spark, str(tmp_path / "docs"), "id int, update_ts timestamp", "update_ts", last, 10).collect()
        seen |= {r.id for r in page}
        last = max(r.update_ts for r in page)
    assert len(seen) == 28


def test_watermarks_keep_other_settings_and_time_keys_are_closed(spark, tmp_path):
    store = increments.WatermarkStore(spark, str(tmp_path / "state"))
    store.save("w", {"a": "1"})
    store.save("w", {"b": "2"})
    assert (store.get("w", "a", ""), store.get("w", "b", "")) == ("1", "2")
    got = []
    for n in (1, 2):
        rows = spark.createDataFrame([(i, dt.datetime(2022, 1, 1)) for i in range(n)], "id int, ts timestamp")
        increments.incremental_load(store, "t", lambda rows=rows: rows, "ts", lambda b: got.append(b.count()), default="2000-01-01", key_type="timestamp")
    assert got == [1, 2]


def test_a_cluster_needs_the_shared_folder():
    from types import SimpleNamespace

    from martloom.session import work_dir

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default)))
    with pytest.raises(RuntimeError):
        work_dir(far, "x")


def test_quoted_csv_in_many_splits_equals_one_task(spark, tmp_path):
    import random

    rng = random.Random(9)
    pool = ["a", 'say ""x""', "\n", "line\r\nbreak", ",", '""', "é", " "]
    lines = ["id,text,n"] + [f'{i},"{"".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))}",{i * 2}' for i in range(400)] + ["short", ""]
    (tmp_path / "one.csv").write_bytes("\n".join(lines).encode())
    (tmp_path / "two.csv").write_bytes(b'id,text,n\r\n900,"x\ny",1\r\n901,plain,2')
    want = T.StructType().add("id", "integer").add("text", "string").add("n", "integer")
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", "300")
    split, whole = (sorted(map(tuple, files.read_dirty_csv(s, str(tmp_path), want, "text").collect())) for s in (reader, spark))
    assert files.csv_records(reader, str(tmp_path)).rdd.getNumPartitions() > 5 and split == whole
    plain = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema("id string, text string, n string").csv(str(tmp_path)).where("n is not null")
    assert [r[0] for r in split] == sorted(int(r.id) for r in plain.collect()) and len(split) == 402
    assert {r[0]: r[1] for r in split}[900] == "x y"


def test_day_folders_are_read_by_their_times(spark, tmp_path):
    base = str(tmp_path / "log")
    rows = [("2022-01-01", "2022-01-01 10:00:00"), ("2022-01-02", "2021-12-30 10:00:00"), ("2022-01-02", "2022-01-02 10:00:00"), ("2022-01-09", "2022-01-02 11:00:00"), ("2022-01-20", "2022-01-20 10:00:00"), ("2022-01-21", None)]
    events = spark.createDataFrame([(d, t) for d, t in rows], "day string, sent string").select(
        F.struct(F.col("sent").alias("datetime"), F.lit(None).cast("string").alias("message_ts")).alias("event"), F.col("day").cast("date").alias("date"))
    files.land_events(events, base)
    events.limit(1).withColumn("date", F.lit("2022-03-01").cast("date")).write.mode("append").partitionBy("date").parquet(base)  # landed without a note
    read = files.read_events_of_times(spark, base, "2022-01-02", "2022-01-03", events.schema)
    assert sorted(str(r[0]) for r in read.select("date").distinct().collect()) == ["2022-01-02", "2022-01-09", "2022-03-01"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "2022-01-20" in plan or "19012" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_dirty_csv_is_written_by_as_many_tasks_as_read_the_documents(spark, tmp_path, monkeypatch):
    from martloom.sources import files
    from martloom.workload import tables

    rows = spark.range(0, 30, 1, 3).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "line"\n'), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    seen, read = [], files.read_dirty_csv
    monkeypatch.setattr(files, "read_dirty_csv", lambda reader, path, *rest: (seen.append(len(reader.read.text(path).inputFiles())), read(reader, path, *rest))[1])
    found = tables.dirty_csv_round_trip(spark, str(tmp_path))
    assert seen == [3] and sorted(r.doc_id for r in found.collect()) == list(range(30))
