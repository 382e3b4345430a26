import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from martloom.operators import columns, lookups, merge, pairs, quality, sets, spatial, windows
from martloom.operators.surrogate import surrogate_key

TARGET = "k int, a string, b int"


def km(p, q):
    la, lo, lb, lp = map(math.radians, (*p, *q))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", 3)], TARGET)


def test_merge_overwrite(spark, rows, target):
    batch = spark.createDataFrame([(1, "new", 9, 1), (1, "newer", 8, 2), (4, "four", 4, 1), (2, "two", None, 1)], TARGET + ", seq int")
    merged = merge.merge_overwrite(target, batch, ["k"], ["a"], ["seq"])
    assert rows(merged) == [(1, "newer", 1), (2, "two", 2), (3, "z", 3), (4, "four", 4)]
    again = merge.merge_overwrite(merged, batch, ["k"], ["a"], ["seq"])
    assert rows(again) == rows(merged)


def test_merge_overwrite_keeps_a_null_that_arrives(spark, rows, target):
    batch = spark.createDataFrame([(1, None, 5)], TARGET)
    assert rows(merge.merge_overwrite(target, batch, ["k"]))[0] == (1, None, 5)


def test_merge_if_changed(spark, rows, target):
    batch = spark.createDataFrame([(1, "x", 100), (2, "y", 200), (5, "v", 5)], TARGET)
    merged = merge.merge_if_changed(target, batch, ["k"], ["a"])
    assert rows(merged) == [(1, "x", 1), (2, "y", 200), (3, "z", 3), (5, "v", 5)]


def test_insert_new(spark, rows, target):
    batch = spark.createDataFrame([(3, "other", 0), (6, "b", 2), (6, "a", 1)], TARGET)
    once = merge.insert_new(target, batch, ["k"], ["b"])
    assert rows(once)[-1] == (6, "a", 1) and once.count() == 4
    assert rows(merge.insert_new(once, batch, ["k"], ["b"])) == rows(once)
    assert rows(merge.new_rows(target.limit(0), batch, ["k"], ["b"])) == [(3, "other", 0), (6, "a", 1)]


def test_merge_add(spark, rows, target):
    batch = spark.createDataFrame([(1, "p", 5, 1), (1, "q", 6, 2), (7, "n", 1, 1)], TARGET + ", at int")
    merged = merge.merge_add(target, batch, ["k"], ["b"], ["a"], "at")
    assert rows(merged) == [(1, "q", 12), (2, None, 2), (3, "z", 3), (7, "n", 1)]


def test_merge_into_an_empty_target(spark, rows, target):
    assert rows(merge.merge_overwrite(target.limit(0), target, ["k"])) == rows(target)


def test_surrogate_keys_are_dense_and_stable(spark):
    first = surrogate_key(spark.createDataFrame([(f"k{i}",) for i in range(50)] + [(None,), ("k1",)], "key string"), "key")
    ids = {r["key"]: r["id"] for r in first.collect()}
    assert sorted(ids.values()) == list(range(1, 51))
    stored = spark.createDataFrame(list(ids.items()), "key string, id long")
    more = surrogate_key(spark.createDataFrame([(f"k{i}",) for i in range(60)], "key string"), "key", stored)
    later = {r["key"]: r["id"] for r in more.collect()}
    assert all(later[k] == v for k, v in ids.items()) and sorted(later.values()) == list(range(1, 61))


def test_numbered_steps_equals_one_window(spark):
    start = dt.datetime(2022, 1, 1)
    data = [(u, start + dt.timedelta(minutes=37 * i % 3000), i) for u in (1, 2) for i in range(200)]
    df = spark.createDataFrame(data, "u int, ts timestamp, id int")
    got = {(r.u, r.id): r.step for r in windows.numbered_steps(df, ["u"], "ts", "id", "step").collect()}
    for u in (1, 2):
        expected = sorted((row for row in data if row[0] == u), key=lambda r: (r[1], r[2]))
        assert [got[(u, row[2])] for row in expected] == list(range(1, 201))


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = windows.latest_per_key(df, ["k"], "id", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_absent_with_nulls(spark, rows):
    left = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int")
    right = spark.createDataFrame([(1, None), (9, 9)], "a int, b int")
    on = {"a": "a", "b": "b"}
    assert len(rows(lookups.absent(left, right, on))) == 3
    assert rows(lookups.absent(left, right, on, null_safe=True)) == [(2, 5), (None, None)]
    assert rows(lookups.present(left, right, on, null_safe=True)) == [(1, None)]


def test_explode_join_and_attach(spark, rows):
    docs = spark.createDataFrame([(1, [(10,), (20,)]), (2, [])], "id int, items array<struct<p:int>>")
    dim = spark.createDataFrame([(10, "ten")], "product int, name string")
    assert rows(lookups.explode_join(docs, "items", "item", dim, {"item.p": "product"}), "id", "name") == [(1, "ten")]
    pair = spark.createDataFrame([(1, 2)], "l int, r int")
    where = spark.createDataFrame([(1, 0.5), (2, 1.5)], "u int, lat double")
    assert rows(lookups.attach_both(pair, where, "u", "l", "r"), "l", "r", "lat_left", "lat_right") == [(1, 2, 0.5, 1.5)]


def test_constraints_and_required_columns(spark, rows):
    df = spark.createDataFrame([(1, -1), (2, 1), (3, None)], "id int, cost int")
    checked = quality.check_constraints(df, {"cost_positive": F.col("cost") >= 0, "cost_known": F.col("cost").isNotNull()})
    good, bad = quality.split_checked(checked)
    assert rows(good) == [(2, 1)]
    assert rows(bad, "id", "violations") == [(1, ["cost_positive"]), (3, ["cost_known"])]
    nested = df.select(F.struct("id").alias("s"))
    quality.require_columns(nested, ["s.id"])
    with pytest.raises(ValueError, match="s.no"):
        quality.require_columns(nested, ["s.no"])


def test_small_columns_operators(spark, rows):
    df = spark.createDataFrame([(1, 100, 200), (2, 150, 160)], "id int, s long, e long")
    assert rows(columns.active_now(df, "s", "e", 200), "id") == [(1,)]
    assert rows(columns.active_now(df, "s", "e", 155), "id") == [(1,), (2,)]
    log = spark.createDataFrame([("add", 5), ("leave", 6)], "event string, by int")
    assert rows(log.select(columns.inviter_on_add(F.col("event"), F.col("by")))) == [(5,), (None,)]
    assert columns.rename_drop(df, {"s": "start"}, ["e"]).columns == ["id", "start"]
    assert rows(sets.union_by_name(df, df.select("id")))[1] == (1, None, None)


def _grid_points(spark):
    spots = [(-37.8, 144.9), (-33.8, 151.2), (0.0, 179.95), (89.9, 10.0), (-89.9, -170.0), (10.0, -179.95), (-25.3, 131.0), (51.5, 0.1)]
    points = [(i, lat, lon) for i, (lat, lon) in enumerate(spots)] + [(90, None, 1.0), (91, float("nan"), 1.0)]
    return points, spark.createDataFrame(points, "event_id int, lat double, lon double")


def _centres(spark):
    spots = [(1, -37.8136, 144.9631), (2, -33.865, 151.2094), (3, 0.0, -179.9), (4, 85.0, -60.0), (5, -80.0, 0.0), (6, 48.9, 2.35)]
    return spots, spark.createDataFrame(spots, "id int, c_lat double, c_lon double")


@pytest.mark.parametrize("limit", [200, 2])
def test_nearest_centre_both_forms_equal_brute_force(spark, limit):
    points, df = _grid_points(spark)
    spots, centres = _centres(spark)
    got = spatial.nearest_centre(df, centres.withColumn("zone", F.col("id")), "id", ["zone"], distance="km", list_limit=limit)
    found = {r.event_id: (r.zone, r.km) for r in got.collect()}
    expected = {}
    for i, lat, lon in points[:-2]:
        best = min(spots, key=lambda c: (km((lat, lon), c[1:]), c[0]))
        expected[i] = (best[0], km((lat, lon), best[1:]))
    assert {i: z for i, (z, _) in found.items()} == {i: z for i, (z, _) in expected.items()}
    for i, (_, distance) in expected.items():
        assert found[i][1] == pytest.approx(distance, abs=1e-6)


@pytest.mark.parametrize("limit", [200, 2])
def test_nearest_centre_in_a_box_keeps_or_drops_the_rest(spark, limit):
    _, df = _grid_points(spark)
    _, centres = _centres(spark)
    named = centres.withColumn("zone", F.col("id"))
    inner = spatial.nearest_centre(df, named, "id", ["zone"], box_degrees=0.1, list_limit=limit)
    assert {r.event_id: r.zone for r in inner.collect()} == {0: 1, 1: 2}
    left = spatial.nearest_centre(df, named, "id", ["zone"], box_degrees=0.1, keep_unmatched=True, list_limit=limit)
    assert sum(r.zone is None for r in left.collect()) == 8 and left.count() == 10


@pytest.mark.parametrize("limit", [200, 2])
@pytest.mark.parametrize("degrees", [None, 0.1])
def test_nearest_centre_with_repeated_and_null_keys(spark, limit, degrees):
    df = spark.createDataFrame([(1, -37.8, 144.9), (1, -33.8, 151.2), (None, -37.8, 144.9), (None, -37.8, 144.9)], "event_id int, lat double, lon double")
    got = spatial.nearest_centre(df, _centres(spark)[1].withColumn("zone", F.col("id")), "id", ["zone"], box_degrees=degrees, list_limit=limit)
    assert sorted((r.event_id or 0, r.lat, r.zone) for r in got.collect()) == [(0, -37.8, 1), (0, -37.8, 1), (1, -37.8, 1), (1, -33.8, 2)]


def test_nearest_centre_without_centres(spark):
    _, df = _grid_points(spark)
    none = _centres(spark)[1].limit(0)
    assert spatial.nearest_centre(df, none, "id", ["c_lat"]).count() == 0
    assert spatial.nearest_centre(df, none, "id", ["c_lat"], keep_unmatched=True).count() == 10


@pytest.mark.parametrize("inclusive", [True, False])
def test_box_join_edges(spark, rows, inclusive):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.5, 0.5), (3, 0.75, 0.0)], "p int, lat double, lon double")
    centres = spark.createDataFrame([(9, 0.25, 0.25)], "c int, c_lat double, c_lon double")
    got = rows(spatial.box_join(points, centres, 0.25, "left", inclusive), "p", "c")
    assert got == ([(1, 9), (2, 9), (3, None)] if inclusive else [(1, None), (2, None), (3, None)])


@pytest.mark.parametrize("split", [20_000, 3])
def test_close_pairs_equal_brute_force(spark, rows, split):
    members = [(g, u, -33.0 + (u * 7 % 23) * 0.004, 151.0 + (u * 5 % 19) * 0.004) for u in range(60) for g in (u % 3, 7)]
    # A hot spot: twenty members at one place of one group; and two on either side of the date line.
    members += [(7, 100 + i, 10.0, 20.0) for i in range(20)] + [(7, 200, 0.0, 179.999), (7, 201, 0.0, -179.999)]
    df = spark.createDataFrame(members, "g int, u long, lat double, lon double")
    expected = {
        (a[1], b[1])
        for a, b in itertools.product(members, members)
        if a[0] == b[0] and a[1] < b[1] and km(a[2:], b[2:]) <= 1.0
    }
    got = rows(pairs.close_pairs(df, ["g"], "u", 1.0, carry=["lat"], rows_per_split=split), "u_left", "u_right")
    assert got == sorted(expected, key=repr) and len(got) > 200


def test_pairs_of_a_crowd_are_found_once_and_never_moved(spark, rows):
    """Members that share many channels at one place are many pairs, each found once; cells of many small groups, and members of several places, go by group."""
    crowd = [(g, u, 10.0, 20.0 + u % 2 * 0.001) for u in range(40) for g in range(u % 4, 9)]
    found = pairs.close_pairs(spark.createDataFrame(crowd, "g int, u long, lat double, lon double"), ["g"], "u", 1.0, carry=["lon"])
    assert rows(found, "u_left", "u_right") == sorted(((a, b) for a in range(40) for b in range(a + 1, 40)), key=repr)
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    mixed = crowd + [(100 + u // 2, 100 + u, -5.0, 6.0) for u in range(30)] + [(50, 0, -5.0, 6.0), (50, 100, -5.0, 6.0), (None, 1, -5.0, 6.0), (None, 2, -5.0, 6.0)]
    want = {(a[1], b[1]) for a, b in itertools.product(mixed, mixed) if a[0] is not None and a[0] == b[0] and a[1] < b[1] and km(a[2:], b[2:]) <= 1.0}
    rows_ = spark.createDataFrame(mixed, "g int, u long, lat double, lon double")
    for groups in (["g"], ["g", "h"]):
        got = pairs.close_pairs(rows_.withColumn("h", F.col("g") + 1), groups, "u", 1.0, rows_per_split=7)
        assert rows(got, "u_left", "u_right") == sorted(want, key=repr) and (0, 100) in want and (100, 101) in want


def test_members_of_pairs_are_never_broadcast(spark):
    members = spark.range(200).select((F.col("id") % 2).alias("g"), F.col("id").alias("u"), F.lit(10.0).alias("lat"), (F.col("id") * 1e-3).alias("lon"))
    plan = pairs.close_pairs(members, ["g"], "u", 1.0)._jdf.queryExecution().sparkPlan().toString()
    met = [line for line in plan.splitlines() if "Join" in line and "_row" in line and "_column" in line]
    assert met and all("SortMergeJoin" in line for line in met)


def test_exclude_pairs_in_both_directions(spark, rows):
    found = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    talked = spark.createDataFrame([(2, 1), (1, 3), (1, 3)], "a long, b long")
    assert rows(pairs.exclude_pairs(found, talked, "a", "b")) == [(2, 3)]


def test_changes_of_a_value_over_slices(spark):
    import random

    rng = random.Random(2)
    data = [(rng.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 600)), i, rng.choice([None, "x", "y"])) for i in range(300)] + [(None, None, 900, "x"), ("a", None, 901, "x")]
    found = windows.changes(spark.createDataFrame(data, "k string, ts timestamp, id int, v string"), ["k"], "ts", "id", "v")
    wanted, last = [], {}
    for k, ts, i, v in sorted(data, key=lambda r: (r[1] is not None, r[1] or dt.datetime(1, 1, 1), r[2])):
        if k not in last or last[k] != v:
            wanted.append(i)
        last[k] = v
    assert sorted(r.id for r in found.collect()) == sorted(wanted)


def test_a_crowded_cell_is_cut_into_blocks_and_loses_no_pair(spark, rows):
    members = spark.range(60).select(F.lit(1).alias("g"), F.col("id").alias("m"), (F.col("id") * 1e-4).alias("lat"), F.lit(10.0).alias("lon"))
    whole = pairs.close_pairs(members, ["g"], "m", 1.0)
    cut = pairs.close_pairs(members, ["g"], "m", 1.0, rows_per_split=4)
    assert rows(cut) == rows(whole) and whole.count() > 1000


def test_numbered_steps_spread_a_hot_hour(spark):
    from pyspark.sql import Window

    hot = spark.range(2000).select(F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 5 > 0, 2).alias("u"), F.timestamp_seconds(F.lit(1e9) + F.col("id") % 600).alias("ts"), "id")
    found = windows.numbered_steps(hot, ["u"], "ts", "id", "step", ranges=10)
    want = hot.withColumn("step", F.row_number().over(Window.partitionBy("u").orderBy("ts", "id")))
    assert found.count() == 2000 and found.exceptAll(want.select(*found.columns)).count() == 0


def test_nearest_of_many_centres_clustered_sparse_and_equal(spark):
    """Three crowds far apart, lone centres, centres at one place, at a pole and at the date line; points near, far and between."""
    import random

    r = random.Random(3)
    spots = [(r.gauss(-33.8, 0.01), r.gauss(151.2, 0.01)) for _ in range(300)] + [(r.gauss(48.9, 2.0), r.gauss(2.3, 2.0)) for _ in range(200)]
    spots += [(0.0, 179.99 + i / 1000) for i in range(30)] + [(89.99, 12.0 * i) for i in range(30)] + [(-33.8, 151.2)] * 40 + [(-80.0, 5.0), (10.0, -100.0)]
    spots = [(i, lat, lon) for i, (lat, lon) in enumerate(spots)]
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(150)] + [(r.gauss(-33.8, 0.05), r.gauss(151.2, 0.05)) for _ in range(100)]
    points += [(0.0, -179.99), (0.0, 180.0), (90.0, 0.0), (-90.0, 0.0), (-33.8, 151.2), (100.0, 200.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "event_id int, lat double, lon double")
    centres = spark.createDataFrame(spots, "id int, c_lat double, c_lon double").withColumn("zone", F.col("id"))
    got = {x.event_id: x for x in spatial.nearest_centre(df, centres, "id", ["zone"], distance="km").collect()}
    assert len(got) == len(points)
    for i, p in enumerate(points):
        least = min(km(p, c[1:]) for c in spots)
        assert got[i].km == pytest.approx(least, abs=1e-3)
        if i < 250 or p == (-33.8, 151.2):
            assert got[i].zone == min(c[0] for c in spots if km(p, c[1:]) <= least + 1e-9)
