import datetime as dt
import hashlib
import math
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import documents, geo, keys, money, temporal, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_haversine_known_distance_and_antipodes(spark):
    km = geo.haversine_km(F.lit(-33.865), F.lit(151.2094), F.lit(-37.8136), F.lit(144.9631))
    assert one(spark, km) == pytest.approx(713.8, abs=1)
    far = one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert far == pytest.approx(math.pi * geo.EARTH_RADIUS_KM, rel=1e-9)


def test_uuid5_equals_the_standard_library(spark):
    names = ["", "1", "Ünïcode", "a_b", "x" * 300] + [str(i) for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", keys.uuid5(F.lit("h_user"), F.col("n")).alias("k"))
    for n, k in df.collect():
        assert k == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"h_user_{n}"))


def test_key_of_a_missing_part_is_null(spark):
    missing = F.lit(None).cast("string")
    for algo in ("xxhash64", "sha256", "uuid5"):
        assert one(spark, keys.hash_key(F.lit("a"), missing, algo=algo)) is None
        assert one(spark, keys.hash_key(F.lit("a"), F.lit("b"), algo=algo)) is not None
    with pytest.raises(ValueError):
        keys.hash_key(F.lit(1), algo="crc")


def test_hash_diff_spells_missing_values(spark):
    expected = uuid.uuid5(uuid.NAMESPACE_DNS, hashlib.sha256(b"10.50|None").hexdigest())
    assert one(spark, keys.hash_diff(F.lit("10.50"), F.lit(None).cast("string"))) == str(expected)


@pytest.mark.parametrize("token", ["", " ", "<NA>", "NA", "NULL", "null", "seventeen"])
def test_null_tokens(spark, token):
    assert one(spark, text.null_tokens(F.lit(token), dtype="int")) is None
    assert one(spark, text.null_tokens(F.lit("17"), dtype="int")) == 17


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.lit("a\x01b\x00c\rd\ne"))) == "a b c d e"


@pytest.mark.parametrize(
    "rate,total,payout",
    [("3.99", 100, 100), ("3.99", 10000, 500), ("4", 100, 150), ("4.49", 10000, 700), ("4.5", 100, 175),
     ("4.89", 10000, 800), ("4.9", 100, 200), ("4.9", 10000, 1000), (None, 100, 200)],
)
def test_payout_tiers(spark, rate, total, payout):
    got = one(spark, money.courier_payout(F.lit(Decimal(total)).cast("decimal(19,5)"), F.lit(rate).cast("decimal(4,2)")))
    assert got == Decimal(payout)


def test_ratio(spark):
    assert one(spark, money.ratio(F.lit(1136), F.lit(365))) == pytest.approx(3.1123287671232877)
    assert one(spark, money.ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, money.ratio(F.lit(None).cast("int"), F.lit(2))) == 0.0


def test_zone_of_a_city_and_local_time(spark):
    zone = temporal.city_zone(F.lit("Gold Coast"), "Australia", "Australia/Sydney")
    assert one(spark, zone) == "Australia/Sydney"
    assert one(spark, temporal.city_zone(F.lit("Broken Hill"), "Australia", "Australia/Sydney")) == "Australia/Broken_Hill"
    assert one(spark, temporal.city_zone(F.lit(None).cast("string"), "Australia", "Australia/Sydney")) == "Australia/Sydney"
    at = F.lit("2022-01-01 00:00:00").cast("timestamp")
    assert one(spark, temporal.local_time(at, F.lit("Australia/Perth"), True)) == "2022-01-01 08:00:00"


def test_previous_month_steps_over_the_year(spark):
    year, month = temporal.previous_month(dt.date(1997, 1, 15))
    assert (one(spark, year), one(spark, month)) == (1996, 12)


def test_event_time_skips_junk(spark):
    got = one(spark, temporal.parse_time(F.lit("junk"), F.lit("2022-03-01 10:00:00")))
    assert got == dt.datetime(2022, 3, 1, 10)


def test_first_status_time(spark):
    plain = '{"statuses":[{"status":"OPEN","dttm":"2022-01-01 10:00:00"},{"status":"CLOSED","dttm":"2022-01-01 11:00:00"},{"status":"CANCELLED","dttm":"2022-01-01 12:00:00"}]}'
    assert one(spark, documents.first_status_time(F.lit(plain))) == dt.datetime(2022, 1, 1, 11)
    wrapped = '{"statuses":[{"status":"CANCELLED","dttm":{"$date":"2022-01-01T11:00:00Z"}}]}'
    assert one(spark, documents.first_status_time(F.lit(wrapped))) == dt.datetime(2022, 1, 1, 11)
    millis = '{"statuses":[{"status":"CLOSED","dttm":{"$date":1641034800000}}]}'
    assert one(spark, documents.first_status_time(F.lit(millis))) == dt.datetime(2022, 1, 1, 11)
    for none in ('{"statuses":[{"status":"OPEN","dttm":"2022-01-01 10:00:00"}]}', '{"statuses":"x"}', "{}", "no json"):
        assert one(spark, documents.first_status_time(F.lit(none))) is None


def test_has_key_counts_a_json_null(spark):
    assert one(spark, documents.has_key(F.lit('{"a":null}'), "a")) is True
    assert one(spark, documents.has_key(F.lit('{"b":1}'), "a")) is False
    assert one(spark, documents.has_key(F.lit("[]"), "a")) is False


def test_canonical_json(spark):
    df = spark.createDataFrame([("x", None, dt.datetime(2022, 1, 2, 3, 4, 5))], "b string, a string, t timestamp")
    assert df.select(documents.canonical_json(df.columns)).first()[0] == '{"a":null,"b":"x","t":"2022-01-02 03:04:05"}'


def test_framed_keys_tell_parts_with_separators_apart(spark):
    rows = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("a", None), ("", "1:a")], "x string, y string")
    found = [r[0] for r in rows.select(keys.hash_key(F.col("x"), F.col("y"), algo="sha256_framed")).collect()]
    assert found == [hashlib.sha256(t.encode()).hexdigest() if t else None for t in ("3:a_b1:c", "1:a3:b_c", None, "0:3:1:a")]
    plain = [r[0] for r in rows.select(keys.hash_key(F.col("x"), F.col("y"), algo="sha256")).collect()]
    assert plain[0] == plain[1] and found[0] != found[1]


def test_packed_keys_come_back_as_they_were(spark):
    from martloom.functions.keys import packed, unpacked

    keys = [str(uuid.uuid5(uuid.NAMESPACE_DNS, "x")), str(uuid.uuid5(uuid.NAMESPACE_DNS, "x")).upper(), "", "a", "\u00e9-1", "0" * 36, "0" * 32, "f" * 16, "-" * 36, None]
    found = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed(F.col("k")).alias("p"), unpacked(packed(F.col("k"))).alias("u")).collect()
    assert [r.u for r in found] == keys and len({bytes(r.p) for r in found if r.p is not None}) == len(keys) - 1
    assert len(found[0].p) == 17 and found[-1].p is None
