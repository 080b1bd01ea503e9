from __future__ import annotations

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopmill.functions import numbers, temporal
from shopmill.functions.keys import key_if_present, surrogate_key
from shopmill.functions.text import address_head, address_part, filled, has_parts, place_text

ADDRESSES = {
    "12 Main St": ("", "12 Main St", "", "12 Main St"),
    "a, b": ("b", "", "a", "b"),
    "a, b, c": ("", "a", "b", "c"),
    "a, b, c, d": ("a", "b", "c", "d"),
    "1 Rd, 999, C, S, X": ("999", "C", "S", "X"),
    "1 Rd, Apt 2, 999, C, S, X": ("999", "C", "S", "X"),
    "": ("", "", "", ""),
}


def expected_part(text, back):
    parts = text.split(",")
    position = len(parts) - back
    if position > 0:
        return parts[position - 1].strip(" ")
    if position < 0 and -position <= len(parts):
        return parts[position].strip(" ")
    return ""


def parts_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    a = F.col("a")
    found = df.select(
        "a",
        F.array(*[address_part(a, k) for k in (3, 2, 1, 0)]).alias("parts"),
        F.array(*[address_part(place_text(a), k) for k in (2, 1, 0)]).alias("place"),
        address_head(a).alias("head"),
        has_parts(a).alias("many"),
    )
    return {r.a: r for r in found.collect()}


def test_address_parts_of_known_texts(spark):
    found = parts_of(spark, ADDRESSES)
    assert {a: tuple(r.parts) for a, r in found.items()} == ADDRESSES


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab, ", max_size=12), min_size=1, max_size=60))
def test_address_parts_of_any_text(spark, texts):
    for text, row in parts_of(spark, set(texts)).items():
        assert row.parts == [expected_part(text, k) for k in (3, 2, 1, 0)]
        assert row.place == row.parts[1:]
        assert row.head == text.split(",")[0].strip(" ")
        assert row.many == ("," in text)


def test_null_address_has_no_parts(spark):
    row = parts_of(spark, [None])[None]
    assert row.parts == [None] * 4 and row.head is None


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    found = df.select(
        surrogate_key("x", "y").alias("both"), key_if_present(F.col("x")).alias("one")
    ).collect()

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert found[0].both == md5("a-1") and found[0].one == md5("a")
    assert found[1].both == md5("_dbt_utils_surrogate_key_null_-2") and found[1].one is None


def test_filled(spark):
    df = spark.createDataFrame([("a",), ("  ",), ("",), ("\t",), (None,)], "x string")
    assert [r.f for r in df.select(filled(F.col("x")).alias("f")).collect()] == [
        True, False, False, True, False,
    ]


STAMPS = {
    "2024-01-01": dt.datetime(2024, 1, 1),
    "2024-01-01 10:11:12.123456": dt.datetime(2024, 1, 1, 10, 11, 12, 123456),
    "2024-01-01T10:11:12Z": dt.datetime(2024, 1, 1, 10, 11, 12),
    "1700000000": dt.datetime(2023, 11, 14, 22, 13, 20),
    "1700000000123": dt.datetime(2023, 11, 14, 22, 13, 20, 123000),
    "03/02/2024 10:11": dt.datetime(2024, 2, 3, 10, 11),
    "5 Jan 2024": dt.datetime(2024, 1, 5),
    "20240105": dt.datetime(2024, 1, 5),
    "": None,
    "null": None,
    "x": None,
}


def test_lenient_stamps_in_any_zone(spark):
    df = spark.createDataFrame([(t,) for t in STAMPS], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found = df.select("t", temporal.lenient_stamp(F.col("t")).alias("s")).collect()
            assert {r.t: r.s for r in found} == STAMPS
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_iso_millis_cuts_and_needs_no_zone(spark):
    df = spark.createDataFrame(
        [("2024-03-10 02:30:00.1239",), ("2024-03-10 02:30:00",), (None,)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = [r.m for r in df.select(temporal.iso_millis(F.col("t")).alias("m")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == ["2024-03-10 02:30:00.123", "2024-03-10 02:30:00.000", None]


def test_epoch_numbers(spark):
    df = spark.createDataFrame([(1700000000.5,), (1700000000123.0,), (0.0,), (-1.0,)], "n double")
    found = [r.s for r in df.select(temporal.epoch_stamp(F.col("n")).alias("s")).collect()]
    assert found == [
        dt.datetime(2023, 11, 14, 22, 13, 20, 500000),
        dt.datetime(2023, 11, 14, 22, 13, 20, 123000),
        dt.datetime(1970, 1, 1),
        dt.datetime(1969, 12, 31, 23, 59, 59),
    ]


def test_calendar(spark):
    days = [dt.datetime(2024, 2, 29, 23, 59), dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    d = F.col("d")
    found = df.select(
        temporal.iso_weekday(d).alias("w"),
        temporal.month_start(d).alias("s"),
        temporal.month_end(d).alias("e"),
    ).collect()
    assert [r.w for r in found] == [d.isoweekday() for d in days]
    assert [r.s for r in found] == [d.date().replace(day=1) for d in days]
    assert [r.e for r in found] == [dt.date(2024, 2, 29), dt.date(2023, 12, 31), dt.date(2024, 1, 31)]


def test_ratios_and_means(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, 0)], "a int, b int")
    found = df.select(
        numbers.ratio(F.col("a"), F.col("b")).alias("r"),
        numbers.ratio_or_zero(F.col("a"), F.col("b")).alias("z"),
    ).collect()
    assert [(r.r, r.z) for r in found] == [(0.5, 0.5), (None, 0.0), (None, 0.0)]
    assert df.agg(numbers.mean(F.col("a")).alias("m")).first().m == 2.0
    assert df.where("false").agg(numbers.mean(F.col("a")).alias("m")).first().m is None


def test_repeated_units_exceed_64_bits(spark):
    from shopmill.plans.transactions import repeated

    df = spark.createDataFrame([(10**12, 10**11), (5, None), (None, 7)], "u bigint, n bigint")
    found = df.select(repeated(F.col("u"), F.col("n")).alias("x")).collect()
    assert [r.x and int(r.x) for r in found] == [10**23, 5, None]
