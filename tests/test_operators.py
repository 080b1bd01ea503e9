from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill import registry
from shopmill.operators import combine, ingest, quality, reshape
from shopmill.operators.ingest import PART, Batch
from shopmill.operators.latest import latest_by_key

BATCH = Batch("b1", "2024-05-01 10:00:00")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- newest row per key -------------------------------------------------------------------


def brute_latest(data):
    best = {}
    low = (0,)
    for key, version, value in data:
        rank = [low if x is None else (1, x) for x in (version, value)]
        if key is not None and (key not in best or rank > best[key][0]):
            best[key] = (rank, (key, version, value))
    return sorted([b[1] for b in best.values()] + [r for r in data if r[0] is None], key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_latest_by_key_equals_brute_force_with_a_hot_key(spark, seed):
    rng = random.Random(seed)
    data = [
        (
            rng.choice(["hot", "hot", None] + list("abcdef")),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, "x", "y"]),
        )
        for _ in range(300)
    ]
    df = spark.createDataFrame(data, "k string, v int, x string").repartition(7)
    once = latest_by_key(df, ["k"], ["v"])
    assert rows(once) == brute_latest(data)
    assert rows(latest_by_key(once, ["k"], ["v"])) == rows(once)
    assert "Window" not in plan(once)


def test_latest_by_key_reads_once(spark, path):
    spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), (None, 2, "y")], "k string, v int, t string").write.parquet(path + "/t")
    newest = latest_by_key(spark.read.parquet(path + "/t"), ["k"], ["v"])
    assert newest._jdf.queryExecution().toString().split("Physical Plan")[-1].count("Scan parquet") == 1
    assert newest.count() == 3


def test_latest_by_key_refuses_maps(spark):
    df = spark.createDataFrame([("a", {"x": 1})], "k string, m map<string,int>")
    with pytest.raises(ValueError, match="map"):
        latest_by_key(df, ["k"], [])


# --- reshape ------------------------------------------------------------------------------


def test_flatten_keeps_values_on_their_rows(spark):
    data = [(1, None, None), (2, (7, (8,)), [1, 2]), (3, (9, None), [])]
    df = spark.createDataFrame(data, "id int, s struct<a:int,b:struct<c:int>>, l array<int>")
    flat = reshape.flatten_nested(df)
    assert flat.columns == ["id", "l", "s_a", "s_b_c"]
    assert rows(flat) == [(1, None, None, None), (2, "[1,2]", 7, 8), (3, "[]", 9, None)]


def test_temporal_candidates():
    names = ["order_date", "TIMESTAMP", "created_at", "changed", "LOADED_AT", "status"]
    assert reshape.temporal_candidates(names) == [
        "order_date", "TIMESTAMP", "created_at", "LOADED_AT",
    ]


def test_unparsable_column_of_unknown_table_stays_text(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "2024-01-01", None), (None, "x", None)],
        "a_date string, b_date string, c_date string",
    )
    parsed = reshape.parse_temporals(df)
    assert [t for _, t in parsed.dtypes] == ["timestamp_ntz", "string", "timestamp_ntz"]
    assert rows(parsed.select("b_date")) == [("2024-01-01",), ("x",)]
    told = reshape.parse_temporals(df, verdict={"c_date": True, "b_date": False})
    assert [t for _, t in told.dtypes] == ["string", "string", "timestamp_ntz"]


def test_registered_table_needs_no_probe_and_keeps_lenient_text(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "null")], "SIGNUP_DATE string, LAST_LOGIN string"
    )
    parsed = reshape.parse_temporals(df, "latest_customers")
    assert [t for _, t in parsed.dtypes] == ["timestamp_ntz", "string"]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, n int")
    assert rows(reshape.missing_to_null(df)) == [(2.0, None), (None, 1)]


def test_names_that_differ_by_case_clash(spark):
    with pytest.raises(ValueError, match="duplicate"):
        reshape.require_distinct_names(spark.range(1).toDF("a").select("a", F.col("a").alias("A")))


def test_normalize_temporals(spark):
    data = [
        (dt.datetime(2024, 1, 2, 3, 4, 5, 678901), 1700000000, 1700000000000, "as is", "2024-02-03 04:05:06", "no"),
        (None, None, None, None, "bad", None),
    ]
    df = spark.createDataFrame(
        data, "ts timestamp_ntz, s bigint, ms bigint, t string, d string, other string"
    )
    target = T.StructType(
        [T.StructField(n.upper(), registry.STAMP) for n in ("ts", "s", "ms", "t")]
        + [T.StructField("D", T.DateType()), T.StructField("OTHER", T.StringType())]
    )
    assert rows(reshape.normalize_temporals(df, target)) == [
        (
            "2024-01-02 03:04:05.678", "2023-11-14 22:13:20.000", "2023-11-14 22:13:20.000",
            "as is", "2024-02-03", "no",
        ),
        (None, None, None, None, None, None),
    ]


def test_registry():
    assert registry.primary_keys("latest_orders") == ("order_id",)
    assert registry.pick_date_column(["CREATED_AT", "ORDER_DATE"], "orders") == "ORDER_DATE"
    assert registry.pick_date_column(["x"], "orders") is None
    assert registry.date_columns("unknown") == ("created_at",)
    assert registry.stamp_columns(registry.staged_schema("categories")) == {
        "created_at": "timestamp", "loaded_at": "timestamp",
    }
    assert registry.storage_type(T.FloatType()) == T.DoubleType()
    assert registry.storage_type(T.ShortType()) == T.LongType()
    assert registry.storage_type(T.ArrayType(T.LongType())) == T.StringType()
    assert set(registry.TABLES) == set(registry.BUSINESS_COLUMNS) == set(registry.KEYS)


# --- combining parts ----------------------------------------------------------------------


def days(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return df.select("id", F.col("t").cast("timestamp_ntz").alias("d"))


def test_overlap_is_replaced_from_the_first_latest_day(spark):
    old = days(spark, "2024-01-01", "2024-01-05", "2024-01-09", None)
    new = days(spark, "2024-01-05", None, "2024-01-07")
    kept = combine.outside_overlap(old, new, "d")
    assert [r.id for r in kept.collect()] == [0]
    assert combine.replace_overlap(old, new, "d").count() == 4
    assert "Cartesian" not in plan(kept) and "NestedLoop" not in plan(kept)


def test_history_stays_without_latest_dates(spark):
    old, new = days(spark, "2024-01-01", None), days(spark, None)
    assert combine.outside_overlap(old, new, "d").count() == 2


def test_newer_than(spark):
    df = days(spark, "2024-01-01", "2024-01-02", None)
    assert [r.id for r in combine.newer_than(df, df.where("id = 0"), "d").collect()] == [1]
    assert combine.newer_than(df, df.where("false"), "d").count() == 2


def test_upsert_replaces_equal_keys(spark):
    old = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "a", 1)], "k int, m string, v int")
    new = spark.createDataFrame([(9, 1, "b"), (9, 3, "a")], "v int, k int, m string")
    assert rows(combine.upsert(old, new, ["k", "m"])) == [
        (1, "a", 1), (1, "b", 9), (2, "a", 1), (3, "a", 9),
    ]


# --- raw transform ------------------------------------------------------------------------


def landed(spark, *data):
    return spark.createDataFrame(list(data), "event_id string, event_date string, event_type string")


def test_latest_part_wins_a_key_collision(spark):
    old = landed(spark, ("1", "2024-01-01", "view"), ("2", "2024-01-01", "view"))
    new = landed(spark, ("1", "2024-01-01", "a"), (None, "2024-01-02", "x"), (None, "2024-01-02", "x"))
    loaded = ingest.initial_load(old, new, "interactions", BATCH)
    assert loaded.columns[-4:] == [PART, "DATA_SOURCE", "BATCH_ID", "LOADED_AT"]
    assert rows(loaded.select("EVENT_ID", "EVENT_TYPE", PART)) == [
        ("1", "a", "latest"), ("2", "view", "historic"), (None, "x", "latest"), (None, "x", "latest"),
    ]


def test_table_without_its_key_column_is_not_reduced(spark):
    df = landed(spark, ("1", None, "a"), ("1", None, "b")).drop("event_id")
    assert ingest.transform(df, "interactions", BATCH).count() == 2


def test_incremental_load_has_no_history_in_the_overlap(spark):
    old = landed(spark, ("1", "2024-01-01", "a"), ("2", "2024-01-03", "b"), ("3", None, "c"))
    new = landed(spark, ("2", "2024-01-03", "new"), ("4", "2024-01-04", "d"))
    loaded = ingest.incremental_load(old, new, "interactions", BATCH)
    assert rows(loaded.select("EVENT_ID", "EVENT_TYPE")) == [("1", "a"), ("2", "new"), ("4", "d")]
    first = loaded.where(f"{PART} = 'latest'").agg(F.min("EVENT_DATE")).first()[0]
    assert loaded.where(f"{PART} = 'historic'").where(F.col("EVENT_DATE") >= first).count() == 0


def test_batch_metadata(spark):
    old = landed(spark, ("1", "2024-01-01", "a"), ("2", "2024-01-03", "b"))
    new = landed(spark, ("2", "2024-01-02", "c"))
    loaded = ingest.initial_load(old, new, "interactions", BATCH)
    row = ingest.batch_metadata(loaded, "interactions", BATCH).first()
    assert (row.historic_records, row.latest_records, row.total_records) == (1, 1, 2)
    assert row.date_column_used == "EVENT_DATE" and row.min_date == dt.datetime(2024, 1, 1)
    assert row.data_types["EVENT_DATE"] == "timestamp_ntz" and PART not in row.columns
    extracted = ingest.tagged_parts(old, new)
    row = ingest.batch_metadata(loaded, "interactions", BATCH, extracted).first()
    assert (row.historic_records, row.latest_records, row.total_records) == (2, 1, 3)
    assert row.min_date == dt.datetime(2024, 1, 2)


# --- checks -------------------------------------------------------------------------------


@pytest.fixture
def shop(spark):
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pid string")
    child = spark.createDataFrame(
        [(1, "a"), (2, "x"), (2, "x"), (2, None), (None, "y")], "cid int, pid string"
    )
    return {"Parent": parent, "child": child}


CHECKS = [
    quality.unique("PARENT", "pid", quality.WARN),
    *quality.not_null("child", "cid", "pid"),
    quality.unique("child", "cid"),
    quality.relationship("child", "pid", "parent", "pid"),
    quality.relationship("child", "pid", "child", "pid"),
    *quality.not_null("parent", "pid"),
]


def test_violations(shop):
    assert rows(quality.unique_violations(shop["child"], "cid")) == [(2, 3)]
    assert rows(quality.null_violations(shop["child"], ["cid", "pid"])) == [("cid", 1), ("pid", 1)]
    orphans = quality.orphan_violations(shop["child"], "pid", shop["Parent"], "pid")
    assert rows(orphans) == [("x", 2), ("y", 1)]


def test_run_checks_agrees_with_single_checks(shop):
    found = {
        (r.table_name.lower(), r.column_name, r.check_name, r.status, r.violations)
        for r in quality.run_checks(shop, CHECKS).collect()
    }
    assert found == {
        ("parent", "pid", "unique", "warn", 1),
        ("parent", "pid", "not_null", "fail", 1),
        ("child", "cid", "not_null", "fail", 1),
        ("child", "pid", "not_null", "fail", 1),
        ("child", "cid", "unique", "fail", 1),
        ("child", "pid", "relationship", "fail", 3),
        ("child", "pid", "relationship", "pass", 0),
    }


def test_checks_read_each_table_once(spark, shop, path):
    """A parent that several columns refer to and that has checks of its own is one scan, too."""
    for name, frame in shop.items():
        frame.write.parquet(f"{path}/{name}")
    written = {name: spark.read.parquet(f"{path}/{name}") for name in shop}
    checks = [*CHECKS, quality.relationship("parent", "pid", "child", "pid")]
    plan = quality.run_checks(written, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == len(shop)
    found = {(r.table_name, r.check_name, r.violations) for r in quality.run_checks(written, checks[-1:]).collect()}
    assert found == {("parent", "relationship", 2)}


def test_a_hot_value_counts_as_its_rows(spark):
    child = spark.range(3000).select((F.col("id") % 1000).alias("cid"), F.when(F.col("id") % 3 > 0, "hot").alias("pid"))
    parent = spark.createDataFrame([("cold",)], "pid string")
    checks = [quality.relationship("child", "pid", "parent", "pid"), quality.unique("child", "cid"), *quality.not_null("child", "pid")]
    found = [(r.check_name, r.violations) for r in quality.run_checks({"child": child, "parent": parent}, checks).collect()]
    assert sorted(found) == [("not_null", 1000), ("relationship", 2000), ("unique", 1000)]


def test_enforce_raises_on_errors_only(shop):
    with pytest.raises(ValueError, match="child.cid"):
        quality.enforce(quality.run_checks(shop, CHECKS))
    quality.enforce(quality.run_checks(shop, CHECKS[:1]))


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], "cid int, pid string")
    results = quality.run_checks({"child": empty, "parent": empty}, CHECKS[1:5]).collect()
    assert {(r.status, r.violations) for r in results} == {("pass", 0)}
