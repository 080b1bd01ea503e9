"""Every registered query against its DuckDB statement, and the shape of its plan."""

from __future__ import annotations

import re
import time
import uuid
from contextlib import contextmanager

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check
from contract.queries import warehouse
from shopmill.operators import combine
from shopmill.plans import facts, tables, transactions
from shopmill.plans.warehouse import MARTS, NORMALIZED, Warehouse
from shopmill.registry import TABLES, staged_schema

FOLDER = contract.SMOKE_DATA

# Operators that would build row pairs, gather a group in one task, leave the
# JVM, or sort everything.
BANNED = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|\bWindow\b|rangepartitioning"
    r"|PythonUDF|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups"
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def duck():
    return check.oracle(FOLDER)


#: The shop's queries; those of the training-data package have tests of their own.
OWN = {**contract.tables.QUERIES, **contract.ingest.QUERIES}


def test_every_query_has_a_statement():
    assert set(OWN) <= set(contract.oracle_sql())
    assert len(OWN) > 70


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_its_statement(spark, duck, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert not BANNED.search(plan(frame)), BANNED.search(plan(frame))
    result = duck.sql(contract.oracle_sql()[name])
    wanted = pd.DataFrame(result.fetchall(), columns=result.columns, dtype=object)
    values = [tuple(r) for r in frame.collect()]
    found = pd.DataFrame(values, columns=frame.columns, dtype=object)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert check.rows(found) == check.rows(wanted)


@pytest.mark.parametrize("mart, n", [("customers", 4), ("order_details", 14), ("sales_by_region", 5)])
def test_marts_read_written_tables_only(spark, mart, n):
    files = contract.queries()[f"marts_over_written_{mart}"](spark, FOLDER).inputFiles()
    assert all("/marts_over_written/" in f for f in files)
    assert len({f.rsplit("/", 2)[1] for f in files}) == n


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_no_broadcast_is_forced(spark):
    with settings(spark, **NO_BROADCAST):
        w = warehouse(spark, FOLDER)
        for name in [*NORMALIZED, *MARTS]:
            assert "Broadcast" not in plan(w.table(name)), name


def test_unused_joins_are_pruned(spark):
    w = warehouse(spark, FOLDER)
    by_date = plan(w.table("fct_sales_by_date"))
    assert by_date.count("FileScan") == 1 and "Join" not in by_date
    ids = plan(w.table("orders").select("order_id", "status_id"))
    assert ids.count("FileScan") == 1 and "Join" not in ids
    brands = plan(w.table("products_enriched").select("product_id", "brand_id"))
    assert brands.count("FileScan") == 1 and "Join" not in brands


def test_scans_read_only_used_columns_and_push_filters(spark):
    dates = plan(warehouse(spark, FOLDER).table("dim_dates"))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", dates)) == {
        "o_orderdate:timestamp_ntz", "ts:timestamp_ntz",
    }
    newer = plan(contract.queries()["newer_than_orders"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_orderdate,ScalarSubquery", newer)


def test_no_distinct_aggregate_expands_rows(spark):
    w = warehouse(spark, FOLDER)
    for name in MARTS:
        assert "Expand" not in plan(w.table(name)), name


def shuffles_above(text, column):
    """How often the rows of the one scan that reads a column are shuffled."""
    lines = text.splitlines()
    (at,) = [i for i, line in enumerate(lines) if "FileScan" in line and f"{column}#" in line]
    depth, found = re.search(r"[A-Z]", lines[at]).start(), 0
    for line in reversed(lines[:at]):
        own = re.search(r"[A-Z]", line).start()
        if own < depth:
            depth, found = own, found + ("Exchange" in line)
    return found


def test_lines_are_shuffled_once_by_order(spark):
    """For order and scores alike, and once more for the product; products and units of an order in one go."""
    with settings(spark, **NO_BROADCAST):
        w = warehouse(spark, FOLDER)
        assert shuffles_above(plan(w.table("order_items")), "l_extendedprice") == 2
        assert shuffles_above(plan(w.table("orders")), "l_quantity") == 1
        details = w.table("fct_order_details").select("order_id", "quantity", "item_total", "email", "product_name", "review_score")
        assert shuffles_above(plan(details), "l_quantity") == 2


def test_lines_are_bucketed_by_order_without_a_shuffle_of_their_own(spark, path):
    """Of an incremental run's tables lines are bucketed, in the shuffle that gave them their order."""
    layer = f"mark_and_buckets_{uuid.uuid4().hex}"
    tables.create_layers(spark, path, [layer])
    with settings(spark, **NO_BROADCAST):
        w = warehouse(spark, FOLDER)
        built = w.table("order_items").repartition(4, "order_id")  # as many as shuffles have here
        assert shuffles_above(plan(built), "l_extendedprice") == 2
        tables.refresh(w.table, layer, ["orders", "order_items"], 4, by_mark=True)
        orders, lines = (spark.table(f"`{layer}`.{n}") for n in ("orders", "order_items"))
        assert combine.MARK_DAY in orders.columns and combine.MARK_DAY not in lines.columns
        assert rows(lines) == rows(w.table("order_items"))
        new = facts.new_customer_orders(orders, lines, w.staged("reviews"), orders.where("order_date < '2001-05-01'"))
        assert shuffles_above(plan(new), "quantity") == 0
        assert rows(new) == rows(w.table("fct_customer_orders").where("order_date >= '2001-05-01'"))


def test_lines_of_monthly_sales_are_shuffled_by_order_and_twice_by_product(spark):
    """Orders of a product and month are counted as they lie by order, without a shuffle that tells them apart."""
    with settings(spark, **NO_BROADCAST):
        w = warehouse(spark, FOLDER)
        for name in ("fct_product_performance", "fct_sales_by_product"):
            assert shuffles_above(plan(w.table(name)), "l_quantity") == 3, name


@pytest.mark.parametrize("name", ["checks_marts", "checks_normalized"])
def test_a_checked_layer_leaves_no_shuffles_behind(spark, name):
    """Its tables are whole, compressed by zstd, and the shuffles that made them are gone before they are checked."""

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept, before = spark.conf.get(key), shuffles()
    checked = contract.queries()[name](spark, FOLDER)
    until = time.monotonic() + 30
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(key) == kept
    files = checked.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    layer = MARTS if name == "checks_marts" else NORMALIZED
    folders = {f.rsplit("/", 1)[0] for f in files}
    assert {f.rsplit("/", 1)[1] for f in folders} == set(layer)
    for folder in folders:
        table = folder.rsplit("/", 1)[1]
        assert spark.read.parquet(folder).columns == warehouse(spark, FOLDER).table(table).columns


def test_derived_reviews_are_shuffled_once_by_order(spark):
    """Their join with the orders leaves them where sums and scores of an order need them."""
    with settings(spark, **NO_BROADCAST):
        reviews = warehouse(spark, FOLDER).staged("reviews")
        for build in (transactions.reviews_per_order, transactions.scores_per_order):
            assert shuffles_above(plan(build(reviews)), "l_linenumber") == 1


def _skewed_warehouse(spark, n=60_000):
    """A third of all lines, reviews and events on one product and one customer."""

    def full(table, df):
        names = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in staged_schema(table).fields
            ]
        )

    ids = spark.range(0, n, 1, 8).withColumn("product_id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997))
    ids = ids.withColumn("customer_id", F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 499))
    pad = F.repeat(F.lit("x"), 40)
    frames = {
        "products": spark.range(997).select(
            F.col("id").alias("product_id"), F.concat(F.lit("c"), F.col("id") % 5).alias("category_id"),
            F.lit("b").alias("brand"), pad.alias("product_name"),
        ),
        "categories": spark.range(5).select(
            F.concat(F.lit("c"), F.col("id")).alias("category_id"), F.lit("n").alias("category_name")
        ),
        "subcategories": spark.range(1).select(F.lit("s").alias("subcategory_id")),
        "customers": spark.range(499).select(
            F.col("id").alias("customer_id"), F.lit("a").alias("city"), F.lit("b").alias("state"),
            F.lit("c").alias("country"), pad.alias("email"),
        ),
        "orders": ids.select(
            F.col("id").alias("order_id"), "customer_id", F.lit("2001-01-01").alias("order_date"),
            pad.alias("shipping_address"), F.lit(1).alias("total_amount"),
        ),
        "order_items": ids.select(
            F.col("id").alias("order_item_id"), F.col("id").alias("order_id"), "product_id",
            F.lit(1).alias("quantity"), F.lit(1).alias("total_price"),
        ),
        "reviews": ids.select(
            F.col("id").alias("review_id"), F.col("id").alias("order_id"), "product_id", "customer_id",
            F.lit(3).alias("review_score"), pad.alias("review_text"), F.lit("2001-01-01").alias("loaded_at"),
        ),
        "interactions": ids.select(
            F.col("id").alias("event_id"), "customer_id", "product_id", F.lit("view").alias("event_type"),
            F.lit("2001-01-01").alias("event_date"), pad.alias("session_id"),
        ),
    }
    assert set(frames) == set(TABLES)
    return Warehouse(lambda t: full(t, frames[t]), "2001-08-01", newest=False)


SPLIT = {
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "50KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    # small test data: leave enough map tasks to split by
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.mark.parametrize(
    "name", ["order_items", "customer_interactions", "reviews_enriched", "fct_customer_reviews", "fct_order_details"]
)
def test_hot_keys_are_split_in_joins(spark, name):
    with settings(spark, **NO_BROADCAST, **SPLIT):
        df = _skewed_warehouse(spark).table(name)
        assert df.collect()
        assert "skew=true" in plan(df)


def test_a_hot_street_is_split(spark):
    """A third of all orders ship to one street, which is known under several addresses."""
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    place = F.when(F.col("id") % 2 == 0, " Main St, Rome, S1, X").otherwise(" Main St, 1234, Rome, S1, X")
    orders = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("order_id"), F.concat(number, F.lit(" Main St")).alias("shipping_address"),
        F.concat(F.col("id") % 997, place).alias("billing_address"),
    )
    with settings(spark, **NO_BROADCAST, **SPLIT):
        df = transactions.order_addresses(orders)
        found = df.collect()
        assert "skew=true" in plan(df)
    assert len(found) == 60_000 and all(r.shipping_city == "Rome" for r in found)
    assert sum(r.shipping_street == "0 Main St" for r in found) == 20_000 + sum(1 for i in range(0, 60_000, 997) if i % 3)
    assert len({r.shipping_address_id for r in found if r.shipping_street == "0 Main St"}) == 1
