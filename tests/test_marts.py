"""Normalized and mart builders against plain SQL over small staged tables.

The tables hold what the derived data lacks: NULL keys, unknown products and
customers, blank names, repeated reviews, and one customer, product, order and
place with about a third of all rows.
"""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from check import rows as frame_rows
from contract import oracle
from shopmill.plans import facts, tables, transactions
from shopmill.plans.warehouse import MARTS, NORMALIZED, VARIANTS, Warehouse
from shopmill.registry import TABLES, staged_schema

AS_OF = "2001-08-01"
LOADED = dt.datetime(2001, 8, 1)


def skewed(rng, hot, values):
    """The hot value in about a third of all draws."""
    return hot if rng.random() < 0.34 else rng.choice(values)


def stamp(rng, first, span):
    return dt.datetime.combine(first, dt.time()) + dt.timedelta(hours=rng.randrange(span * 24))


def money(rng):
    return Decimal(rng.randrange(1, 100000)) / 100


def generate(seed: int) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    categories = [f"c{i}" for i in range(5)]
    products = [f"p{i}" for i in range(25)]
    customers = [f"u{i}" for i in range(30)]
    orders = [f"o{i}" for i in range(80)]
    cities, states, lands = ["Rome", " Oslo ", "Bern", "", None], ["S1", "S2", " "], ["X", "Y"]

    def address():
        street = f"{rng.randrange(6)} Main St"
        shape = rng.random()
        if shape < 0.1:
            return None
        if shape < 0.4:
            return street
        place = f"{skewed(rng, 'Rome', ['Oslo', '', 'Bern'])}, {rng.choice(['S1', 'S2'])}, {rng.choice(lands)}"
        return f"{street}, {place}" if shape < 0.6 else f"{street}, {rng.randrange(3)}, {place}"

    rows = {
        "categories": [
            {"category_id": c, "category_name": f"Category {c}", "created_at": LOADED}
            for c in categories[:-1]
        ],
        "subcategories": [
            {
                "subcategory_id": f"s{i}",
                "category_id": rng.choice([*categories[:3], None]),
                "subcategory_name": f"Sub {i}",
            }
            for i in range(9)
        ],
        "products": [
            {
                "product_id": p,
                "category_id": skewed(rng, "c0", [*categories, None]),
                "subcategory_id": rng.choice([f"s{i}" for i in range(11)] + [None]),
                "product_name": f"Product {p}",
                "brand": rng.choice(["B1", " B1 ", "B2", "  ", None]),
                "base_price": money(rng),
                "is_active": rng.random() < 0.5,
            }
            for p in products
        ],
        "customers": [
            {
                "customer_id": u,
                "email": f"{u}@x",
                "education": rng.choice(["low", "high", None]),
                "marital_status": rng.choice(["one", "two", None]),
                "city": skewed(rng, "Rome", cities),
                "state": rng.choice(states),
                "country": rng.choice([*lands, None]),
                "signup_date": stamp(rng, dt.date(1999, 1, 1), 300),
                "last_login": rng.choice([None, LOADED]),
                "age": rng.randrange(18, 90),
            }
            for u in customers
        ],
        "orders": [
            {
                "order_id": o,
                "customer_id": skewed(rng, "u1", [*customers, "u-unknown", None]),
                "order_date": stamp(rng, dt.date(2000, 11, 1), 270),
                "status": rng.choice(["new", "done", None]),
                "payment_method": rng.choice(["card", "cash", None]),
                "total_amount": rng.choice([money(rng), None]),
                "shipping_cost": money(rng),
                "shipping_address": address(),
                "billing_address": address(),
                "created_at": LOADED,
            }
            for o in orders
        ],
        "order_items": [
            {
                "order_item_id": f"i{i}",
                "order_id": skewed(rng, "o1", [*orders[:60], "o-unknown", None]),
                "product_id": skewed(rng, "p1", [*products[:20], "p-unknown", None]),
                "quantity": rng.choice([1, 2, 5, None]),
                "unit_price": money(rng),
                "total_price": money(rng),
                "created_at": LOADED,
            }
            for i in range(200)
        ],
        "reviews": [
            {
                "review_id": f"r{i}",
                "order_id": skewed(rng, "o1", [*orders[:40], "o-unknown", None]),
                "product_id": skewed(rng, "p1", [*products, "p-unknown", None]),
                "customer_id": rng.choice(customers),
                "review_score": rng.randrange(1, 6),
                "review_text": f"text {i}",
                "loaded_at": LOADED - dt.timedelta(days=rng.randrange(3)),
            }
            for i in range(120)
        ],
        "interactions": [
            {
                "event_id": f"e{i}",
                "customer_id": skewed(rng, "u1", [*customers, "u-unknown", None]),
                "product_id": skewed(rng, "p1", [*products, "p-unknown", None]),
                "event_type": rng.choice(["view", "cart_add", "purchase", "wishlist_add", "search", None]),
                "event_date": rng.choice([None] + [stamp(rng, dt.date(2001, 1, 20), 30)] * 9),
                "device_type": rng.choice(["desktop", "mobile", None]),
                "session_id": rng.choice([None, *[f"x{j}" for j in range(40)]]),
            }
            for i in range(300)
        ],
    }
    for table in rows.values():
        for row in table:
            row.setdefault("loaded_at", LOADED)
    return rows


@pytest.fixture(scope="module", params=[1, 2, 3])
def small(request, spark):
    data = generate(request.param)
    frames, connection = {}, duckdb.connect()
    for table in TABLES:
        schema = staged_schema(table)
        values = [tuple(row.get(f.name) for f in schema.fields) for row in data[table]]
        frames[table] = spark.createDataFrame(values, schema)
        types = ", ".join(
            f"{f.name} {f.dataType.simpleString().replace('timestamp_ntz', 'timestamp').replace('string', 'varchar')}"
            for f in schema.fields
        )
        connection.sql(f"CREATE TABLE s_{table} ({types})")
        marks = ", ".join("?" for _ in schema.fields)
        connection.executemany(f"INSERT INTO s_{table} VALUES ({marks})", values)
    warehouse = Warehouse(frames.__getitem__, AS_OF)
    return warehouse, connection


GIVEN = frozenset(f"s_{t}" for t in TABLES)


def expected(connection, name):
    source = f"int_{name}" if name in ("orders", "order_items") else name
    result = connection.sql(oracle.with_tables(f"SELECT * FROM {source}", GIVEN))
    return frame_rows(pd.DataFrame(result.fetchall(), columns=result.columns, dtype=object))


def found(df):
    return frame_rows(pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object))


@pytest.mark.parametrize("name", [*NORMALIZED, *MARTS])
def test_equals_plain_sql(small, name):
    warehouse, connection = small
    wanted = expected(connection, name)
    assert wanted, "the fixture must exercise this table"
    assert found(warehouse.table(name)) == wanted


def test_marts_over_written_tables_equal_marts_over_staging(small):
    warehouse, connection = small
    marts = tables.marts_over_tables(warehouse.table, AS_OF)
    assert set(marts) == set(MARTS)
    for name, build in marts.items():
        assert found(build()) == expected(connection, name), name


def test_variants(small):
    warehouse, connection = small
    assert found(warehouse.table("order_items_newest_score")) == expected(connection, "order_items")
    assert found(warehouse.table("categories_by_using")) == expected(connection, "categories_enriched")
    wide, plain = warehouse.table("customers_with_parsed_dates"), warehouse.table("customers_enriched")
    assert set(plain.columns) - set(wide.columns) == {
        "preferred_channel", "is_active", "total_orders", "total_spent",
    }
    assert found(wide) == found(plain.select(wide.columns))
    by_load = warehouse.table("orders_by_load_time")
    assert {r.created_at for r in by_load.select("created_at").collect()} == {LOADED}
    assert set(VARIANTS) >= {"orders_by_load_time"}


def test_address_matches_are_counted(small):
    warehouse, connection = small
    staged = warehouse.staged("orders")
    statement = """
        SELECT o.order_id, r.role, count(a.address_id) FROM s_orders o
             CROSS JOIN (VALUES ('shipping'), ('billing')) r(role)
             LEFT JOIN addresses a ON a.street_address =
                 CASE r.role WHEN 'shipping' THEN o.shipping_address ELSE o.billing_address END
        WHERE o.order_id IS NOT NULL GROUP BY 1, 2"""
    wanted = connection.sql(oracle.with_tables(statement, GIVEN)).fetchall()
    matches = transactions.order_address_matches(staged)
    assert max(n for *_, n in wanted) > 1
    assert sorted(map(tuple, matches.collect())) == sorted(wanted)


def test_bucketed_tables_join_without_shuffle(small, spark, path):
    warehouse, connection = small
    layer = f"bucketed_{abs(hash(path))}"
    tables.create_layers(spark, path, [layer])
    names = ["orders", "order_items", "reviews_enriched"]
    tables.refresh(warehouse.table, layer, names, buckets=4)
    marts = tables.marts_over_tables(lambda t: spark.table(f"{layer}.{t}"), AS_OF)
    df = marts["fct_customer_orders"]()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found(df) == expected(connection, "fct_customer_orders")


def test_incremental_activity_equals_full_rebuild(small, path):
    warehouse, connection = small
    events, customers = warehouse.staged("interactions"), warehouse.customers_named
    target = f"{path}/activity"
    early = events.where("event_date < '2001-02-03'")
    tables.refresh_customer_activity(customers, early, target, "1990-01-01", AS_OF)
    tables.refresh_customer_activity(customers, events, target, "2001-02-02", AS_OF)
    assert found(tables.read_upserted(warehouse.table("dim_dates").sparkSession, f"{path}/activity")) == (
        expected(connection, "fct_customer_activity")
    )


def order_rows(spark, table, *values):
    names = [f.name for f in staged_schema(table).fields]
    full = [tuple(v.get(n) for n in names) for v in values]
    return spark.createDataFrame(full, staged_schema(table))


def test_customer_status_edges(spark):
    """Exactly three and six months before the day, one day earlier, and never."""
    last = {"a": "2001-05-01", "b": "2001-04-30", "c": "2001-02-01", "d": "2001-01-31", "e": None}
    place = {"city": "Rome", "state": "S", "country": "X", "loaded_at": LOADED}
    frames = {t: order_rows(spark, t) for t in TABLES}
    frames["customers"] = order_rows(
        spark, "customers", *[{"customer_id": c, "signup_date": dt.datetime(2001, 7, 30, 23), **place} for c in last]
    )
    frames["orders"] = order_rows(
        spark,
        "orders",
        *[
            {"order_id": c, "customer_id": c, "order_date": dt.datetime.fromisoformat(d), "loaded_at": LOADED}
            for c, d in last.items()
            if d
        ],
    )
    customers = Warehouse(frames.__getitem__, AS_OF).table("dim_customers").collect()
    assert {r.customer_id: r.customer_status for r in customers} == {
        "a": "Active", "b": "At Risk", "c": "At Risk", "d": "Churned", "e": "Churned",
    }
    assert {r.customer_id: r.customer_lifetime_days for r in customers}["e"] == 2


def test_fan_out_is_multiplied_not_joined(spark):
    """Two lines and three reviews: units count three times, an order without reviews once."""
    frames = {t: order_rows(spark, t) for t in TABLES}
    frames["orders"] = order_rows(spark, "orders", *[{"order_id": o, "loaded_at": LOADED} for o in "abc"])
    frames["order_items"] = order_rows(
        spark,
        "order_items",
        *[
            {"order_item_id": str(i), "order_id": o, "product_id": p, "quantity": q, "loaded_at": LOADED}
            for i, (o, p, q) in enumerate([("a", "p", 2), ("a", "p", 5), ("b", "q", 4)])
        ],
    )
    frames["reviews"] = order_rows(
        spark,
        "reviews",
        *[
            {"review_id": str(i), "order_id": "a", "product_id": "p", "review_score": s, "loaded_at": LOADED}
            for i, s in enumerate([1, 2, 5])
        ],
    )
    orders = Warehouse(frames.__getitem__, AS_OF).table("orders").collect()
    assert {r.order_id: (r.unique_products, r.total_items, r.has_review) for r in orders} == {
        "a": (1, 21, True), "b": (1, 4, False), "c": (0, None, False),
    }
    assert {r.order_id: r.avg_review_score for r in orders}["a"] == 8 / 3


def test_each_line_gets_the_scores_of_its_order_and_product(spark):
    """Newest score per line; one row of details per line and review, NULL scores and equal ones included."""
    frames = {t: order_rows(spark, t) for t in TABLES}
    place = {"city": "Rome", "state": "S", "country": "X"}
    frames["customers"] = order_rows(spark, "customers", {"customer_id": "u", "email": "e", **place, "loaded_at": LOADED})
    frames["categories"] = order_rows(spark, "categories", {"category_id": "c", "category_name": "C", "loaded_at": LOADED})
    frames["products"] = order_rows(
        spark, "products", *[{"product_id": p, "category_id": "c", "brand": "b", "loaded_at": LOADED} for p in "pqr"]
    )
    frames["orders"] = order_rows(
        spark, "orders", *[{"order_id": o, "customer_id": "u", "loaded_at": LOADED} for o in "ab"]
    )
    frames["order_items"] = order_rows(
        spark,
        "order_items",
        *[
            {"order_item_id": str(i), "order_id": o, "product_id": p, "quantity": i, "loaded_at": LOADED}
            for i, (o, p) in enumerate([("a", "p"), ("a", "p"), ("a", "q"), ("b", "p"), ("b", "r"), (None, "p"), ("a", None)])
        ],
    )
    given = [("a", "p", 4, 0), ("a", "p", 4, 1), ("a", "p", 2, 2), ("a", "p", None, 3), ("b", "r", None, 0), (None, "p", 5, 0), ("a", None, 5, 0)]
    frames["reviews"] = order_rows(
        spark,
        "reviews",
        *[
            {"review_id": str(i), "order_id": o, "product_id": p, "review_score": s, "loaded_at": LOADED + dt.timedelta(days=d)}
            for i, (o, p, s, d) in enumerate(given)
        ],
    )
    w = Warehouse(frames.__getitem__, AS_OF)
    lines = {r.order_item_id: r.review_score for r in w.table("order_items").collect()}
    assert lines == {"0": 2, "1": 2, "2": None, "3": None, "4": None, "5": None}
    details = sorted(((r.quantity, r.review_score) for r in w.table("fct_order_details").collect()), key=repr)
    each = [4, 4, 2, None]
    wanted = [(line, s) for line in (0, 1) for s in each] + [(2, None), (3, None), (4, None)]
    assert details == sorted(wanted, key=repr)


def test_monthly_sales_of_repeated_orders_and_lines_without_one(spark):
    """An order that is held twice, in two months and in one, a hot order, lines without order, product or price."""
    month = {"o1": ["2001-01-05", "2001-02-05"], "o2": ["2001-01-07", "2001-01-08"], "o3": [None], "hot": ["2001-03-01"]}
    orders = [(order, dt.datetime.fromisoformat(d) if d else None) for order, dates in month.items() for d in dates]
    lines = [(o, p, n + 1, Decimal(n), Decimal("1.10")) for n, o in enumerate([*month, "unknown", None]) for p in ("p1", "p2", None)]
    lines += [("hot", "p1", 1, None, None)] * 500 + [("o1", "p3", None, None, Decimal("0.01")), ("o1", "p1", 2, Decimal(3), None)]
    tables_ = {
        "products": (spark.createDataFrame([("p1", "c1"), ("p2", None), ("p4", "c1")], "product_id string, category_id string")),
        "orders": spark.createDataFrame(orders, "order_id string, order_date timestamp_ntz"),
        "lines": spark.createDataFrame(lines, "order_id string, product_id string, quantity int, unit_price decimal(12,2), total_price decimal(12,2)"),
        "reviews": spark.createDataFrame([("p1", 3), ("p1", None), ("p9", 1)], "product_id string, review_score int"),
    }
    for name, frame in tables_.items():
        frame.createOrReplaceTempView(f"given_{name}")
    performance = spark.sql(
        """SELECT p.product_id, s.month, coalesce(s.n, 0) total_orders, s.units * greatest(coalesce(r.n, 1), 1) units_sold,
                  s.sold * greatest(coalesce(r.n, 1), 1) revenue, r.mean avg_rating, coalesce(r.kinds, 0) review_count
           FROM given_products p LEFT JOIN
                (SELECT product_id, trunc(order_date, 'MM') month, count(DISTINCT o.order_id) n, sum(quantity) units, sum(total_price) sold
                 FROM given_lines l LEFT JOIN given_orders o ON o.order_id = l.order_id GROUP BY 1, 2) s USING (product_id)
                LEFT JOIN (SELECT product_id, count(*) n, avg(review_score) mean, count(DISTINCT review_score) kinds
                           FROM given_reviews GROUP BY 1) r USING (product_id)"""
    )
    by_product = spark.sql(
        """SELECT product_id, category_id, trunc(order_date, 'MM') sales_month, count(DISTINCT order_id) total_orders,
                  sum(quantity) units_sold, sum(total_price) revenue, avg(double(unit_price)) avg_selling_price
           FROM given_lines JOIN given_orders USING (order_id) JOIN given_products USING (product_id) GROUP BY 1, 2, 3"""
    )
    t = tables_
    built = {
        "performance": (facts.fct_product_performance(t["products"], t["lines"], t["orders"], t["reviews"]), performance),
        "by product": (facts.fct_sales_by_product(t["products"], t["lines"], t["orders"]), by_product),
    }
    for name, (frame, wanted) in built.items():
        month = "month" if name == "performance" else "sales_month"
        frame, wanted = (
            f.withColumns({month: F.col(month).cast("date"), "units_sold": F.col("units_sold").cast("decimal(38,0)"), "revenue": F.col("revenue").cast("decimal(38,2)")})
            for f in (frame, wanted)
        )
        assert found(frame) == found(wanted.select(frame.columns)), name
