"""Mart facts.

Every fact is reduced on its own keys before it meets another table, so the
joins see one row per key and a hot product, customer or day is combined on the
map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.functions import temporal
from shopmill.functions.numbers import TOTAL, mean, money_total, ratio
from shopmill.operators.combine import newer_than
from shopmill.plans.transactions import lines_per_order, repeated, reviews_per_order


def fct_customer_orders(
    orders: DataFrame, order_items: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Per order: distinct products, units (once per review), mean score."""
    return (
        orders.select("customer_id", "order_id", "order_date", "total_amount")
        .join(lines_per_order(order_items), "order_id", "left")
        .join(reviews_per_order(reviews), "order_id", "left")
        .select(
            "customer_id",
            "order_id",
            "order_date",
            "total_amount",
            F.coalesce("unique_products", F.lit(0).cast("bigint")).alias("unique_products"),
            repeated(F.col("units"), F.col("reviews")).alias("total_items"),
            "avg_review_score",
        )
    )


def new_customer_orders(
    orders: DataFrame, order_items: DataFrame, reviews: DataFrame, held: DataFrame
) -> DataFrame:
    """The rows an incremental run adds to the fact ``held``: orders after its last one.

    Lines and reviews are cut to those orders before they are summed.
    """
    new = newer_than(orders, held, "order_date")
    ids = new.select("order_id")
    return fct_customer_orders(
        new,
        order_items.join(ids, "order_id", "left_semi"),
        reviews.join(ids, "order_id", "left_semi"),
    )


def new_customer_reviews(reviews: DataFrame, products: DataFrame, held: DataFrame) -> DataFrame:
    """Reviews loaded after the last one in ``held``, in the columns of the fact."""
    return fct_customer_reviews(newer_than(reviews, held, "loaded_at"), products)


def known_product_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines whose product exists."""
    return order_items.join(products.select("product_id"), "product_id", "left_semi")


def fct_customer_activity(customers: DataFrame, interactions: DataFrame, as_of) -> DataFrame:
    """Per customer and month: views, cart adds, purchases, sessions, devices.

    Each event gives up to three marks: its session, its device and, for the
    three counted types, its product. Marks are counted per value and then per
    customer, which replaces five distinct aggregates (a sixfold expand) by two
    plain ones, and spreads a hot customer over its values first.
    """
    counted = ("view", "cart_add", "purchase")

    def mark(kind, value):
        return F.struct(kind.alias("kind"), value.alias("value"))

    session = mark(F.lit("session"), F.col("session_id"))
    device = mark(F.lit("device"), F.col("device_type"))
    product = mark(F.col("event_type"), F.col("product_id"))
    marks = F.when(
        F.col("event_type").isin(*counted), F.array(session, device, product)
    ).otherwise(F.array(session, device))

    per_value = (
        interactions.where(F.col("event_date").isNotNull() & F.col("customer_id").isNotNull())
        .select(
            "customer_id",
            temporal.month_start(F.col("event_date")).alias("activity_month"),
            F.inline(marks),
        )
        .groupBy("customer_id", "activity_month", "kind", "value")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    zero = F.lit(0).cast("bigint")

    def events(kind):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("events"))), zero)

    def values(kind):
        return F.count(F.when(F.col("kind") == kind, F.col("value")))

    per_month = per_value.groupBy("customer_id", "activity_month").agg(
        events("view").alias("total_views"),
        values("view").alias("unique_products_viewed"),
        events("cart_add").alias("cart_adds"),
        values("cart_add").alias("unique_products_added"),
        events("purchase").alias("purchases"),
        values("purchase").alias("unique_products_purchased"),
        values("session").alias("total_sessions"),
        values("device").alias("devices_used"),
    )
    return per_month.join(customers.select("customer_id", "email"), "customer_id").select(
        "customer_id",
        "email",
        "activity_month",
        "total_views",
        "unique_products_viewed",
        "cart_adds",
        "unique_products_added",
        "purchases",
        "unique_products_purchased",
        "total_sessions",
        "devices_used",
        temporal.moment(as_of).alias("updated_at"),
    )


def fct_customer_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews of known products with their category keys."""
    keys = products.select("product_id", "category_id", "subcategory_id")
    return reviews.join(keys, "product_id").select(
        "customer_id",
        "product_id",
        "order_id",
        "review_score",
        "review_text",
        "category_id",
        "subcategory_id",
    )


def _scores_per_order(reviews: DataFrame) -> DataFrame:
    """How often each product of an order got each score (NULL, too), as one row per order.

    Equal scores are counted before they are listed, so the list grows with the
    products of an order and not with its reviews.
    """
    counted = (
        reviews.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("order_id", "product_id", "review_score")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = F.collect_list(F.struct("product_id", "review_score", "n"))
    return counted.groupBy("order_id").agg(listed.alias("scores"))


def fct_order_details(
    orders_named: DataFrame,
    order_items: DataFrame,
    customers_named: DataFrame,
    products_named: DataFrame,
    reviews: DataFrame,
    as_of,
) -> DataFrame:
    """One wide row per order line and review.

    Names are attached to customers, products and orders before those meet the
    lines. Lines first meet their product, then in one shuffle by order the wide
    order columns and the reviews.
    """
    buyers = customers_named.where(F.col("city").isNotNull()).select(
        "customer_id",
        "email",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )
    bought = orders_named.join(buyers, "customer_id").select(
        "order_id",
        "order_date",
        "customer_id",
        "email",
        "customer_city",
        "customer_state",
        "status_name",
        F.col("method_name").alias("payment_method"),
        F.col("shipping_street").alias("shipping_address"),
        "shipping_city",
        "shipping_state",
        "shipping_cost",
        F.col("total_amount").alias("order_total"),
        "created_at",
    )
    catalogue = products_named.where(
        F.col("category_known") & F.col("brand_id").isNotNull()
    ).select("product_id", "product_name", "category_name", "brand_name")
    lines = order_items.select(
        "order_id", "product_id", "quantity", "unit_price", F.col("total_price").alias("item_total")
    )
    own = F.filter("scores", lambda s: s["product_id"] == F.col("product_id"))
    one_each = F.transform(own, lambda s: F.array_repeat(F.struct(s["review_score"]), s["n"].cast("int")))
    return (
        lines.join(catalogue, "product_id")
        .join(bought, "order_id")
        .join(_scores_per_order(reviews), "order_id", "left")
        .select("*", F.inline_outer(F.flatten(one_each)))
        .select(
            "order_id",
            "order_date",
            "customer_id",
            "email",
            "customer_city",
            "customer_state",
            "product_id",
            "product_name",
            "category_name",
            "brand_name",
            "status_name",
            "payment_method",
            "shipping_address",
            "shipping_city",
            "shipping_state",
            "quantity",
            "unit_price",
            "item_total",
            "shipping_cost",
            "order_total",
            "review_score",
            "created_at",
            temporal.moment(as_of).alias("updated_at"),
        )
    )


def fct_product_interactions(interactions: DataFrame) -> DataFrame:
    """Per product and day: views, cart adds, wishlist adds, customers.

    Event ids are unique, so counting them is counting distinct ids. That leaves
    one distinct aggregate, which needs no expand.
    """

    def events(kind):
        return F.count(F.when(F.col("event_type") == kind, F.col("event_id")))

    return interactions.groupBy(
        "product_id", F.col("event_date").cast("date").alias("event_day")
    ).agg(
        events("view").alias("views"),
        events("cart_add").alias("cart_adds"),
        events("wishlist_add").alias("wishlist_adds"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def _monthly_sales(order_items: DataFrame, orders: DataFrame, how: str, **measures: Column) -> DataFrame:
    """Per product and month: distinct orders, and sums or counts over their lines.

    Lines meet their order in one shuffle and are summed per order, product and month as they lie
    there, so that orders are counted without a shuffle that tells them apart. A hot
    product or month is combined on the map side of the next one.
    """
    dated = orders.select(
        "order_id",
        F.col("order_id").alias("dated_order_id"),
        temporal.month_start(F.col("order_date")).alias("month"),
    )
    return (
        order_items.join(dated, "order_id", how)
        .groupBy("order_id", "dated_order_id", "product_id", "month")
        .agg(*[column.alias(name) for name, column in measures.items()])
        .groupBy("product_id", "month")
        .agg(F.count("dated_order_id").alias("total_orders"), *[F.sum(name).alias(name) for name in measures])
    )


def fct_product_performance(
    products: DataFrame, order_items: DataFrame, orders: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Per product and month: orders, units and revenue (once per review), scores.

    Units and revenue are defined over order lines paired with all reviews of
    the product. Both sides are summed first and multiplied, so a product with
    a third of all lines and reviews costs no more than any other.
    """
    sales = _monthly_sales(
        order_items.where(F.col("product_id").isNotNull()),
        orders,
        "left",
        units=F.sum("quantity"),
        sold=F.sum("total_price"),
    )
    scores = (
        reviews.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            mean(F.col("review_score")).alias("avg_rating"),
            F.count_distinct("review_score").alias("review_count"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return (
        products.select("product_id")
        .join(sales, "product_id", "left")
        .join(scores, "product_id", "left")
        .select(
            "product_id",
            "month",
            F.coalesce("total_orders", zero).alias("total_orders"),
            repeated(F.col("units"), F.col("reviews")).alias("units_sold"),
            repeated(F.col("sold"), F.col("reviews"), TOTAL).alias("revenue"),
            "avg_rating",
            F.coalesce("review_count", zero).alias("review_count"),
        )
    )


def fct_sales_by_date(orders: DataFrame, as_of) -> DataFrame:
    """Per day: orders, customers, revenue, shipping and means."""
    customers = F.count_distinct("customer_id")
    return orders.groupBy(F.col("order_date").cast("date").alias("sale_date")).agg(
        F.count("order_id").alias("total_orders"),
        customers.alias("unique_customers"),
        money_total(F.col("total_amount")).alias("total_revenue"),
        money_total(F.col("shipping_cost")).alias("total_shipping"),
        (F.sum("total_amount") - F.sum("shipping_cost")).cast(TOTAL).alias("net_revenue"),
        mean(F.col("total_amount")).alias("avg_order_value"),
        ratio(F.sum("total_amount"), customers).alias("revenue_per_customer"),
        F.any_value(temporal.moment(as_of)).alias("updated_at"),
    )


def fct_sales_by_product(
    products: DataFrame, order_items: DataFrame, orders: DataFrame
) -> DataFrame:
    """Per product, category and month: orders, units, revenue, mean unit price."""
    sales = _monthly_sales(
        order_items,
        orders,
        "inner",
        units_sold=F.sum("quantity"),
        sold=F.sum("total_price"),
        prices=F.sum("unit_price"),
        priced=F.count("unit_price"),
    )
    return sales.join(products.select("product_id", "category_id"), "product_id").select(
        "product_id",
        "category_id",
        F.col("month").alias("sales_month"),
        "total_orders",
        "units_sold",
        F.col("sold").cast(TOTAL).alias("revenue"),
        ratio(F.col("prices"), F.col("priced")).alias("avg_selling_price"),
    )


def fct_sales_by_region(orders: DataFrame, customers_named: DataFrame) -> DataFrame:
    """Per state, country and month: orders, customers, revenue, mean order.

    Orders are summed per customer and month before the join. A customer has
    one place, so counting those rows is counting distinct customers.
    """
    spending = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", temporal.month_start(F.col("order_date")).alias("sales_month"))
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("total_amount").alias("revenue"),
            F.count("total_amount").alias("amounts"),
        )
    )
    places = customers_named.where(F.col("state").isNotNull())
    return (
        spending.join(places.select("customer_id", "state", "country"), "customer_id")
        .groupBy("state", "country", "sales_month")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unique_customers"),
            money_total(F.col("revenue")).alias("total_revenue"),
            ratio(F.sum("revenue"), F.sum("amounts")).alias("avg_order_value"),
        )
    )
