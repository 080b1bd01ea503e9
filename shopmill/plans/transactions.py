"""Transactions of the normalized layer: orders, order lines, interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.functions.keys import key_if_present
from shopmill.functions.numbers import UNITS, mean
from shopmill.functions.text import has_parts
from shopmill.plans.entities import brand_key, parsed_addresses

ORDER_COLUMNS = [
    "order_id", "customer_id", "order_date", "status_id", "payment_method_id",
    "shipping_address_id", "billing_address_id", "total_amount", "shipping_cost",
    "unique_products", "total_items", "has_review", "avg_review_score", "created_at",
]


def lines_per_order(order_items: DataFrame) -> DataFrame:
    """Distinct products and units of each order.

    Products are gathered as a set, in the same shuffle as the units. It holds as many entries as the order has
    products, and lines that stand together are one row of it before they are shuffled.
    """
    return (
        order_items.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.size(F.collect_set("product_id")).cast("bigint").alias("unique_products"),
            F.sum("quantity").alias("units"),
        )
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count("review_score").alias("scored_reviews"),
            mean(F.col("review_score")).alias("avg_review_score"),
        )
    )


def repeated(total: Column, times: Column, dtype: T.DecimalType = UNITS) -> Column:
    """A sum over rows that a join to ``times`` partner rows would repeat.

    Without partners an outer join keeps each row once. The product is decimal,
    because it can be far larger than either factor.
    """
    partners = F.greatest(F.coalesce(times, F.lit(0)), F.lit(1)).cast("decimal(20,0)")
    return (total.cast(T.DecimalType(32, dtype.scale)) * partners).cast(dtype)


def street_book(stg_orders: DataFrame) -> DataFrame:
    """One address per street text: the one with the smallest id."""
    best = F.min(F.struct("address_id", "city", "state")).alias("best")
    return parsed_addresses(stg_orders).groupBy("street_address").agg(best)


def asked_streets(stg_orders: DataFrame) -> DataFrame:
    """Order addresses that may be the street of a known address, one row per role.

    The *whole* order address is compared with the *street* of a known address.
    A street holds no comma, so only addresses without one can match, and only
    those are shuffled.
    """
    roles = F.array(
        *[
            F.struct(F.lit(role).alias("role"), F.col(f"{role}_address").alias("street_address"))
            for role in ("shipping", "billing")
        ]
    )
    return (
        stg_orders.where(F.col("order_id").isNotNull())
        .select("order_id", F.inline(roles))
        .where(F.col("street_address").isNotNull() & ~has_parts(F.col("street_address")))
    )


def with_street(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Asked streets with what is known of them; ``known`` has one row per street.

    AQE splits a street that many orders name only where both sides of the join
    come straight from a shuffle. ``known`` is an aggregate by street, whose own
    shuffle the join would use; under another expression its few rows are
    shuffled once more.
    """
    street = F.concat("street_address", F.lit("")).alias("known_street")
    rest = [c for c in known.columns if c != "street_address"]
    known = known.select(street, *rest)
    return asked.join(known, F.col("street_address") == F.col("known_street")).drop("known_street")


def order_addresses(stg_orders: DataFrame) -> DataFrame:
    """Shipping and billing address of each order; both roles go through one join."""
    found = with_street(asked_streets(stg_orders), street_book(stg_orders))
    hit = F.struct("best.address_id", "street_address", "best.city", "best.state")
    per_order = found.groupBy("order_id").agg(
        F.max(F.when(F.col("role") == "shipping", hit)).alias("shipping"),
        F.max(F.when(F.col("role") == "billing", hit)).alias("billing"),
    )
    return per_order.select(
        "order_id",
        F.col("shipping.address_id").alias("shipping_address_id"),
        F.col("billing.address_id").alias("billing_address_id"),
        F.col("shipping.street_address").alias("shipping_street"),
        F.col("shipping.city").alias("shipping_city"),
        F.col("shipping.state").alias("shipping_state"),
    )


def order_measures(
    stg_orders: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    """All of ``ORDER_COLUMNS`` plus the names behind the keys.

    ``total_items`` counts each unit once per review of the order: the measure
    is defined over order lines paired with the order's reviews. The pairs are
    never built; both sides are summed per order and multiplied.
    """
    return (
        stg_orders.withColumnsRenamed({"status": "status_name", "payment_method": "method_name"})
        .join(lines_per_order(stg_order_items), "order_id", "left")
        .join(reviews_per_order(stg_reviews), "order_id", "left")
        .join(order_addresses(stg_orders), "order_id", "left")
        .withColumns(
            {
                "status_id": key_if_present(F.col("status_name")),
                "payment_method_id": key_if_present(F.col("method_name")),
                "unique_products": F.coalesce("unique_products", F.lit(0).cast("bigint")),
                "total_items": repeated(F.col("units"), F.col("reviews")),
                "has_review": F.coalesce(F.col("scored_reviews") > 0, F.lit(False)),
            }
        )
        .select(
            *ORDER_COLUMNS,
            "status_name",
            "method_name",
            "shipping_street",
            "shipping_city",
            "shipping_state",
            "loaded_at",
        )
    )


def orders(
    stg_orders: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    return order_measures(stg_orders, stg_order_items, stg_reviews).select(*ORDER_COLUMNS)


def order_address_matches(stg_orders: DataFrame) -> DataFrame:
    """How many known addresses share the street of each order's address, per role.

    ``orders`` takes one of them. Addresses are counted per street and joined
    once; all of them are found through ``addresses.street_address``.
    """
    known = parsed_addresses(stg_orders).groupBy("street_address").agg(F.count("*").alias("n"))
    found = with_street(asked_streets(stg_orders), known).select("order_id", "role", "n")
    roles = F.explode(F.array(F.lit("shipping"), F.lit("billing"))).alias("role")
    every = stg_orders.where(F.col("order_id").isNotNull()).select("order_id", roles)
    return every.join(found, ["order_id", "role"], "left").select(
        "order_id", "role", F.coalesce("n", F.lit(0).cast("long")).alias("n_addresses")
    )


def order_address_members(stg_orders: DataFrame) -> DataFrame:
    """Every match of an order's address with known addresses, as classes and their members.

    A class is a street; its members are the orders that name it, per role, and
    the addresses on it: ``street_address, kind (shipping, billing, address),
    member_id``. All matches are the pairs of an order and an address of one class; a
    street with n orders and m addresses has n + m rows here instead of n times m.
    Streets that only one side has are left out.
    """
    asked = asked_streets(stg_orders)
    known = parsed_addresses(stg_orders).select("street_address", "address_id")
    named = asked.groupBy("street_address").agg(F.lit(True).alias("named"))
    there = known.groupBy("street_address").agg(F.lit(True).alias("there"))
    orders_of = with_street(asked, there).select(
        "street_address", F.col("role").alias("kind"), F.col("order_id").alias("member_id")
    )
    addresses_of = with_street(known, named).select(
        "street_address", F.lit("address").alias("kind"), F.col("address_id").alias("member_id")
    )
    return orders_of.unionByName(addresses_of)


def newest_scores(stg_reviews: DataFrame) -> DataFrame:
    """Score of the newest rated review per order and product; ties: highest review id.

    ``max`` of a struct combines on the map side, so a hot pair costs one row
    per map task.
    """
    newest = F.max(F.struct("loaded_at", "review_id", "review_score")).alias("newest")
    return (
        stg_reviews.where(F.col("review_score").isNotNull())
        .groupBy("order_id", "product_id")
        .agg(newest)
        .select("order_id", "product_id", F.col("newest.review_score").alias("review_score"))
    )


def scores_per_order(stg_reviews: DataFrame) -> DataFrame:
    """Newest scores of each order, as a map from its products.

    One row per order, so that order lines get the scores and the order itself
    in one shuffle by order. Repeated reviews are reduced before they are listed:
    a map has one entry per product, of which a line reads all in the worst case.
    """
    pairs = newest_scores(stg_reviews.where("order_id IS NOT NULL AND product_id IS NOT NULL"))
    scores = F.map_from_entries(F.collect_list(F.struct("product_id", "review_score")))
    return pairs.groupBy("order_id").agg(scores.alias("scores"))


def order_items(
    stg_order_items: DataFrame,
    stg_products: DataFrame,
    stg_orders: DataFrame,
    stg_reviews: DataFrame,
) -> DataFrame:
    """Order lines of known products with customer, catalogue keys and newest score.

    The inner join on the product key is the filter and the lookup in one.
    Lines are unique by key and every join finds at most one partner, so rows
    need no distinct. The product comes first, where AQE splits a hot one; the brand crosses the next
    shuffle by its name and is hashed behind it. Order and scores meet the lines in one shuffle
    by order, which comes last: rows leave it as tables bucketed by order need them.
    """
    catalogue = stg_products.select("product_id", "category_id", "subcategory_id", "brand")
    buyers = stg_orders.select("order_id", "customer_id")
    return (
        stg_order_items.join(catalogue, "product_id")
        .join(buyers, "order_id", "left")
        .join(scores_per_order(stg_reviews), "order_id", "left")
        .withColumn("review_score", F.col("scores")[F.col("product_id")])
        .withColumn("brand_id", brand_key())
        .select(
            "order_item_id",
            "order_id",
            "product_id",
            "customer_id",
            "quantity",
            "unit_price",
            "total_price",
            "category_id",
            "subcategory_id",
            "brand_id",
            "review_score",
            "created_at",
        )
    )


def customer_interactions(stg_interactions: DataFrame, stg_products: DataFrame) -> DataFrame:
    catalogue = stg_products.select("product_id", "category_id", "subcategory_id")
    return stg_interactions.join(catalogue, "product_id", "left").select(
        "event_id",
        "customer_id",
        "product_id",
        "category_id",
        "subcategory_id",
        "event_type",
        "event_date",
        "device_type",
        "session_id",
        "created_at",
    )
