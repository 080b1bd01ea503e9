"""Entities of the normalized layer: places, catalogue, customers, reviews.

Builders take staged frames, whose keys are unique (``latest_by_key`` on the
raw side, checked by the quality suite). Foreign keys are computed from the
natural values, not looked up, and every side table is aggregated to one row
per join key first. So no join multiplies rows, and Catalyst drops those whose
columns a caller does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.functions.keys import key_if_present, surrogate_key
from shopmill.functions.numbers import TOTAL, mean, money_total
from shopmill.functions.temporal import moment
from shopmill.functions.text import address_head, address_part, filled, place_text

PLACE = ["city", "state", "country"]


def _address_texts(stg_orders: DataFrame) -> DataFrame:
    """Shipping and billing addresses in one column, from a single scan."""
    both = F.array("shipping_address", "billing_address")
    return stg_orders.select(F.explode(both).alias("address")).where(F.col("address").isNotNull())


def _place_of(address: Column) -> list[Column]:
    return [address_part(address, back).alias(name) for name, back in zip(PLACE, (2, 1, 0))]


def _complete_place() -> Column:
    city, state, country = (F.col(c) != "" for c in PLACE)
    return city & state & country


def locations(stg_orders: DataFrame, stg_customers: DataFrame, as_of) -> DataFrame:
    """Every complete place in an order address or a customer record, once.

    Addresses are cut to their place and made distinct on the map side before
    they are parsed, so parsing costs per place, not per order.
    """
    texts = _address_texts(stg_orders).select(place_text(F.col("address")).alias("address"))
    from_orders = texts.distinct().select(*_place_of(F.col("address")))
    from_customers = stg_customers.select(*[F.trim(c).alias(c) for c in PLACE])
    places = from_orders.unionAll(from_customers).where(_complete_place()).distinct()
    return places.select(
        surrogate_key(*PLACE).alias("location_id"), *PLACE, moment(as_of).alias("created_at")
    )


def parsed_addresses(stg_orders: DataFrame) -> DataFrame:
    """Distinct addresses with a complete place, split into their parts.

    Parts and keys depend on the address text alone, so the distinct runs on
    the bare text and everything else is computed once per address.
    """
    address = F.col("address")
    return (
        _address_texts(stg_orders)
        .distinct()
        .select(
            "address",
            address_head(address).alias("street_address"),
            address_part(address, 3).alias("postal_code"),
            *_place_of(address),
        )
        .where(_complete_place())
        .select(
            surrogate_key("address").alias("address_id"),
            "street_address",
            "postal_code",
            surrogate_key(*PLACE).alias("location_id"),
            *PLACE,
        )
    )


def addresses(stg_orders: DataFrame, as_of) -> DataFrame:
    return parsed_addresses(stg_orders).select(
        "address_id",
        "street_address",
        "postal_code",
        "location_id",
        moment(as_of).alias("created_at"),
    )


def _count_per(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(counted).alias(name))
    )


def categories_enriched(
    stg_categories: DataFrame, stg_subcategories: DataFrame, stg_products: DataFrame
) -> DataFrame:
    subcategories = _count_per(
        stg_subcategories, "category_id", "subcategory_id", "subcategory_count"
    )
    products = _count_per(stg_products, "category_id", "product_id", "product_count")
    zero = F.lit(0).cast("bigint")
    return (
        stg_categories.join(subcategories, "category_id", "left")
        .join(products, "category_id", "left")
        .select(
            "category_id",
            "category_name",
            F.coalesce("subcategory_count", zero).alias("subcategory_count"),
            F.coalesce("product_count", zero).alias("product_count"),
            "created_at",
        )
    )


def subcategories_enriched(stg_subcategories: DataFrame, stg_products: DataFrame) -> DataFrame:
    products = _count_per(stg_products, "subcategory_id", "product_id", "product_count")
    return stg_subcategories.join(products, "subcategory_id", "left").select(
        "subcategory_id",
        "subcategory_name",
        "category_id",
        F.coalesce("product_count", F.lit(0).cast("bigint")).alias("product_count"),
        "created_at",
    )


def brand_key() -> Column:
    return F.when(filled(F.col("brand")), surrogate_key(F.trim("brand")))


def product_sales(stg_order_items: DataFrame) -> DataFrame:
    """Orders, units and revenue of each product; a hot product is split by order first."""
    return (
        stg_order_items.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_quantity_sold"),
            money_total(F.col("total_price")).alias("total_revenue"),
        )
    )


def product_scores(stg_reviews: DataFrame) -> DataFrame:
    return (
        stg_reviews.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            mean(F.col("review_score")).alias("avg_review_score"),
        )
    )


PRODUCT_COLUMNS = [
    "product_id", "product_name", "description", "base_price", "sale_price", "stock_quantity",
    "weight_kg", "is_active", "brand_id", "category_id", "subcategory_id", "total_orders",
    "total_quantity_sold", "total_revenue", "review_count", "avg_review_score", "created_at",
]


def product_measures(
    stg_products: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    """All of ``PRODUCT_COLUMNS`` plus the trimmed ``brand_name``."""
    zero = F.lit(0).cast("bigint")
    catalogue = stg_products.where(F.col("product_id").isNotNull()).drop("review_count")
    return (
        catalogue.withColumns({"brand_id": brand_key(), "brand_name": F.trim("brand")})
        .join(product_sales(stg_order_items), "product_id", "left")
        .join(product_scores(stg_reviews), "product_id", "left")
        .withColumns(
            {
                "total_orders": F.coalesce("total_orders", zero),
                "total_quantity_sold": F.coalesce("total_quantity_sold", zero),
                "total_revenue": F.coalesce("total_revenue", F.lit(0).cast(TOTAL)),
                "review_count": F.coalesce("review_count", zero),
            }
        )
        .select(
            *PRODUCT_COLUMNS,
            F.when(F.col("brand_id").isNotNull(), F.col("brand_name")).alias("brand_name"),
        )
    )


def products_enriched(
    stg_products: DataFrame, stg_order_items: DataFrame, stg_reviews: DataFrame
) -> DataFrame:
    return product_measures(stg_products, stg_order_items, stg_reviews).select(*PRODUCT_COLUMNS)


def with_category_names(
    products: DataFrame, categories: DataFrame, subcategories: DataFrame
) -> DataFrame:
    """Products with category and subcategory names, and whether the category exists.

    Joined at product level, so a fact that needs names is shuffled once for
    the product instead of once per lookup.
    """
    named = categories.select(
        "category_id", "category_name", F.lit(True).alias("category_known")
    )
    return products.join(named, "category_id", "left").join(
        subcategories.select("subcategory_id", "subcategory_name"), "subcategory_id", "left"
    )


def customer_orders(stg_orders: DataFrame) -> DataFrame:
    """Order totals of each customer; order ids are unique, so a count is distinct."""
    return (
        stg_orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            money_total(F.col("total_amount")).alias("total_spent"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )


CUSTOMER_COLUMNS = [
    "customer_id", "email", "first_name", "last_name", "age", "gender", "annual_income",
    "education_id", "marital_status_id", "location_id", "signup_date", "preferred_channel",
    "is_active", "last_login", "total_orders", "total_spent", "first_order_date",
    "last_order_date", "created_at",
]


def customers_at_known_places(stg_customers: DataFrame) -> DataFrame:
    """Customers whose place is complete, with its parts trimmed and hashed."""
    return (
        stg_customers.where(
            filled(F.col("city")) & filled(F.col("state")) & filled(F.col("country"))
        )
        .withColumns({c: F.trim(c) for c in PLACE})
        .withColumns(
            {
                "education_id": key_if_present(F.col("education")),
                "marital_status_id": key_if_present(F.col("marital_status")),
                "location_id": surrogate_key(*PLACE),
            }
        )
    )


def customer_measures(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """All of ``CUSTOMER_COLUMNS`` plus the names behind the three keys."""
    return (
        customers_at_known_places(stg_customers)
        .drop("created_at")
        .withColumnsRenamed({"loaded_at": "created_at", "education": "education_type"})
        .join(customer_orders(stg_orders), "customer_id", "left")
        .withColumns(
            {
                "total_orders": F.coalesce("total_orders", F.lit(0).cast("bigint")),
                "total_spent": F.coalesce("total_spent", F.lit(0).cast(TOTAL)),
            }
        )
        .select(*CUSTOMER_COLUMNS, *PLACE, "education_type", "marital_status")
    )


def customers_enriched(stg_customers: DataFrame, stg_orders: DataFrame) -> DataFrame:
    return customer_measures(stg_customers, stg_orders).select(*CUSTOMER_COLUMNS)


def reviews_enriched(
    stg_reviews: DataFrame,
    stg_products: DataFrame,
    stg_categories: DataFrame,
    stg_subcategories: DataFrame,
) -> DataFrame:
    """Reviews with product, category, subcategory and brand names."""
    products = stg_products.select(
        "product_id",
        "product_name",
        "category_id",
        "subcategory_id",
        F.when(filled(F.col("brand")), F.trim("brand")).alias("brand_name"),
    )
    named = with_category_names(products, stg_categories, stg_subcategories)
    return stg_reviews.join(named, "product_id", "left").select(
        "product_id",
        "order_id",
        "customer_id",
        "review_score",
        "review_text",
        "product_name",
        "category_name",
        "subcategory_name",
        "brand_name",
        F.col("loaded_at").alias("created_at"),
    )
