"""Names for the keys of already written tables.

Marts need names next to keys. From staged frames the ``*_measures`` builders
keep them, without a join. From written tables the functions here look them up.
The lookups are read from files, so Catalyst knows their size and broadcasts
those under ``spark.sql.autoBroadcastJoinThreshold``; others are shuffled, and
AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopmill.plans.entities import PLACE, with_category_names


def customers_with_names(
    customers_enriched: DataFrame,
    locations: DataFrame,
    education_types: DataFrame,
    marital_statuses: DataFrame,
) -> DataFrame:
    statuses = marital_statuses.withColumnRenamed("status_type", "marital_status")
    return (
        customers_enriched.join(locations.select("location_id", *PLACE), "location_id", "left")
        .join(education_types.select("education_id", "education_type"), "education_id", "left")
        .join(statuses.select("marital_status_id", "marital_status"), "marital_status_id", "left")
    )


def products_with_names(
    products_enriched: DataFrame,
    categories: DataFrame,
    subcategories: DataFrame,
    brands: DataFrame,
) -> DataFrame:
    branded = products_enriched.join(brands.select("brand_id", "brand_name"), "brand_id", "left")
    return with_category_names(branded, categories, subcategories)


def orders_with_names(
    orders: DataFrame,
    order_statuses: DataFrame,
    payment_methods: DataFrame,
    addresses: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    places = (
        addresses.join(locations.select("location_id", "city", "state"), "location_id", "left")
        .select("address_id", "street_address", "city", "state")
        .toDF("shipping_address_id", "shipping_street", "shipping_city", "shipping_state")
    )
    return (
        orders.join(order_statuses.select("status_id", "status_name"), "status_id", "left")
        .join(
            payment_methods.select("payment_method_id", "method_name"), "payment_method_id", "left"
        )
        .join(places, "shipping_address_id", "left")
    )
