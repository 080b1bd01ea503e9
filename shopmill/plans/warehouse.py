"""All tables of the warehouse as lazy frames over one set of raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shopmill.operators.latest import latest_by_key
from shopmill.plans import (
    dimensions,
    entities,
    facts,
    lookups,
    transactions,
    variants,
)
from shopmill.plans.staging import stage
from shopmill.registry import TABLES, primary_keys


class Warehouse:
    """``table(name)`` gives any staged, normalized or mart table.

    ``raw(table)`` returns a raw frame. ``newest`` keeps one row per primary key
    before staging; leave it out only if the raw frames are already unique.
    """

    def __init__(self, raw: Callable[[str], DataFrame], as_of, newest: bool = True):
        self.raw, self.as_of, self.newest = raw, as_of, newest
        self._built: dict[str, DataFrame] = {}

    def staged(self, table: str) -> DataFrame:
        return self.table(f"stg_{table}")

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self)
        return self._built[name]

    def _stage(self, table: str) -> DataFrame:
        raw = self.raw(table)
        if self.newest:
            names = {c.lower(): c for c in raw.columns}
            keys = [names[k] for k in primary_keys(table)]
            raw = latest_by_key(raw, keys, [names["loaded_at"]])
        return stage(raw, table)

    @property
    def customers_named(self) -> DataFrame:
        return entities.customer_measures(self.staged("customers"), self.staged("orders"))

    @property
    def orders_named(self) -> DataFrame:
        return transactions.order_measures(
            self.staged("orders"), self.staged("order_items"), self.staged("reviews")
        )

    @property
    def products_named(self) -> DataFrame:
        measured = entities.product_measures(
            self.staged("products"), self.staged("order_items"), self.staged("reviews")
        )
        return entities.with_category_names(
            measured, self.staged("categories"), self.staged("subcategories")
        )


def _from_staged(builder, *tables: str):
    return lambda w: builder(*[w.staged(t) for t in tables])


def _dated(builder, *tables: str):
    return lambda w: builder(*[w.staged(t) for t in tables], w.as_of)


STAGING = {f"stg_{t}": (lambda w, t=t: w._stage(t)) for t in TABLES}

NORMALIZED = {
    "education_types": _dated(lookups.education_types, "customers"),
    "marital_statuses": _dated(lookups.marital_statuses, "customers"),
    "order_statuses": _dated(lookups.order_statuses, "orders"),
    "payment_methods": _dated(lookups.payment_methods, "orders"),
    "brands": _dated(lookups.brands, "products"),
    "locations": _dated(entities.locations, "orders", "customers"),
    "addresses": _dated(entities.addresses, "orders"),
    "categories_enriched": _from_staged(
        entities.categories_enriched, "categories", "subcategories", "products"
    ),
    "subcategories_enriched": _from_staged(
        entities.subcategories_enriched, "subcategories", "products"
    ),
    "products_enriched": _from_staged(
        entities.products_enriched, "products", "order_items", "reviews"
    ),
    "customers_enriched": _from_staged(entities.customers_enriched, "customers", "orders"),
    "reviews_enriched": _from_staged(
        entities.reviews_enriched, "reviews", "products", "categories", "subcategories"
    ),
    "orders": _from_staged(transactions.orders, "orders", "order_items", "reviews"),
    "order_items": _from_staged(
        transactions.order_items, "order_items", "products", "orders", "reviews"
    ),
    "customer_interactions": _from_staged(
        transactions.customer_interactions, "interactions", "products"
    ),
}

# Facts use only columns that reach the normalized tables unchanged from
# staging, so they take the staged frames and skip the lookups on the way.
MARTS = {
    "dim_dates": _from_staged(dimensions.dim_dates, "orders", "interactions"),
    "dim_locations": lambda w: dimensions.dim_locations(
        w.table("locations"), w.customers_named, w.staged("orders")
    ),
    "dim_categories": lambda w: dimensions.dim_categories(
        w.table("categories_enriched"), w.staged("products"), w.staged("order_items")
    ),
    "dim_products": lambda w: dimensions.dim_products(w.products_named, w.as_of),
    "dim_customers": lambda w: dimensions.dim_customers(w.customers_named, w.as_of),
    "fct_customer_orders": lambda w: facts.fct_customer_orders(
        w.staged("orders"),
        facts.known_product_lines(w.staged("order_items"), w.staged("products")),
        w.staged("reviews"),
    ),
    "fct_customer_activity": lambda w: facts.fct_customer_activity(
        w.customers_named, w.staged("interactions"), w.as_of
    ),
    "fct_customer_reviews": _from_staged(facts.fct_customer_reviews, "reviews", "products"),
    "fct_order_details": lambda w: facts.fct_order_details(
        w.orders_named,
        w.staged("order_items"),
        w.customers_named,
        w.products_named,
        w.staged("reviews"),
        w.as_of,
    ),
    "fct_product_interactions": _from_staged(facts.fct_product_interactions, "interactions"),
    "fct_product_performance": _from_staged(
        facts.fct_product_performance, "products", "order_items", "orders", "reviews"
    ),
    "fct_sales_by_date": _dated(facts.fct_sales_by_date, "orders"),
    "fct_sales_by_product": _from_staged(
        facts.fct_sales_by_product, "products", "order_items", "orders"
    ),
    "fct_sales_by_region": lambda w: facts.fct_sales_by_region(
        w.staged("orders"), w.customers_named
    ),
}

VARIANTS = {
    "orders_by_load_time": _from_staged(
        variants.orders_by_load_time, "orders", "order_items", "reviews"
    ),
    "order_items_newest_score": _from_staged(
        variants.order_items_newest_score, "order_items", "products", "orders", "reviews"
    ),
    "customers_with_parsed_dates": _from_staged(
        variants.customers_with_parsed_dates, "customers", "orders"
    ),
    "categories_by_using": _from_staged(
        variants.categories_by_using, "categories", "subcategories", "products"
    ),
}

BUILDERS = {**STAGING, **NORMALIZED, **MARTS, **VARIANTS}
