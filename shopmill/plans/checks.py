"""The warehouse's data contract: which checks hold on which table.

Fixed values: tables, columns, parents and severities of all checks.
"""

from __future__ import annotations

from dataclasses import replace

from shopmill.operators.quality import ERROR, WARN, not_null, relationship, unique

# Raw tables may hold several versions of a row, so repeated keys only warn.
RAW = [
    unique("categories", "category_id", WARN),
    *not_null("categories", "category_id", "category_name"),
    unique("customers", "customer_id", WARN),
    *not_null("customers", "customer_id", "email"),
    unique("interactions", "event_id", WARN),
    *not_null("interactions", "event_id", "customer_id", "product_id"),
    relationship("interactions", "customer_id", "customers", "customer_id"),
    relationship("interactions", "product_id", "products", "product_id"),
    unique("order_items", "order_item_id", WARN),
    *not_null("order_items", "order_item_id", "order_id", "product_id"),
    relationship("order_items", "order_id", "orders", "order_id"),
    relationship("order_items", "product_id", "products", "product_id"),
    unique("orders", "order_id", WARN),
    *not_null("orders", "order_id", "customer_id"),
    relationship("orders", "customer_id", "customers", "customer_id"),
    unique("products", "product_id", WARN),
    *not_null("products", "product_id", "category_id", "subcategory_id"),
    relationship("products", "category_id", "categories", "category_id"),
    relationship("products", "subcategory_id", "subcategories", "subcategory_id"),
    *not_null("reviews", "product_id", "order_id", "customer_id"),
    relationship("reviews", "product_id", "products", "product_id"),
    relationship("reviews", "order_id", "orders", "order_id"),
    relationship("reviews", "customer_id", "customers", "customer_id"),
    unique("subcategories", "subcategory_id", WARN),
    *not_null("subcategories", "subcategory_id", "category_id"),
    relationship("subcategories", "category_id", "categories", "category_id"),
]

STAGED = [
    *not_null("stg_categories", "category_id", "category_name"),
    *not_null("stg_customers", "customer_id"),
    *not_null("stg_interactions", "event_id", "customer_id", "product_id"),
    *not_null("stg_order_items", "order_item_id", "order_id", "product_id"),
    *not_null("stg_orders", "order_id", "customer_id"),
    *not_null("stg_products", "product_id", "category_id", "subcategory_id"),
    *not_null("stg_reviews", "product_id", "order_id", "customer_id"),
    *not_null("stg_subcategories", "subcategory_id", "category_id"),
]

# The stricter set: repeated keys are errors, and staged keys are checked, too.
RAW_STRICT = [replace(check, severity=ERROR) for check in RAW]
STAGED_STRICT = STAGED + [
    *not_null("stg_customers", "email"),
    unique("stg_categories", "category_id"),
    unique("stg_customers", "customer_id"),
    unique("stg_interactions", "event_id"),
    unique("stg_order_items", "order_item_id"),
    unique("stg_orders", "order_id"),
    unique("stg_products", "product_id"),
    unique("stg_subcategories", "subcategory_id"),
]

NORMALIZED = [
    unique("locations", "location_id"),
    *not_null("locations", "location_id", "city", "state", "country"),
    unique("brands", "brand_id"),
    *not_null("brands", "brand_id", "brand_name"),
    unique("education_types", "education_id"),
    *not_null("education_types", "education_id", "education_type"),
    unique("marital_statuses", "marital_status_id"),
    *not_null("marital_statuses", "marital_status_id", "status_type"),
    unique("order_statuses", "status_id"),
    *not_null("order_statuses", "status_id", "status_name"),
    unique("payment_methods", "payment_method_id"),
    *not_null("payment_methods", "payment_method_id", "method_name"),
    unique("addresses", "address_id"),
    *not_null("addresses", "address_id"),
    relationship("addresses", "location_id", "locations", "location_id"),
    unique("customers_enriched", "customer_id"),
    *not_null("customers_enriched", "customer_id"),
    relationship("customers_enriched", "education_id", "education_types", "education_id"),
    relationship("customers_enriched", "location_id", "locations", "location_id"),
    unique("products_enriched", "product_id"),
    *not_null("products_enriched", "product_id"),
    relationship("products_enriched", "category_id", "categories_enriched", "category_id"),
    relationship("products_enriched", "brand_id", "brands", "brand_id"),
    unique("orders", "order_id"),
    *not_null("orders", "order_id"),
    relationship("orders", "customer_id", "customers_enriched", "customer_id"),
    relationship("orders", "status_id", "order_statuses", "status_id"),
    unique("order_items", "order_item_id"),
    *not_null("order_items", "order_item_id"),
    relationship("order_items", "order_id", "orders", "order_id"),
    relationship("order_items", "product_id", "products_enriched", "product_id", WARN),
    unique("customer_interactions", "event_id"),
    *not_null("customer_interactions", "event_id"),
    relationship("customer_interactions", "customer_id", "customers_enriched", "customer_id"),
    relationship("customer_interactions", "product_id", "products_enriched", "product_id"),
    unique("subcategories_enriched", "subcategory_id"),
    *not_null("subcategories_enriched", "subcategory_id"),
    relationship("subcategories_enriched", "category_id", "categories_enriched", "category_id"),
    *not_null("reviews_enriched", "product_id", "order_id", "customer_id"),
    relationship("reviews_enriched", "product_id", "products_enriched", "product_id"),
]

MARTS = [
    unique("dim_dates", "date_day"),
    *not_null("dim_dates", "date_day"),
    unique("dim_locations", "location_id"),
    *not_null("dim_locations", "location_id"),
    unique("dim_categories", "category_id"),
    *not_null("dim_categories", "category_id"),
    unique("dim_products", "product_id"),
    *not_null("dim_products", "product_id"),
    unique("dim_customers", "customer_id"),
    *not_null("dim_customers", "customer_id", "total_orders", "customer_status"),
    *not_null("fct_customer_activity", "customer_id", "activity_month"),
    relationship("fct_customer_activity", "customer_id", "dim_customers", "customer_id"),
    *not_null("fct_order_details", "order_id", "order_date"),
    relationship("fct_order_details", "customer_id", "dim_customers", "customer_id"),
    relationship("fct_order_details", "product_id", "dim_products", "product_id"),
    unique("fct_sales_by_date", "sale_date"),
    *not_null("fct_sales_by_date", "sale_date", "total_revenue", "total_orders"),
    *not_null("fct_sales_by_product", "product_id"),
    relationship("fct_sales_by_product", "product_id", "dim_products", "product_id"),
    *not_null("fct_sales_by_region", "state", "country"),
    *not_null("fct_customer_orders", "customer_id"),
    relationship("fct_customer_orders", "customer_id", "dim_customers", "customer_id"),
    *not_null("fct_customer_reviews", "customer_id", "product_id", "order_id"),
    relationship("fct_customer_reviews", "customer_id", "dim_customers", "customer_id"),
    relationship("fct_customer_reviews", "product_id", "dim_products", "product_id"),
    *not_null("fct_product_performance", "product_id"),
    relationship("fct_product_performance", "product_id", "dim_products", "product_id"),
    *not_null("fct_product_interactions", "product_id"),
    relationship("fct_product_interactions", "product_id", "dim_products", "product_id"),
]
