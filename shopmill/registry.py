"""The eight shop tables, declared once: columns, keys, date columns, origin.

Wall-clock timestamps carry no zone in the sources, so they are
``timestamp_ntz`` everywhere and no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
FLAG = T.BooleanType()
MONEY = T.DecimalType(12, 2)
STAMP = T.TimestampNTZType()

AUDIT = (("data_source", TEXT), ("batch_id", TEXT), ("loaded_at", STAMP))

BUSINESS_COLUMNS: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "categories": (("category_id", TEXT), ("category_name", TEXT), ("created_at", STAMP)),
    "subcategories": (
        ("subcategory_id", TEXT),
        ("category_id", TEXT),
        ("subcategory_name", TEXT),
        ("created_at", STAMP),
    ),
    "customers": (
        ("customer_id", TEXT),
        ("email", TEXT),
        ("first_name", TEXT),
        ("last_name", TEXT),
        ("age", INT),
        ("gender", TEXT),
        ("annual_income", MONEY),
        ("marital_status", TEXT),
        ("education", TEXT),
        ("location_type", TEXT),
        ("city", TEXT),
        ("state", TEXT),
        ("country", TEXT),
        ("signup_date", STAMP),
        ("last_login", STAMP),
        ("preferred_channel", TEXT),
        ("is_active", FLAG),
    ),
    "products": (
        ("product_id", TEXT),
        ("category_id", TEXT),
        ("subcategory_id", TEXT),
        ("product_name", TEXT),
        ("description", TEXT),
        ("base_price", MONEY),
        ("sale_price", MONEY),
        ("stock_quantity", INT),
        ("weight_kg", T.DecimalType(8, 2)),
        ("is_active", FLAG),
        ("created_at", STAMP),
        ("brand", TEXT),
        ("sku", TEXT),
        ("rating", T.DecimalType(3, 1)),
        ("review_count", INT),
    ),
    "orders": (
        ("order_id", TEXT),
        ("customer_id", TEXT),
        ("order_date", STAMP),
        ("status", TEXT),
        ("total_amount", MONEY),
        ("shipping_cost", MONEY),
        ("payment_method", TEXT),
        ("shipping_address", TEXT),
        ("billing_address", TEXT),
        ("created_at", STAMP),
        ("updated_at", STAMP),
    ),
    "order_items": (
        ("order_item_id", TEXT),
        ("order_id", TEXT),
        ("product_id", TEXT),
        ("quantity", INT),
        ("unit_price", MONEY),
        ("total_price", MONEY),
        ("created_at", STAMP),
    ),
    "interactions": (
        ("event_id", TEXT),
        ("customer_id", TEXT),
        ("product_id", TEXT),
        ("event_type", TEXT),
        ("event_date", STAMP),
        ("device_type", TEXT),
        ("session_id", TEXT),
        ("created_at", STAMP),
    ),
    "reviews": (
        ("review_id", TEXT),
        ("product_id", TEXT),
        ("order_id", TEXT),
        ("customer_id", TEXT),
        ("review_score", INT),
        ("review_text", TEXT),
    ),
}

# The primary key of each table.
KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "products": ("product_id",),
    "order_items": ("order_item_id",),
    "categories": ("category_id",),
    "subcategories": ("subcategory_id",),
    "reviews": ("review_id",),
    "interactions": ("event_id",),
}

# Columns that may date a row, the preferred one first.
DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("signup_date", "last_login", "created_at"),
    "orders": ("order_date", "created_at", "updated_at"),
    "products": ("created_at",),
    "order_items": ("created_at", "order_date"),
    "reviews": ("created_at", "order_date"),
    "interactions": ("event_date", "created_at"),
    "categories": ("created_at",),
    "subcategories": ("created_at",),
}

# Where the raw rows come from, in load order.
DATABASE_TABLES = ("categories", "subcategories", "order_items", "interactions")
JSON_TABLES = ("customers", "products", "orders", "reviews")
TABLES = DATABASE_TABLES + JSON_TABLES

# Raw text that only the staging layer may turn into a timestamp, because it
# holds the words '' and 'null'.
LENIENT_STAMPS: dict[str, tuple[str, ...]] = {"customers": ("last_login",)}

LATEST_PREFIX = "latest_"


def base_name(table: str) -> str:
    """The table a ``latest_`` name belongs to."""
    return table.lower().removeprefix(LATEST_PREFIX)


def staged_schema(table: str) -> T.StructType:
    """Types of the staging layer, audit columns last."""
    columns = BUSINESS_COLUMNS[base_name(table)] + AUDIT
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


def landing_schema(table: str, audit: bool = False) -> T.StructType:
    """Types for reading raw files: as staged, but timestamps still text."""
    columns = BUSINESS_COLUMNS[base_name(table)] + (AUDIT if audit else ())
    return T.StructType(
        [T.StructField(name, TEXT if dtype == STAMP else dtype) for name, dtype in columns]
    )


def primary_keys(table: str) -> tuple[str, ...]:
    return KEYS.get(base_name(table), ())


def date_columns(table: str) -> tuple[str, ...]:
    return DATE_COLUMNS.get(base_name(table), ("created_at",))


def pick_date_column(columns: list[str], table: str) -> str | None:
    """First registered date column the frame has, whatever its case."""
    present = {name.lower(): name for name in columns}
    return next((present[c] for c in date_columns(table) if c in present), None)


def stamp_columns(schema: T.StructType) -> dict[str, str]:
    """Temporal columns of a target table: name to ``'date'`` or ``'timestamp'``."""
    found = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.DateType):
            found[field.name] = "date"
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            found[field.name] = "timestamp"
    return found


def storage_type(dtype: T.DataType) -> T.DataType:
    """Column type of a raw table for a frame's column type."""
    if isinstance(dtype, T.BooleanType):
        return FLAG
    if isinstance(dtype, T.IntegralType):
        return T.LongType()
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return STAMP
    if isinstance(dtype, (T.DecimalType, T.DateType)):
        return dtype
    return TEXT
