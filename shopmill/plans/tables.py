"""Written tables: layers, full refresh, views and upsert by key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill import session
from shopmill.operators.combine import MARK_DAY, has_key, upsert
from shopmill.plans import dimensions, facts, named

LAYERS = ("raw", "staging", "normalized", "marts")
BUCKET = "key_bucket"


def create_layers(spark: SparkSession, root: str, layers: Iterable[str] = LAYERS) -> None:
    """One database per layer, named exactly as given."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{root.rstrip('/')}/{layer}'")


def write_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


# The key most joins of a large table use. Tables bucketed alike on it join and
# group without a shuffle.
CLUSTER_KEYS = {
    "orders": "order_id",
    "order_items": "order_id",
    "reviews_enriched": "order_id",
    "customers_enriched": "customer_id",
    "customer_interactions": "customer_id",
}


# The column whose high-water mark an incremental run of what is built on a table starts from.
MARK_COLUMNS = {
    "orders": "order_date",
    "fct_customer_orders": "order_date",
    "customer_interactions": "event_date",
    "reviews_enriched": "created_at",
}


def write_table(
    df: DataFrame,
    layer: str,
    name: str,
    key: str | None = None,
    buckets: int = 0,
    sorted_by: str | None = None,
) -> None:
    """Full refresh, on request bucketed by a key with one file per bucket, or sorted by a column.

    The files of a sorted table hold ranges of the column, so that the minima and maxima of
    their row groups tell a reader who asks for rows past a mark which ones to skip. These work for
    dates and not for timestamps, so the table gets a column ``MARK_DAY``, which ``newer_than`` compares
    and leaves out. A hash of the row parts a value that many rows share. Of a frame that a shuffle by ``key`` into
    as many partitions made, Spark leaves out the one into buckets.
    """
    if sorted_by and buckets:
        raise ValueError("a table is either bucketed or sorted")
    writer = df.write
    if key and buckets:
        # one task per bucket, so that a bucket is one file
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    elif sorted_by:
        ranged = df.repartitionByRange(sorted_by, F.xxhash64(*df.columns))
        ranged = ranged.sortWithinPartitions(sorted_by)
        writer = ranged.withColumn(MARK_DAY, F.col(sorted_by).cast("date")).write
    writer.mode("overwrite").option("compression", "zstd").format("parquet").saveAsTable(f"`{layer}`.`{name}`")


def refresh(
    build: Callable[[str], DataFrame],
    layer: str,
    names: Iterable[str],
    buckets: int = 0,
    parallel: int = 4,
    by_mark: bool = False,
) -> None:
    """Write the named tables of a layer, ``parallel`` at a time.

    They must not be built on each other. ``buckets`` buckets the large tables
    by their join key. All of them must use the same number; aim at some hundred
    MB per bucket. Leave it out if a single key holds a large share of a table:
    its bucket would be one task. ``by_mark`` sorts those of ``MARK_COLUMNS`` instead, for
    incremental runs that read what is past a mark (``combine.newer_than``); ``buckets`` is for the others then.
    """
    frames = {name: build(name) for name in names}

    def write(name: str) -> None:
        mark = MARK_COLUMNS.get(name) if by_mark else None
        write_table(frames[name], layer, name, CLUSTER_KEYS.get(name), 0 if mark else buckets, mark)

    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(write, frames))


def refresh_customer_activity(
    customers: DataFrame, interactions: DataFrame, path: str, since, as_of
) -> None:
    """Recompute the activity of the month of ``since`` and later; older months stay.

    A month is recomputed from all its events, so late events are counted.
    """
    recent = interactions.where(F.col("event_date") >= F.trunc(F.lit(str(since)).cast("date"), "MM"))
    activity = facts.fct_customer_activity(customers, recent, as_of)
    upsert_path(activity, path, ["customer_id", "activity_month"], "activity_month")


def upsert_path(
    new: DataFrame,
    path: str,
    keys: list[str],
    partition: str | None = None,
    buckets: int = 256,
    spread: Iterable[str] = (),
    again: Column | None = None,
) -> None:
    """Replace the rows of equal key in a parquet table, rewriting touched partitions only.

    ``partition`` must be a key column, so that a key never moves between
    partitions. Without one, rows are spread over hash buckets of the key; keep their
    number the same for one table. ``spread`` are the columns by which rows without key are
    dealt to buckets instead (all of them to one otherwise), and ``again`` tells which of
    those came with an earlier attempt at the same rows.

    The merged partitions are first written to the shared folder and then
    replace the old ones from there, partition by partition. A run that dies
    before that leaves the table as it was; one that dies while it replaces them
    is mended by running it again, which gives the same table. The scratch
    folder goes when the table is written.
    """
    if partition is not None and partition not in keys:
        raise ValueError(f"{partition} is not part of the key {keys}")
    spark, by = new.sparkSession, partition or BUCKET
    dealt = F.xxhash64(*keys)
    if spread:
        dealt = F.when(has_key(keys), dealt).otherwise(F.xxhash64(*spread))
    rows = new if partition else new.withColumn(BUCKET, F.pmod(dealt, F.lit(buckets)))

    scratch = session.work_path(spark, "upsert", uuid.uuid4().hex)
    rows.write.partitionBy(by).parquet(f"{scratch}/new")
    rows = spark.read.schema(rows.schema).parquet(f"{scratch}/new")

    existing = _read_if_present(spark, path, rows)
    if existing is not None:
        touched = existing.join(rows.select(by).distinct(), by, "left_semi")
        upsert(touched, rows, keys, again).write.partitionBy(by).parquet(f"{scratch}/merged")
        rows = spark.read.schema(rows.schema).parquet(f"{scratch}/merged")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    session.remove(spark, scratch)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def _read_if_present(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return spark.read.schema(like.schema).parquet(path)


def marts_over_tables(read: Callable[[str], DataFrame], as_of) -> dict[str, Callable[[], DataFrame]]:
    """The marts over written normalized tables; ``read(name)`` returns one of them.

    Facts use line and order columns that the normalized tables hold as well.
    """

    def customers():
        return named.customers_with_names(
            *[
                read(t)
                for t in ("customers_enriched", "locations", "education_types", "marital_statuses")
            ]
        )

    def products():
        return named.products_with_names(
            *[
                read(t)
                for t in (
                    "products_enriched", "categories_enriched", "subcategories_enriched", "brands",
                )
            ]
        )

    def orders():
        return named.orders_with_names(
            *[
                read(t)
                for t in ("orders", "order_statuses", "payment_methods", "addresses", "locations")
            ]
        )

    def over(builder, *tables, dated=False):
        return lambda: builder(*[read(t) for t in tables], *([as_of] if dated else []))

    return {
        "dim_dates": over(dimensions.dim_dates, "orders", "customer_interactions"),
        "dim_locations": over(dimensions.dim_locations, "locations", "customers_enriched", "orders"),
        "dim_categories": over(
            dimensions.dim_categories, "categories_enriched", "products_enriched", "order_items"
        ),
        "dim_products": lambda: dimensions.dim_products(products(), as_of),
        "dim_customers": lambda: dimensions.dim_customers(customers(), as_of),
        "fct_customer_orders": over(
            facts.fct_customer_orders, "orders", "order_items", "reviews_enriched"
        ),
        "fct_customer_activity": over(
            facts.fct_customer_activity, "customers_enriched", "customer_interactions", dated=True
        ),
        "fct_customer_reviews": over(
            facts.fct_customer_reviews, "reviews_enriched", "products_enriched"
        ),
        "fct_order_details": lambda: facts.fct_order_details(
            orders(), read("order_items"), customers(), products(), read("reviews_enriched"), as_of
        ),
        "fct_product_interactions": over(facts.fct_product_interactions, "customer_interactions"),
        "fct_product_performance": over(
            facts.fct_product_performance,
            "products_enriched",
            "order_items",
            "orders",
            "reviews_enriched",
        ),
        "fct_sales_by_date": over(facts.fct_sales_by_date, "orders", dated=True),
        "fct_sales_by_product": over(
            facts.fct_sales_by_product, "products_enriched", "order_items", "orders"
        ),
        "fct_sales_by_region": lambda: facts.fct_sales_by_region(read("orders"), customers()),
    }
