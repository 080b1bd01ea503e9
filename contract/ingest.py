"""Registered queries for sources, ingest, tables and checks, with their statements."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.oracle import NOW, table, with_tables
from contract.queries import Query, warehouse
from shopmill import session
from shopmill.functions import temporal
from shopmill.operators import combine, ingest, quality, reshape
from shopmill.operators.ingest import HISTORIC, LATEST, PART, Batch
from shopmill.operators.latest import latest_by_key
from shopmill.plans import checks, dimensions, facts, loads, tables, transactions
from shopmill.plans.staging import stage
from shopmill.plans.warehouse import Warehouse
from shopmill.registry import landing_schema, staged_schema
from shopmill.sources import files, raw, shop, sinks
from shopmill.streaming.ingest import read_streamed, stream_into_raw, stream_into_table

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}

# The latest part starts on the first day, the historic part ends before the second.
LATEST_FROM, HISTORIC_TO = "2001-05-01", "2001-06-01"
FIRST = Batch("batch-1", shop.LOADED_AT)
SECOND = Batch("batch-2", "2001-08-02 00:00:00")


def query(name: str, statement: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if statement is not None:
            STATEMENTS[name] = statement
        return function

    return register


def _landed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A raw table as a producer delivers it: no audit columns, timestamps as text."""
    rows = shop.raw_table(spark, folder, table).drop("data_source", "batch_id", "loaded_at")
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in landing_schema(table).fields])


def _orders_of(spark: SparkSession, folder: str, part: str) -> DataFrame:
    limit = f"order_date >= '{LATEST_FROM}'" if part == LATEST else f"order_date < '{HISTORIC_TO}'"
    return _landed(spark, folder, "orders").where(limit)


def _fresh(spark: SparkSession, name: str) -> str:
    """A new folder per call, so that a call on other data finds nothing old."""
    return session.work_path(spark, name, uuid.uuid4().hex)


# --- sources and sinks --------------------------------------------------------------------


@query(
    "source_csv_customers",
    with_tables("SELECT * REPLACE (nullif(city, '') AS city) FROM s_customers"),
)
def source_csv_customers(spark, folder):
    path = _fresh(spark, "source_csv_customers")
    sinks.write_csv(shop.raw_table(spark, folder, "customers"), path)
    return stage(files.read_csv(spark, path, "customers"), "customers")


@query("source_json_lines_reviews", with_tables("SELECT * FROM s_reviews"))
def source_json_lines_reviews(spark, folder):
    path = _fresh(spark, "source_json_lines_reviews")
    rows = shop.raw_table(spark, folder, "reviews")
    sinks.write_json_lines(rows, path)
    return stage(
        files.read_json_lines(spark, path, rows=landing_schema("reviews", audit=True)), "reviews"
    )


@query(
    "source_json_envelopes_products",
    with_tables("SELECT * EXCLUDE (data_source, batch_id, loaded_at) FROM s_products"),
)
def source_json_envelopes_products(spark, folder):
    """Envelopes of at most 500 products, the bound being the width of a key range."""
    path = _fresh(spark, "source_json_envelopes_products")
    rows = _landed(spark, folder, "products")
    documents = rows.groupBy(F.floor(F.col("product_id").cast("bigint") / 500)).agg(
        F.struct(
            F.lit("products").alias("table"),
            F.count(F.lit(1)).alias("recordCount"),
            F.lit(shop.LOADED_AT).alias("generatedAt"),
            F.lit("1.0").alias("version"),
        ).alias("metadata"),
        F.collect_list(F.struct(*rows.columns)).alias("data"),
    )
    documents.select("metadata", "data").write.mode("overwrite").json(path)
    read = files.read_envelopes(spark, path, "products", one_per_line=True)
    return reshape.coerce_stamps(read, ["created_at"])


@query(
    "raw_append_orders",
    with_tables(
        "SELECT * REPLACE ('batch-2' AS batch_id, timestamp '2001-08-02' AS loaded_at)"
        f" FROM s_orders WHERE order_date >= date '{LATEST_FROM}'"
        f" UNION ALL SELECT * FROM s_orders WHERE order_date < date '{LATEST_FROM}'"
    ),
)
def raw_append_orders(spark, folder):
    """Two overlapping batches, the second appended twice, read as newest rows."""
    root = _fresh(spark, "raw_append_orders")
    old = ingest.transform(_orders_of(spark, folder, HISTORIC), "orders", FIRST)
    new = ingest.transform(_orders_of(spark, folder, LATEST), "orders", SECOND)
    sinks.append_batch(old, root, "orders", FIRST.batch_id)
    for _ in range(2):
        sinks.append_batch(new, root, "orders", SECOND.batch_id)
    return stage(raw.read_raw(spark, root, "orders"), "orders")


# Written loads: the history ends before the first day; each delivery has a range of days and
# lacks the orders whose number its divisor divides.
_HISTORY_TO = "2001-01-01"
_DELIVERIES = (
    (Batch("rerun-2", "2001-08-02 00:00:00"), "2000-06-01", "2001-04-01", 7),
    (Batch("3", "2001-08-03 00:00:00"), "2000-12-01", "9999-01-01", 5),
)
_START = Batch("20010201", shop.LOADED_AT)


def _delivered(number: int) -> str:
    _, begin, end, without = _DELIVERIES[number]
    return (
        f"order_date >= '{begin}' AND order_date < '{end}'"
        f" AND CAST(order_id AS bigint) % {without} <> 0"
    )


def _stamped(batch: Batch) -> str:
    return f"* REPLACE ('{batch.batch_id}' AS batch_id, timestamp '{batch.loaded_at}' AS loaded_at)"


@query(
    "load_written_two_increments_orders",
    with_tables(
        f"""SELECT {_stamped(_START)} FROM s_orders
            WHERE order_date < timestamp '{_HISTORY_TO}'
              AND order_date < (SELECT min(order_date) FROM s_orders WHERE {_delivered(0)})
              AND order_date < (SELECT min(order_date) FROM s_orders WHERE {_delivered(1)})
            UNION ALL SELECT {_stamped(_DELIVERIES[0][0])} FROM s_orders WHERE {_delivered(0)}
              AND order_date < (SELECT min(order_date) FROM s_orders WHERE {_delivered(1)})
            UNION ALL SELECT {_stamped(_DELIVERIES[1][0])} FROM s_orders WHERE {_delivered(1)}"""
    ),
)
def load_written_two_increments_orders(spark, folder):
    """An initial load, run again without its latest part, and two increments, the second run twice.

    Each increment lacks orders that the history holds inside the overlap; they
    go and stay away. The jobs run while the query is built.
    """
    root = _fresh(spark, "load_written_two_increments_orders")
    landed = _landed(spark, folder, "orders")
    history = landed.where(f"order_date < '{_HISTORY_TO}'")

    def load(how, batch, latest):
        parts = {HISTORIC: history, LATEST: latest}
        status = loads.run_loads(spark, how, lambda _, part: parts[part], root, batch, ["orders"])
        loads.require_loaded(status)

    load(loads.load_initial, _START, landed.where(f"order_date >= '{_HISTORY_TO}'"))
    load(loads.load_initial, _START, landed.where("false"))
    for number in (0, 1, 1):
        load(loads.load_increment, _DELIVERIES[number][0], landed.where(_delivered(number)))
    return stage(raw.read_raw(spark, root, "orders"), "orders")


@query(
    "order_address_matches",
    with_tables(
        """SELECT o.order_id, r.role, count(a.address_id) AS n_addresses
           FROM s_orders o CROSS JOIN (VALUES ('shipping'), ('billing')) r(role)
                LEFT JOIN addresses a ON a.street_address =
                    CASE r.role WHEN 'shipping' THEN o.shipping_address ELSE o.billing_address END
           GROUP BY o.order_id, r.role"""
    ),
)
def order_address_matches(spark, folder):
    """All matches that ``int_orders`` takes one of, counted against the plain joins."""
    return transactions.order_address_matches(warehouse(spark, folder).staged("orders"))


@query(
    "order_address_members",
    with_tables(
        """, matches AS (
               SELECT r.role, o.order_id, a.address_id, a.street_address
               FROM s_orders o CROSS JOIN (VALUES ('shipping'), ('billing')) r(role)
                    JOIN addresses a ON a.street_address =
                        CASE r.role WHEN 'shipping' THEN o.shipping_address ELSE o.billing_address END)
           SELECT DISTINCT street_address, role AS kind, order_id AS member_id FROM matches
           UNION ALL SELECT DISTINCT street_address, 'address', address_id FROM matches"""
    ),
)
def order_address_members(spark, folder):
    """All matches as streets with their orders and addresses; the statement builds the pairs."""
    return transactions.order_address_members(warehouse(spark, folder).staged("orders"))


_CUSTOMER_TABLES = ("customers_enriched", "locations", "education_types", "marital_statuses")
_PRODUCT_TABLES = ("products_enriched", "categories_enriched", "subcategories_enriched", "brands")
_ORDER_TABLES = ("orders", "order_statuses", "payment_methods", "addresses")


def _over_written(spark, folder, mart, names):
    """A mart over normalized tables that were written first."""
    w, root = warehouse(spark, folder), _fresh(spark, "marts_over_written")
    for name in names:
        w.table(name).write.parquet(f"{root}/{name}")
    read = tables.marts_over_tables(lambda name: spark.read.parquet(f"{root}/{name}"), shop.AS_OF)
    return read[mart]()


@query("marts_over_written_sales_by_region", table("fct_sales_by_region"))
def marts_over_written_sales_by_region(spark, folder):
    return _over_written(spark, folder, "fct_sales_by_region", ("orders", *_CUSTOMER_TABLES))


@query("marts_over_written_customers", table("dim_customers"))
def marts_over_written_customers(spark, folder):
    return _over_written(spark, folder, "dim_customers", _CUSTOMER_TABLES)


@query("marts_over_written_order_details", table("fct_order_details"))
def marts_over_written_order_details(spark, folder):
    names = (*_ORDER_TABLES, "order_items", *_CUSTOMER_TABLES, *_PRODUCT_TABLES, "reviews_enriched")
    return _over_written(spark, folder, "fct_order_details", names)


def _layers(*names: str) -> list[str]:
    """Names of databases that no other call uses."""
    return [f"{name}_{uuid.uuid4().hex}" for name in names]


@query("layers_as_tables_sales_by_region", table("fct_sales_by_region"))
def layers_as_tables_sales_by_region(spark, folder):
    """Normalized tables in one database, the mart over them in another, read through a view."""
    w, (normalized, marts) = warehouse(spark, folder), _layers("normalized", "marts")
    tables.create_layers(spark, _fresh(spark, "layers"), (normalized, marts))
    tables.refresh(w.table, normalized, ("orders", *_CUSTOMER_TABLES))
    built = tables.marts_over_tables(lambda name: spark.table(f"`{normalized}`.`{name}`"), shop.AS_OF)
    for _ in range(2):  # a refresh replaces the table
        tables.write_table(built["fct_sales_by_region"](), marts, "fct_sales_by_region")
    tables.write_view(spark.table(f"`{marts}`.fct_sales_by_region"), f"view_of_{marts}")
    return spark.table(f"view_of_{marts}")


@query(
    "load_created_table_orders",
    with_tables(
        "SELECT * REPLACE ('batch-2' AS batch_id, timestamp '2001-08-02' AS loaded_at)"
        f" FROM s_orders WHERE order_date >= date '{LATEST_FROM}'"
        f" UNION ALL SELECT * FROM s_orders WHERE order_date < date '{LATEST_FROM}'"
    ),
)
def load_created_table_orders(spark, folder):
    """A table created by its first load and extended by a second one, which runs twice."""
    (database,) = _layers("raw")
    tables.create_layers(spark, _fresh(spark, "layers"), [database])
    for batch, part in ((FIRST, HISTORIC), (SECOND, LATEST), (SECOND, LATEST)):
        read = lambda name, _, part=part: _orders_of(spark, folder, part)
        loads.load_into_table(spark, read, "orders", database, batch)
    return stage(loads.read_loaded(spark, "orders", database), "orders")


@query(
    "load_status_one_failing",
    with_tables(
        """SELECT 'orders' AS table_name, 'loaded' AS status, CAST(NULL AS varchar) AS error, count(*) AS n_rows FROM s_orders
           UNION ALL SELECT 'reviews', 'failed', 'OSError: no reviews today', 0
           UNION ALL SELECT 'customers', 'loaded', NULL, count(*) FROM s_customers"""
    ),
)
def load_status_one_failing(spark, folder):
    """A run in which one source is down: the other tables are there."""
    root = _fresh(spark, "load_status_one_failing")

    def read(name, part):
        if name == "reviews":
            raise OSError("no reviews today")
        return _landed(spark, folder, name).where(F.lit(part == LATEST))

    names = ("orders", "reviews", "customers")
    status = loads.run_loads(spark, loads.load_initial, read, root, FIRST, names)
    there = [r.table_name for r in status.where("status = 'loaded'").collect()]
    counts = [
        raw.read_raw(spark, root, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("own"), "n_rows")
        for name in there
    ]
    known = reduce(DataFrame.unionByName, counts)
    found = status.join(known, F.col("table_name") == F.col("own"), "left").drop("own")
    return found.withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


@query("staged_newest_orders", with_tables("SELECT * FROM s_orders"))
def staged_newest_orders(spark, folder):
    """Staging a raw table with repeated keys, older rows among them."""

    def read(name):
        rows = shop.raw_table(spark, folder, name)
        older = rows.withColumn("loaded_at", F.col("loaded_at") - F.expr("INTERVAL 1 DAY"))
        return rows.unionByName(older.withColumn("status", F.lit("old")))

    return Warehouse(read, shop.AS_OF).staged("orders")


# --- ingest operators ---------------------------------------------------------------------


@query(
    "flatten_nested",
    """SELECT event_id, cast(json_array(event_type, props) AS varchar) AS tags, user_id AS who_id, ts AS who_seen_at,
              value AS who_score_value, props AS who_score_props FROM events""",
)
def flatten_nested(spark, folder):
    events = shop.reader(spark, folder)("events")
    nested = events.select(
        "event_id",
        F.struct(
            F.col("user_id").alias("id"),
            F.col("ts").alias("seen_at"),
            F.struct("value", "props").alias("score"),
        ).alias("who"),
        F.array("event_type", "props").alias("tags"),
    )
    return reshape.flatten_nested(nested)


@query(
    "audit_columns",
    f"""SELECT *, 'latest' AS data_source, 'batch-7' AS batch_id, {NOW} AS loaded_at
        FROM supplier""",
)
def audit_columns(spark, folder):
    return reshape.with_audit(
        shop.reader(spark, folder)("supplier"), "batch-7", shop.LOADED_AT, "latest"
    )


def _texts(spark, folder):
    """Dates as text in four columns, of which one also holds words."""
    return shop.raw_table(spark, folder, "customers").select(
        "customer_id",
        F.col("signup_date").cast("string").alias("signup_date"),
        F.col("last_login").alias("login_time"),
        F.lit(shop.LOADED_AT).alias("loaded_at"),
        F.col("last_login").alias("login_text"),
    )


@query(
    "temporal_probe",
    with_tables(
        "SELECT bool_and(try_cast(cast(signup_date AS varchar) AS timestamp) IS NOT NULL)"
        " AS signup_date, bool_and(last_login IS NULL OR try_cast(last_login AS timestamp)"
        " IS NOT NULL) AS login_time, true AS loaded_at FROM raw_customers"
    ),
)
def temporal_probe(spark, folder):
    texts = _texts(spark, folder)
    return reshape.temporal_probe(texts, reshape.temporal_candidates(texts.columns))


@query(
    "parse_temporals",
    with_tables(
        "SELECT customer_id, signup_date, last_login AS login_time, loaded_at,"
        " last_login AS login_text FROM raw_customers"
    ),
)
def parse_temporals(spark, folder):
    return reshape.parse_temporals(_texts(spark, folder))


@query(
    "load_unknown_table",
    with_tables(
        "SELECT customer_id, signup_date, last_login AS login_time, last_login AS login_text FROM raw_customers"
    ),
)
def load_unknown_table(spark, folder):
    """Two loads of a table that the registry does not know; its dates are found while it is written."""
    root, texts = _fresh(spark, "load_unknown_table"), _texts(spark, folder).drop("loaded_at")
    early = F.coalesce(F.col("signup_date") < "2000-01-01", F.lit(False))
    first = {HISTORIC: texts.where(early), LATEST: texts.where("false")}
    loads.load_initial(spark, lambda _, part: first[part], "visitors", root, FIRST)
    loads.load_increment(spark, lambda *_: texts.where(~early), "visitors", root, SECOND)
    found = raw.read_raw(spark, root, "visitors")
    return found.select(*[F.col(c.upper()).alias(c) for c in texts.columns])


@query(
    "missing_to_null",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
              CASE WHEN l_tax <> 0 THEN l_tax END AS l_tax,
              CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount FROM lineitem""",
)
def missing_to_null(spark, folder):
    def gap(name):
        return F.when(F.col(name) == 0, F.lit(float("nan"))).otherwise(F.col(name)).alias(name)

    rows = shop.reader(spark, folder)("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        gap("l_tax"), gap("l_discount"),
    )
    return reshape.missing_to_null(rows)


@query(
    "upper_names",
    "SELECT s_suppkey AS S_SUPPKEY, s_name AS S_NAME, s_nationkey AS S_NATIONKEY,"
    " s_acctbal AS S_ACCTBAL FROM supplier",
)
def upper_names(spark, folder):
    return reshape.upper_names(shop.reader(spark, folder)("supplier"))


@query(
    "coerce_stamps",
    with_tables(
        "SELECT customer_id, try_cast(last_login AS timestamp) AS LAST_LOGIN FROM raw_customers"
    ),
)
def coerce_stamps(spark, folder):
    rows = shop.raw_table(spark, folder, "customers")
    texts = rows.select("customer_id", F.col("last_login").alias("LAST_LOGIN"))
    return reshape.coerce_stamps(texts, ["last_login"])


@query(
    "normalize_temporals",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS from_stamp,
              strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.000') AS from_seconds,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS from_millis,
              'at ' || event_id AS from_text, strftime(ts, '%Y-%m-%d') AS from_day
       FROM events""",
)
def normalize_temporals(spark, folder):
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")
    )
    rows = shop.reader(spark, folder)("events").select(
        "event_id",
        F.col("ts").alias("from_stamp"),
        F.floor(micros / 1000000).alias("from_seconds"),
        F.floor(micros / 1000).alias("from_millis"),
        F.concat(F.lit("at "), F.col("event_id").cast("string")).alias("from_text"),
        F.col("ts").cast("string").alias("from_day"),
    )
    target = spark.createDataFrame(
        [],
        "from_stamp timestamp_ntz, from_seconds timestamp_ntz, from_millis timestamp_ntz,"
        " from_text timestamp_ntz, from_day date",
    )
    return reshape.normalize_temporals(rows, target.schema)


@query("lenient_stamps", "SELECT o_orderkey, o_orderdate AS parsed FROM orders")
def lenient_stamps(spark, folder):
    """Every accepted way to write a date, and back."""
    orders = shop.reader(spark, folder)("orders")
    day = F.col("o_orderdate").cast("date")
    epoch = F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    texts = [
        day.cast("string"),
        F.col("o_orderdate").cast("string"),
        F.concat(day.cast("string"), F.lit("T00:00:00.000Z")),
        F.concat_ws("/", F.lpad(F.day(day), 2, "0"), F.lpad(F.month(day), 2, "0"), F.year(day)),
        F.replace(day.cast("string"), F.lit("-"), F.lit("/")),
        F.replace(day.cast("string"), F.lit("-"), F.lit("")),
        # nine or ten digits from 1973-03-03 on
        epoch.cast("string"),
        (epoch * 1000 + 1000000000000).cast("string"),
    ]
    shape = F.col("o_orderkey") % len(texts)
    text = F.coalesce(*[F.when(shape == i, t) for i, t in enumerate(texts)])
    parsed = temporal.lenient_stamp(text)
    # thirteen digits need a shift, since milliseconds of these years have twelve
    shifted = F.timestamp_add("SECOND", F.lit(-1000000000), parsed)
    return orders.select(
        "o_orderkey",
        F.when(shape == len(texts) - 1, shifted).otherwise(parsed).alias("parsed"),
    )


@query(
    "latest_by_key",
    """SELECT * FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
           l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
)
def latest_lines(spark, folder):
    lines = shop.reader(spark, folder)("lineitem")
    return latest_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "union_parts",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union_parts(spark, folder):
    read = shop.reader(spark, folder)
    customers = read("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = read("supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id")
    )
    return combine.union_parts(customers, suppliers)


_PARTS = f"""
    SELECT o_orderkey, o_orderdate, '{HISTORIC}' AS part FROM orders
    WHERE o_orderdate < date '{HISTORIC_TO}'
      AND o_orderdate < (SELECT min(o_orderdate) FROM orders
                         WHERE o_orderdate >= date '{LATEST_FROM}')
    UNION ALL
    SELECT o_orderkey, o_orderdate, '{LATEST}' FROM orders
    WHERE o_orderdate >= date '{LATEST_FROM}'"""


@query("replace_overlap", _PARTS)
def replace_overlap(spark, folder):
    orders = shop.reader(spark, folder)("orders").select("o_orderkey", "o_orderdate")
    return combine.replace_overlap(
        orders.where(f"o_orderdate < '{HISTORIC_TO}'").withColumn("part", F.lit(HISTORIC)),
        orders.where(f"o_orderdate >= '{LATEST_FROM}'").withColumn("part", F.lit(LATEST)),
        "o_orderdate",
    )


def _upper(table: str, batch: Batch) -> str:
    names = [f.name for f in staged_schema(table).fields if f.name not in ("batch_id", "loaded_at")]
    columns = ", ".join(f"{n} AS {n.upper()}" for n in names)
    return f"{columns}, '{batch.batch_id}' AS BATCH_ID, timestamp '{batch.loaded_at}' AS LOADED_AT"


@query(
    "transform_orders", with_tables(f"SELECT {_upper('orders', FIRST)} FROM s_orders")
)
def transform_orders(spark, folder):
    """Every row delivered twice comes out once."""
    landed = _landed(spark, folder, "orders")
    return ingest.transform(landed.unionAll(landed), "orders", FIRST)


@query(
    "load_initial_orders",
    with_tables(
        f"SELECT {_upper('orders', FIRST)}, CASE WHEN order_date >= date '{LATEST_FROM}'"
        f" THEN '{LATEST}' ELSE '{HISTORIC}' END AS {PART} FROM s_orders"
    ),
)
def load_initial_orders(spark, folder):
    parts = [_orders_of(spark, folder, part) for part in (HISTORIC, LATEST)]
    return ingest.initial_load(*parts, "orders", FIRST)


@query(
    "load_incremental_orders",
    with_tables(
        f"""SELECT {_upper('orders', SECOND)}, CASE WHEN order_date < (
                SELECT min(order_date) FROM s_orders WHERE order_date >= date '{LATEST_FROM}')
            THEN '{HISTORIC}' ELSE '{LATEST}' END AS {PART} FROM s_orders"""
    ),
)
def load_incremental_orders(spark, folder):
    parts = [_orders_of(spark, folder, part) for part in (HISTORIC, LATEST)]
    return ingest.incremental_load(*parts, "orders", SECOND)


@query(
    "load_incremental_interactions",
    with_tables(
        f"""SELECT {_upper('interactions', SECOND)},
                   CASE WHEN cast(event_id AS bigint) % 2 = 0 AND event_date >= timestamp '2024-01-03'
                       THEN '{LATEST}' ELSE '{HISTORIC}' END AS {PART}
            FROM s_interactions
            WHERE cast(event_id AS bigint) % 2 = 0 AND event_date >= timestamp '2024-01-03'
               OR (cast(event_id AS bigint) % 2 = 1 OR event_date < timestamp '2024-01-03') AND event_date < (
                   SELECT min(event_date) FROM s_interactions
                   WHERE cast(event_id AS bigint) % 2 = 0 AND event_date >= timestamp '2024-01-03')"""
    ),
)
def load_incremental_interactions(spark, folder):
    """Even events from the third day on are the latest part, all others are history."""
    events = _landed(spark, folder, "interactions")
    odd = F.col("event_id").cast("bigint") % 2 == 1
    late = F.col("event_date") >= "2024-01-03"
    return ingest.incremental_load(events.where(odd | ~late), events.where(~odd & late), "interactions", SECOND)


def _flat_metadata(metadata: DataFrame) -> DataFrame:
    """Arrays and maps as text and size, so that every engine can compare them."""
    return metadata.withColumns(
        {"columns": F.array_join("columns", ","), "data_types": F.size("data_types")}
    )


def _metadata_statement(batch: Batch, counts: str, column: str) -> str:
    names = ",".join(f.name.upper() for f in staged_schema("orders").fields)
    return with_tables(
        f"""SELECT 'orders' AS table_name, '{batch.batch_id}' AS batch_id,
                   timestamp '{batch.loaded_at}' AS "timestamp", *,
                   historic_records + latest_records AS total_records,
                   '{column}' AS date_column_used, '{names}' AS columns, 14 AS data_types
            FROM (SELECT {counts} FROM s_orders)"""
    )


_LATE = f"order_date >= date '{LATEST_FROM}'"


@query(
    "metadata_initial_orders",
    _metadata_statement(
        FIRST,
        f"count(*) FILTER (order_date < date '{HISTORIC_TO}') AS historic_records,"
        f" count(*) FILTER ({_LATE}) AS latest_records,"
        f" min(order_date) FILTER ({_LATE}) AS min_date",
        "order_date",
    ),
)
def metadata_initial_orders(spark, folder):
    parts = [_orders_of(spark, folder, part) for part in (HISTORIC, LATEST)]
    extracted = ingest.tagged_parts(*parts)
    loaded = ingest.transform(extracted, "orders", FIRST)
    return _flat_metadata(ingest.batch_metadata(loaded, "orders", FIRST, extracted))


@query("metadata_written_orders", STATEMENTS["metadata_initial_orders"])
def metadata_written_orders(spark, folder):
    """The description that a written load leaves, counted while its rows were written."""
    root = _fresh(spark, "metadata_written_orders")
    read = lambda name, part: _orders_of(spark, folder, part)
    loads.load_initial(spark, read, "orders", f"{root}/raw", FIRST, f"{root}/copies")
    about = spark.read.schema(
        "table_name string, batch_id string, timestamp timestamp_ntz, historic_records long, latest_records long,"
        " total_records long, date_column_used string, columns array<string>, data_types map<string, string>,"
        " min_date timestamp_ntz"
    )
    return _flat_metadata(about.json(f"{root}/copies/orders/{FIRST.batch_id}/metadata"))


@query(
    "metadata_incremental_orders",
    _metadata_statement(
        SECOND,
        "count(*) FILTER (order_date < (SELECT min(order_date) FROM s_orders"
        f" WHERE {_LATE})) AS historic_records, count(*) FILTER ({_LATE}) AS latest_records,"
        " min(order_date) AS min_date",
        "ORDER_DATE",
    ),
)
def metadata_incremental_orders(spark, folder):
    loaded = load_incremental_orders(spark, folder)
    return _flat_metadata(ingest.batch_metadata(loaded, "orders", SECOND))


@query(
    "newer_than_orders",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >"
    f" (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < date '{LATEST_FROM}')",
)
def newer_than_orders(spark, folder):
    orders = shop.reader(spark, folder)("orders").select("o_orderkey", "o_orderdate")
    return combine.newer_than(orders, orders.where(f"o_orderdate < '{LATEST_FROM}'"), "o_orderdate")


@query(
    "newer_than_written_customer_orders",
    with_tables(
        "SELECT * FROM fct_customer_orders WHERE order_date >"
        f" (SELECT max(order_date) FROM s_orders WHERE order_date < date '{LATEST_FROM}')"
    ),
)
def newer_than_written_customer_orders(spark, folder):
    """An incremental run over tables that are sorted by the date that its mark is on.

    Lines, which have no such date, are bucketed by order, in as many buckets as shuffles have partitions.
    """
    w, (normalized, marts) = warehouse(spark, folder), _layers("normalized", "marts")
    tables.create_layers(spark, _fresh(spark, "layers"), (normalized, marts))
    names = ("orders", "order_items", "reviews_enriched")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables.refresh(w.table, normalized, names, buckets, by_mark=True)
    orders, lines, reviews = (spark.table(f"`{normalized}`.`{n}`") for n in names)
    held = facts.fct_customer_orders(orders.where(f"order_date < '{LATEST_FROM}'"), lines, reviews)
    tables.write_table(held, marts, "fct_customer_orders", sorted_by="order_date")
    held = spark.table(f"`{marts}`.fct_customer_orders")
    return facts.new_customer_orders(orders, lines, reviews, held)


@query(
    "newer_than_customer_orders",
    with_tables(
        "SELECT * FROM fct_customer_orders WHERE order_date >"
        f" (SELECT max(order_date) FROM s_orders WHERE order_date < date '{LATEST_FROM}')"
    ),
)
def newer_than_customer_orders(spark, folder):
    """The rows an incremental run adds to a fact that holds the earlier orders."""
    w = warehouse(spark, folder)
    lines = facts.known_product_lines(w.staged("order_items"), w.staged("products"))
    orders, reviews = w.staged("orders"), w.staged("reviews")
    held = facts.fct_customer_orders(orders.where(f"order_date < '{LATEST_FROM}'"), lines, reviews)
    return facts.new_customer_orders(orders, lines, reviews, held)


@query(
    "newer_than_customer_reviews",
    with_tables(
        """SELECT r.customer_id, r.product_id, r.order_id, r.review_score, r.review_text,
                  p.category_id, p.subcategory_id
           FROM s_reviews r JOIN s_products p ON p.product_id = r.product_id
           WHERE r.loaded_at > (SELECT max(loaded_at) FROM s_reviews
                                WHERE loaded_at < timestamp '2001-01-01')"""
    ),
)
def newer_than_customer_reviews(spark, folder):
    w = warehouse(spark, folder)
    reviews = w.staged("reviews")
    held = reviews.where("loaded_at < timestamp_ntz'2001-01-01 00:00:00'")
    return facts.new_customer_reviews(reviews, w.staged("products"), held)


@query(
    "dim_dates_by_day",
    """SELECT DISTINCT d AS date_day, cast(year(d) AS integer) AS year,
              cast(month(d) AS integer) AS month, cast(isodow(d) AS integer) AS day_of_week,
              cast(date_trunc('month', d) AS date) AS first_day_of_month,
              last_day(d) AS last_day_of_month
       FROM (SELECT cast(o_orderdate AS date) AS d FROM orders
             UNION ALL SELECT cast(ts AS date) FROM events)""",
)
def dim_dates_by_day(spark, folder):
    w = warehouse(spark, folder)
    return dimensions.dim_dates(w.staged("orders"), w.staged("interactions"), as_date=True)


_ACTIVITY = table("fct_customer_activity")


@query("upsert_customer_activity", _ACTIVITY)
def upsert_customer_activity(spark, folder):
    """Activity up to the middle of a month, then that month and later ones recomputed."""
    w = warehouse(spark, folder)
    events, middle = w.staged("interactions"), "2024-01-05 12:00:00"
    month_of_middle = temporal.month_start(F.lit(middle))
    seen = events.where(F.col("event_date") < middle)
    rest = events.where(temporal.month_start(F.col("event_date")) >= month_of_middle)
    return combine.upsert(
        facts.fct_customer_activity(w.customers_named, seen, shop.AS_OF),
        facts.fct_customer_activity(w.customers_named, rest, shop.AS_OF),
        ["customer_id", "activity_month"],
    )


@query("upsert_table_customer_activity", _ACTIVITY)
def upsert_table_customer_activity(spark, folder):
    """The same through a written table, partitioned by month."""
    w = warehouse(spark, folder)
    path = _fresh(spark, "upsert_table_customer_activity")
    events, middle = w.staged("interactions"), "2024-01-05 12:00:00"
    for part in (events.where(F.col("event_date") < middle), events):
        activity = facts.fct_customer_activity(w.customers_named, part, shop.AS_OF)
        tables.upsert_path(activity, path, ["customer_id", "activity_month"], "activity_month")
    return tables.read_upserted(spark, path)


_STREAMED = with_tables(
    "SELECT * REPLACE ('stream' AS batch_id, CASE WHEN event_date >= timestamp '2024-01-03'"
    " THEN 'late' ELSE 'early' END AS device_type) FROM s_interactions"
)


@query("stream_interactions", _STREAMED)
def stream_interactions(spark, folder):
    """Two deliveries through the file stream; the second corrects later events."""
    root = _fresh(spark, "stream_interactions")
    events = _landed(spark, folder, "interactions")
    late = F.col("event_date") >= "2024-01-03"
    deliveries = (
        events.withColumn("device_type", F.lit("early")),
        events.where(late).withColumn("device_type", F.lit("late")),
    )
    for rows in deliveries:
        rows.write.mode("append").json(f"{root}/landing")
        stream_into_raw(
            spark,
            f"{root}/landing",
            f"{root}/raw",
            "interactions",
            f"{root}/checkpoint",
            loaded_at=lambda number: f"2001-08-01 00:00:{number:02d}",
        ).awaitTermination()
    newest = stage(raw.read_raw(spark, f"{root}/raw", "interactions"), "interactions")
    return newest.withColumns(
        {"batch_id": F.lit("stream"), "loaded_at": temporal.moment(shop.LOADED_AT)}
    )


@query("stream_table_interactions", _STREAMED)
def stream_table_interactions(spark, folder):
    """Two deliveries into a table with one row per key; the second corrects later events."""
    root = _fresh(spark, "stream_table_interactions")
    events = _landed(spark, folder, "interactions")
    late = events.where(F.col("event_date") >= "2024-01-03").withColumn("device_type", F.lit("late"))
    for rows in (events.withColumn("device_type", F.lit("early")), late):
        rows.write.mode("append").json(f"{root}/landing")
        stream_into_table(
            spark,
            f"{root}/landing",
            f"{root}/table",
            "interactions",
            f"{root}/checkpoint",
            buckets=16,
        ).awaitTermination()
    return stage(read_streamed(spark, f"{root}/table"), "interactions").withColumns(
        {"batch_id": F.lit("stream"), "loaded_at": temporal.moment(shop.LOADED_AT)}
    )


# --- checks -------------------------------------------------------------------------------


@query(
    "unique_violations",
    with_tables(
        "SELECT order_id AS value, count(*) AS row_count FROM s_reviews GROUP BY 1 HAVING count(*) > 1"
    ),
)
def unique_violations(spark, folder):
    return quality.unique_violations(warehouse(spark, folder).staged("reviews"), "order_id")


_CUSTOMER_COLUMNS = [f.name for f in staged_schema("customers").fields]


@query(
    "null_violations",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS row_count FROM s_customers"
            for c in _CUSTOMER_COLUMNS
        )
    ),
)
def null_violations(spark, folder):
    return quality.null_violations(warehouse(spark, folder).staged("customers"), _CUSTOMER_COLUMNS)


@query(
    "orphan_violations",
    with_tables(
        "SELECT o.customer_id AS value, count(*) AS row_count FROM s_orders o"
        " LEFT JOIN customers_enriched c ON c.customer_id = o.customer_id"
        " WHERE c.customer_id IS NULL GROUP BY 1"
    ),
)
def orphan_violations(spark, folder):
    w = warehouse(spark, folder)
    return quality.orphan_violations(
        w.staged("orders"), "customer_id", w.table("customers_enriched"), "customer_id"
    )


def _oracle_name(table: str) -> str:
    if table in ("orders", "order_items"):
        return f"int_{table}"
    return table.replace("stg_", "s_")


def _check_statement(check: quality.Check, name) -> str:
    table = name(check.table)
    if check.kind == "not_null":
        count = f"SELECT count(*) FROM {table} WHERE {check.column} IS NULL"
    elif check.kind == "unique":
        count = (
            f"SELECT count(*) FROM (SELECT {check.column} FROM {table}"
            f" WHERE {check.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        )
    else:
        count = (
            f"SELECT count(*) FROM {table} x WHERE x.{check.column} IS NOT NULL AND NOT EXISTS"
            f" (SELECT 1 FROM {name(check.parent)} y WHERE y.{check.field} = x.{check.column})"
        )
    return (
        f"SELECT '{check.table}' AS table_name, '{check.column}' AS column_name,"
        f" '{check.kind}' AS check_name, '{check.severity}' AS severity,\n({count}) AS violations"
    )


def _suite_statement(suite, name=_oracle_name) -> str:
    body = "\nUNION ALL\n".join(_check_statement(c, name) for c in suite)
    return with_tables(
        "SELECT *, CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn'"
        f" ELSE 'fail' END AS status FROM (\n{body}\n)"
    )


def _written(spark: SparkSession, frames: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The frames, written once, so that checks read tables and build none of them again.

    Shuffles go with the table that they made, and of tables over order lines, which shuffle most, one is
    written at a time: the disks hold its shuffles beside the written tables. The other tables are written meanwhile.
    """

    def write(names: list[str]) -> None:
        for name in names:
            frames[name].write.option("compression", "zstd").parquet(f"{root}/{name}")

    over_lines = [n for n, f in frames.items() if any("/lineitem.parquet" in file for file in f.inputFiles())]
    others = [n for n in frames if n not in over_lines]
    with session.shuffles_end_with_queries(spark), ThreadPoolExecutor(2) as pool:
        list(pool.map(write, (over_lines, others)))
    return {name: spark.read.schema(f.schema).parquet(f"{root}/{name}") for name, f in frames.items()}


def _suite(name: str, suite, prefix: str = "", oracle_name=_oracle_name, layer: bool = False) -> None:
    """``layer``: the tables are written when the query is built, and checked as they stand there."""

    def run(spark, folder):
        w = warehouse(spark, folder)
        used = sorted({c.table for c in suite} | {c.parent for c in suite if c.parent})
        frames = {t: w.table(prefix + t) for t in used}
        if layer:
            frames = _written(spark, frames, _fresh(spark, name))
        return quality.run_checks(frames, suite)

    query(name, _suite_statement(suite, oracle_name))(run)


_suite("checks_raw", checks.RAW, "stg_", lambda t: f"s_{t}")
_suite("checks_raw_strict", checks.RAW_STRICT, "stg_", lambda t: f"s_{t}")
_suite("checks_staged", checks.STAGED)
_suite("checks_staged_strict", checks.STAGED_STRICT)
_suite("checks_normalized", checks.NORMALIZED, layer=True)
_suite("checks_marts", checks.MARTS, layer=True)

# --- earlier definitions ------------------------------------------------------------------


def _variant(name: str, statement: str) -> None:
    query(f"variant_{name}", statement)(
        lambda spark, folder: warehouse(spark, folder).table(name)
    )


_variant(
    "orders_by_load_time",
    with_tables(f"SELECT * REPLACE ({NOW} AS created_at) FROM int_orders"),
)
_variant(
    "order_items_newest_score",
    with_tables(
        """SELECT i.order_item_id, i.order_id, i.product_id, o.customer_id, i.quantity,
                  i.unit_price, i.total_price, p.category_id, p.subcategory_id, p.brand_id,
                  r.review_score, i.created_at
           FROM s_order_items i JOIN products_enriched p USING (product_id)
                LEFT JOIN s_orders o USING (order_id)
                LEFT JOIN (SELECT order_id, product_id,
                                  arg_max(review_score, (loaded_at, review_id)) AS review_score
                           FROM s_reviews GROUP BY 1, 2) r USING (order_id, product_id)"""
    ),
)
_variant(
    "customers_with_parsed_dates",
    with_tables(
        "SELECT customer_id, email, first_name, last_name, age, gender, annual_income, education_id,"
        " marital_status_id, location_id, signup_date, last_login, first_order_date,"
        " last_order_date, created_at FROM customers_enriched"
    ),
)
_variant("categories_by_using", with_tables("SELECT * FROM categories_enriched"))
