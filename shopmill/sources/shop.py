"""The shop's raw tables, derived from a folder of order-processing parquet.

``lineitem`` gives the order lines, ``part`` the catalogue, ``events`` the
interactions; every third line or so is reviewed. Frames are lazy and read only
the columns a caller uses.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.registry import staged_schema

AS_OF = "2001-08-01"
LOADED_AT = "2001-08-01 00:00:00"
BATCH_ID = "batch-1"


def _audited(df: DataFrame, table: str, **expressions: str) -> DataFrame:
    audit = {
        "data_source": "'historic'",
        "batch_id": f"'{BATCH_ID}'",
        "loaded_at": f"timestamp_ntz'{LOADED_AT}'",
    }
    columns = {**audit, **expressions}
    return df.selectExpr(
        *[
            f"{columns[f.name]} as {f.name}"
            if f.name in columns
            else f"cast(null as {f.dataType.simpleString()}) as {f.name}"
            for f in staged_schema(table).fields
        ]
    )


def nation_places(read: Callable[[str], DataFrame]) -> DataFrame:
    """Nation and region name of each nation key."""
    return (
        read("nation")
        .join(read("region"), F.expr("n_regionkey = r_regionkey"))
        .groupBy(F.col("n_nationkey").alias("nation_key"))
        .agg(F.max("n_name").alias("n_name"), F.max("r_name").alias("r_name"))
    )


def customer_nations(read: Callable[[str], DataFrame]) -> DataFrame:
    """Nation key of each customer key.

    Here and above, grouping by the key states that it is unique, so Catalyst
    drops the joins to these frames wherever no address column is used.
    """
    return (
        read("customer")
        .groupBy(F.col("c_custkey").alias("customer_key"))
        .agg(F.max("c_nationkey").alias("customer_nation"))
    )


def categories(read) -> DataFrame:
    return _audited(
        read("part").select("p_type").distinct(),
        "categories",
        category_id="p_type",
        category_name="concat('Category ', p_type)",
        created_at="date'1995-01-01'",
    )


def subcategories(read) -> DataFrame:
    return _audited(
        read("part").select("p_type", "p_size").distinct(),
        "subcategories",
        subcategory_id="concat(p_type, '-', cast(p_size as string))",
        category_id="p_type",
        subcategory_name="concat('Size ', cast(p_size as string))",
        created_at="date'1995-01-01'",
    )


def products(read) -> DataFrame:
    price = "cast(p_retailprice as decimal(12,2))"
    return _audited(
        read("part"),
        "products",
        product_id="cast(p_partkey as string)",
        category_id="p_type",
        subcategory_id="concat(p_type, '-', cast(p_size as string))",
        product_name="p_name",
        base_price=price,
        sale_price=f"cast({price} * cast(80 + p_partkey % 21 as decimal(5,0)) / 100"
        " as decimal(12,2))",
        stock_quantity="cast(p_partkey * 37 % 1001 as int)",
        is_active="p_partkey % 10 <> 0",
        brand="case when p_partkey % 50 = 0 then cast(null as string)"
        " when p_partkey % 51 = 0 then '  '"
        " when p_partkey % 7 = 0 then concat(' ', p_brand, ' ') else p_brand end",
    )


def customers(read) -> DataFrame:
    """``last_login`` stays raw text, with '' and 'null' for missing."""
    rows = (
        read("customer")
        .join(read("nation"), F.expr("c_nationkey = n_nationkey"))
        .join(read("region"), F.expr("n_regionkey = r_regionkey"))
    )
    return _audited(
        rows,
        "customers",
        customer_id="cast(c_custkey as string)",
        email="lower(concat(c_name, '@example.com'))",
        age="cast(18 + c_custkey % 73 as int)",
        gender="case c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'Other' end",
        annual_income="cast(c_acctbal + 15000 as decimal(12,2))",
        marital_status="case c_custkey % 4 when 0 then 'Single' when 1 then 'Married'"
        " when 2 then 'Divorced' else 'Widowed' end",
        education="c_mktsegment",
        city="case when c_custkey % 97 = 0 then '' when c_custkey % 89 = 0 then cast(null as string)"
        " else concat(' City ', cast(c_custkey % 40 as string)) end",
        state="n_name",
        country="r_name",
        signup_date="cast(date'1994-01-01' + cast(c_custkey % 365 as int) as timestamp_ntz)",
        last_login="case when c_custkey % 11 = 0 then 'null' when c_custkey % 13 = 0 then ''"
        " else cast(date'1995-01-01' + cast(c_custkey % 300 as int) as string) end",
    )


def orders(read) -> DataFrame:
    def address(bare: str) -> str:
        street = "concat(cast(o_orderkey % 500 as string), ' Main St'"
        return (
            f"case when {bare} then {street}) else {street}, ', ',"
            " cast(10000 + o_custkey % 50 as string), ', City ',"
            " cast(o_custkey % 40 as string), ', ', n_name, ', ', r_name) end"
        )

    rows = (
        read("orders")
        .join(customer_nations(read), F.expr("o_custkey = customer_key"), "left")
        .join(nation_places(read), F.expr("customer_nation = nation_key"), "left")
    )
    return _audited(
        rows,
        "orders",
        order_id="cast(o_orderkey as string)",
        customer_id="cast(o_custkey as string)",
        order_date="o_orderdate",
        status="o_orderstatus",
        total_amount="cast(o_totalprice as decimal(12,2))",
        shipping_cost="cast(5 + (o_orderkey % 1500) / 100.0 as decimal(12,2))",
        payment_method="o_orderpriority",
        shipping_address=address("o_orderkey % 10 = 0"),
        billing_address=address("o_orderkey % 7 = 0"),
        created_at="o_orderdate",
    )


def order_items(read) -> DataFrame:
    cents = "round(l_extendedprice * 100)"
    return _audited(
        read("lineitem"),
        "order_items",
        order_item_id="concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',"
        " cast(l_partkey as string), '-', cast(l_suppkey as string), '-',"
        f" cast(cast({cents} as bigint) as string))",
        order_id="cast(l_orderkey as string)",
        product_id="cast(l_partkey as string)",
        quantity="cast(l_quantity as int)",
        unit_price=f"cast(cast(floor({cents} / l_quantity) as decimal(14,0)) / 100"
        " as decimal(12,2))",
        total_price="cast(l_extendedprice as decimal(12,2))",
        created_at="l_shipdate",
    )


def interactions(read) -> DataFrame:
    return _audited(
        read("events"),
        "interactions",
        event_id="cast(event_id as string)",
        customer_id="cast(user_id as string)",
        product_id="get_json_object(props, '$.k')",
        event_type="case event_type when 'click' then 'cart_add' when 'signup' then 'wishlist_add'"
        " when 'error' then 'cart_remove' else event_type end",
        event_date="ts",
        device_type="case event_id % 3 when 0 then 'desktop' when 1 then 'mobile'"
        " else 'tablet' end",
        session_id="concat('session_', cast(user_id as string), '_',"
        " cast(cast(ts as date) as string))",
        created_at="ts",
    )


def reviews(read) -> DataFrame:
    """Joined by the order's id as text, so that the rows lie by ``order_id`` for what follows."""
    reviewed = read("lineitem").where("(l_orderkey + l_partkey) % 3 = 0")
    buyers = read("orders").select("o_orderkey", "o_custkey")
    return _audited(
        reviewed.join(buyers, F.expr("cast(l_orderkey as string) = cast(o_orderkey as string)")),
        "reviews",
        review_id="concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',"
        " cast(l_partkey as string), '-', cast(l_suppkey as string))",
        product_id="cast(l_partkey as string)",
        order_id="cast(l_orderkey as string)",
        customer_id="cast(o_custkey as string)",
        review_score="cast(1 + (l_orderkey * 7 + l_partkey + l_linenumber) % 5 as int)",
        review_text="concat('Review for product ', cast(l_partkey as string))",
        loaded_at="l_shipdate",
    )


BUILDERS = {
    "categories": categories,
    "subcategories": subcategories,
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "interactions": interactions,
    "reviews": reviews,
}


@cache
def _schema(application: str, path: str) -> T.StructType:
    """Schema from the file footer, read once per application and path."""
    return SparkSession.active().read.parquet(path).schema


def reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    def read(name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}.parquet"
        schema = _schema(spark.sparkContext.applicationId, path)
        return spark.read.schema(schema).parquet(path)

    return read


def raw_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return BUILDERS[table](reader(spark, folder))
