"""From landed files through raw, normalized and mart tables to the checks."""

from __future__ import annotations

import __spark_entry__ as contract
from conftest import rows
from contract.queries import warehouse
from pyspark.sql import functions as F

from shopmill.operators import quality
from shopmill.operators.ingest import HISTORIC, LATEST, Batch
from shopmill.plans import checks, loads, tables
from shopmill.plans.warehouse import MARTS, NORMALIZED, Warehouse
from shopmill.registry import DATABASE_TABLES, TABLES, landing_schema
from shopmill.sources import files, raw, shop

FOLDER, AS_OF = contract.SMOKE_DATA, shop.AS_OF
FIRST = Batch("b1", "2001-08-01 00:00:00")


def land(spark, path):
    """All tables as files: two parts that overlap and share keys."""
    for table in TABLES:
        df = shop.raw_table(spark, FOLDER, table)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in landing_schema(table).fields])
        split = F.pmod(F.xxhash64(F.col(landing_schema(table).names[0])), F.lit(3))
        stale = df.columns[-1]
        history = df.where(split < 2).withColumn(
            stale, F.when(split == 1, F.lit(None).cast(df.schema[stale].dataType)).otherwise(F.col(stale))
        )
        history.write.json(files.json_path(path, table, HISTORIC))
        df.where(split >= 1).write.json(files.json_path(path, table, LATEST))


def test_whole_flow(spark, path):
    land(spark, f"{path}/landing")

    def read(table, part):
        return files.read_json_lines(spark, files.json_path(f"{path}/landing", table, part), table)

    loads.require_loaded(loads.run_loads(spark, loads.load_initial, read, f"{path}/raw", FIRST))
    built = Warehouse(lambda t: raw.read_raw(spark, f"{path}/raw", t), AS_OF, newest=False)
    direct = warehouse(spark, FOLDER)

    # reviews get the load time of the batch, so what depends on it may differ
    dated_by_load = {"reviews_enriched": ["created_at"], "order_items": ["review_score"],
                     "customers_enriched": ["created_at"]}
    tables.create_layers(spark, f"{path}/layers", ["flow_normalized", "flow_marts"])
    tables.refresh(built.table, "flow_normalized", NORMALIZED)
    for name in NORMALIZED:
        skip = dated_by_load.get(name, [])
        left = spark.table(f"flow_normalized.{name}").drop(*skip)
        assert rows(left) == rows(direct.table(name).drop(*skip)), name

    marts = tables.marts_over_tables(lambda t: spark.table(f"flow_normalized.{t}"), AS_OF)
    tables.refresh(lambda name: marts[name](), "flow_marts", marts)
    for name in MARTS:
        left = spark.table(f"flow_marts.{name}").drop("created_at")
        assert rows(left) == rows(direct.table(name).drop("created_at")), name

    written = {t: spark.table(f"flow_normalized.{t}") for t in NORMALIZED}
    written |= {t: spark.table(f"flow_marts.{t}") for t in MARTS}
    results = quality.run_checks(written, checks.NORMALIZED + checks.MARTS).collect()
    assert len(results) == 88
    broken = {(r.table_name, r.column_name) for r in results if r.status == "fail"}
    # customers without a complete place are dropped, their orders and events are not
    assert ("orders", "customer_id") in broken
    assert not [r for r in results if r.status == "fail" and r.check_name != "relationship"]


def test_database_tables_come_first():
    assert TABLES[:4] == DATABASE_TABLES
