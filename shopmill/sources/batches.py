"""The batches of a raw table: one small row for each that was written whole.

A raw table is a folder with ``rows`` and ``batches``. An append writes its
rows to a folder of its own below ``rows`` and at last its row below ``batches``, which
says where the rows are, their columns, when they were loaded, and what was
counted while they were written. Readers take the folders that the list
names, so rows of an append that failed are never read.
"""

from __future__ import annotations

import json
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill import session

# Times are text as Spark writes them, so that no time is beyond the driver's types.
RECORD = (
    "batch_id string, folder string, columns string, first_loaded string, last_loaded string,"
    " replaces_from string, historic_records long, latest_records long, total_records long, min_date string,"
    " temporals string"
)
FIELDS = [f.split()[0] for f in RECORD.split(",")]


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def rows_path(root: str, table: str, folder: str) -> str:
    return f"{table_path(root, table)}/rows/{folder}"


def batches(spark: SparkSession, root: str, table: str) -> list[Row]:
    """The committed batches, by id; one row each."""
    path = f"{table_path(root, table)}/batches"
    if not session.exists(spark, path):
        return []
    return spark.read.schema(RECORD).option("recursiveFileLookup", True).parquet(path).orderBy("batch_id").collect()


def commit(spark: SparkSession, root: str, table: str, record: dict) -> None:
    """Add the batch to the list, in the place of one of its id."""
    values = [F.lit(record[name]).alias(name) for name in FIELDS]
    row = spark.range(1).select(*values).select(*(F.col(n).cast(k) for n, k in (f.split() for f in RECORD.split(","))))
    folder = f"{table_path(root, table)}/batches/{quote(record['batch_id'], safe='')}"
    row.coalesce(1).write.mode("overwrite").parquet(folder)


def columns_of(known: list[Row], new: T.StructType | None = None) -> T.StructType:
    """All columns of some batches; a column that changed its type is an error."""
    fields: dict[str, tuple[T.StructField, str]] = {}
    schemas = [(f"batch {b.batch_id}", T.StructType.fromJson(json.loads(b.columns))) for b in known]
    if new is not None:
        schemas.append(("the new batch", new))
    for source, schema in schemas:
        for field in schema.fields:
            old, where = fields.setdefault(field.name, (T.StructField(field.name, field.dataType), source))
            if old.dataType != field.dataType:
                kinds = f"{old.dataType.simpleString()} in {where}, {field.dataType.simpleString()} in {source}"
                raise ValueError(f"column {field.name} is {kinds}")
    return T.StructType([field for field, _ in fields.values()])


def temporals(known: list[Row]) -> dict[str, bool]:
    """Which text columns of an unknown table hold timestamps alone, in every batch that has them."""
    found: dict[str, bool] = {}
    for batch in known:
        for name, holds in json.loads(batch.temporals or "{}").items():
            found[name] = found.get(name, True) and holds
    return found


def cuts(spark: SparkSession, known: list[Row], key: str, name: str) -> DataFrame | None:
    """Per batch id the cuts of batches that were loaded after its first row; None without any.

    A batch whose rows have one load time needs one entry: the least cut. The frame
    is a local relation of one small row per batch, whose size Catalyst knows.
    """
    if not any(b.replaces_from for b in known):
        return None
    columns = ("batch_id", "first_loaded", "last_loaded", "replaces_from")
    rows = spark.createDataFrame(pa.table({c: pa.array([b[c] for b in known], pa.string()) for c in columns}))
    rows = rows.select(F.col("batch_id").alias(key), *(F.col(c).cast("timestamp_ntz").alias(c) for c in columns[1:]))
    pairs = F.collect_list(F.struct(F.col("last_loaded").alias("at"), F.col("replaces_from").alias("cut")))
    every = rows.where("replaces_from IS NOT NULL").select(pairs).scalar()
    rows = rows.withColumn("every", every)
    later = F.filter("every", lambda c: c["at"] > F.col("first_loaded"))
    least = F.struct(
        F.array_min(F.transform(later, lambda c: c["at"])).alias("at"),
        F.array_min(F.transform(later, lambda c: c["cut"])).alias("cut"),
    )
    one = (F.col("first_loaded") == F.col("last_loaded")) & (F.size(later) > 0)
    own = F.when(one, F.array(least)).otherwise(later)
    return rows.select(key, own.alias(name)).where(F.size(name) > 0)
