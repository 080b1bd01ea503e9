"""File sources: JSON envelopes, JSON lines and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.registry import landing_schema

# Fields of the envelope's metadata.
ENVELOPE_METADATA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("recordCount", T.LongType()),
        T.StructField("generatedAt", T.StringType()),
        T.StructField("version", T.StringType()),
    ]
)


def json_path(root: str, table: str, part: str) -> str:
    """Each part has its own root; the table name is the same in both."""
    return f"{root.rstrip('/')}/{part}/json/{table}.json"


def csv_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/historic/csv/{table}.csv"


def read_envelopes(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    rows: T.StructType | None = None,
    one_per_line: bool = False,
) -> DataFrame:
    """Rows of ``{"metadata": {...}, "data": [...]}`` documents.

    A file holds one document, or one per line. A document is read by one task,
    so ``path`` should be a folder of many moderate documents; a huge table
    belongs into JSON lines without envelope.
    """
    rows = rows or landing_schema(table)
    schema = T.StructType(
        [
            T.StructField("metadata", ENVELOPE_METADATA),
            T.StructField("data", T.ArrayType(rows)),
        ]
    )
    documents = spark.read.schema(schema).json(path, multiLine=not one_per_line)
    return documents.select(F.inline("data"))


def read_json_lines(
    spark: SparkSession, path: str, table: str | None = None, rows: T.StructType | None = None
) -> DataFrame:
    """One row per line; a file splits over many tasks."""
    return spark.read.schema(rows or landing_schema(table)).json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    rows: T.StructType | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """CSV with a header line. Rows hold the columns of ``rows`` in order.

    Quotes inside a value are doubled, as in RFC 4180. An empty value, quoted
    or not, is NULL. A huge file splits over tasks. Where values may hold line
    breaks, ``line_breaks=True`` reads them, with one task per file: such a table
    should be a folder of bounded files, as ``write_csv`` makes it.
    """
    rows = rows or landing_schema(table, audit=True)
    return (
        spark.read.schema(rows)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .csv(path)
    )
