"""Database source and sink over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmill.registry import LATEST_PREFIX


def table_name(table: str, part: str = "historic") -> str:
    """The latest part of a table lives in a prefixed table of its own."""
    return f"{LATEST_PREFIX}{table}" if part == "latest" else table


def read_options(
    url: str,
    table: str,
    part: str = "historic",
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options; with an integer ``key`` and its bounds the read is parallel.

    Bounds only decide how rows are spread: rows outside them are read as well.
    """
    options = {"url": url, "dbtable": table_name(table, part), "fetchsize": str(fetch_rows)}
    if key is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the key's lower and upper bound")
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def key_bounds(spark: SparkSession, url: str, table: str, part: str, key: str) -> tuple[int, int]:
    """Smallest and largest key, computed by the database."""
    query = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table_name(table, part)}"
    row = spark.read.format("jdbc").options(url=url, query=query).load().first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    part: str = "historic",
    key: str | None = None,
    partitions: int = 64,
    single_task: bool = False,
    **connection: str,
) -> DataFrame:
    """A table, read in parallel by an integer ``key``; without one a single task must be asked for."""
    if key is None and not single_task:
        raise ValueError("name an integer key to read by, or ask for a single task")
    bounds = key_bounds(spark, url, table, part, key) if key else None
    options = read_options(url, table, part, key, bounds, partitions)
    return spark.read.format("jdbc").options(**options, **connection).load()


def write_options(
    url: str, table: str, batch_rows: int = 100_000, connections: int = 32
) -> dict[str, str]:
    """``truncate`` replaces the rows but keeps the target's own types and grants.

    ``connections`` bounds how many tasks write at a time.
    """
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        "truncate": "true",
    }


def replace_table(df: DataFrame, url: str, table: str, **connection: str) -> None:
    options = write_options(url, table)
    df.write.format("jdbc").options(**options, **connection).mode("overwrite").save()
