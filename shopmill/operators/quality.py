"""Data-quality checks. Each returns its violations as a frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
KINDS = ("unique", "not_null", "relationship")


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their row count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def null_violations(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per column with its number of NULLs; all columns in one pass."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("row_count")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def orphan_violations(
    child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Non-NULL child values the parent lacks, with their row count.

    Values are counted before the join, so a value in a third of all child rows
    is a single row there.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(field).alias("value"))
    return values.join(known, "value", "left_anti")


@dataclass(frozen=True)
class Check:
    table: str
    kind: str  # one of KINDS
    column: str
    parent: str | None = None
    field: str | None = None
    severity: str = ERROR


def unique(table: str, column: str, severity: str = ERROR) -> Check:
    return Check(table, "unique", column, severity=severity)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", c) for c in columns]


def relationship(
    table: str, column: str, parent: str, field: str, severity: str = ERROR
) -> Check:
    return Check(table, "relationship", column, parent, field, severity)


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: violations and pass, warn or fail.

    ``unique`` counts repeated values, the other two count rows. Table names are
    matched in any case. Every table is read once, whatever the number of its
    checks and of the tables that refer to it, and all values go through one
    shuffle. Values are counted on the map side first, so neither a frequent
    value nor a frequent orphan reaches one task as single rows.
    """
    checks = list(checks)
    frames = {name.lower(): df for name, df in tables.items()}
    domains, places = _places(checks)
    width = max(len(columns) for columns in domains)
    marked = reduce(DataFrame.unionAll, _marked(frames, domains, checks, places))

    # One row per domain and value: how many rows of each of the domain's columns hold it.
    held = [f"n_{i}" for i in range(width)]
    counts = marked.groupBy("domain", "value").agg(
        *[F.count_if(F.col("place") == i).alias(n) for i, n in enumerate(held)]
    )
    absent, orphan = F.col("value").isNull(), F.col(held[0]) == 0
    verdicts = counts.groupBy("domain").agg(
        *[
            F.struct(
                F.sum(F.when(absent, F.col(n))).alias("not_null"),
                F.count_if(~absent & (F.col(n) > 1)).alias("unique"),
                F.sum(F.when(~absent & orphan, F.col(n))).alias("relationship"),
            ).alias(n)
            for n in held
        ]
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(domain).alias("domain"),
                F.lit(place).alias("place"),
                F.lit(check.table).alias("table_name"),
                F.lit(check.column).alias("column_name"),
                F.lit(check.kind).alias("check_name"),
                F.lit(check.severity).alias("severity"),
            )
            for check, (domain, place) in zip(checks, places)
        ]
    )
    asked = marked.sparkSession.range(1).select(F.inline(listed))
    violations = F.coalesce(
        *[
            F.when((F.col("place") == i) & (F.col("check_name") == kind), F.col(f"{n}.{kind}"))
            for i, n in enumerate(held)
            for kind in KINDS
        ],
        F.lit(0),
    )
    return asked.join(verdicts, "domain", "left").select(
        "table_name",
        "column_name",
        "check_name",
        "severity",
        violations.cast("bigint").alias("violations"),
        F.when(violations == 0, "pass")
        .when(F.col("severity") == WARN, "warn")
        .otherwise("fail")
        .alias("status"),
    )


Column = tuple[str, str]  # table and column, as matched


def _places(checks: list[Check]) -> tuple[list[list[Column]], list[tuple[int, int]]]:
    """Columns whose values are compared (a domain), and each check's domain and place in it.

    A domain's first column is the parent, or the only one. A column that
    refers to a parent has its other checks there, too.
    """
    domains: list[list[Column]] = []
    by_parent: dict[Column, int] = {}

    def domain(parent: Column) -> int:
        if parent not in by_parent:
            by_parent[parent] = len(domains)
            domains.append([parent])
        return by_parent[parent]

    found: dict[int, tuple[int, int]] = {}
    refers: dict[Column, tuple[int, int]] = {}
    for number, check in enumerate(checks):
        if check.kind == "relationship":
            at, column = domain((check.parent.lower(), check.field)), (check.table.lower(), check.column)
            if column not in domains[at][1:]:
                domains[at].append(column)
            found[number] = at, domains[at].index(column, 1)
            refers.setdefault(column, found[number])
    for number, check in enumerate(checks):
        if number not in found:
            column = (check.table.lower(), check.column)
            own = column in by_parent or column not in refers
            found[number] = (domain(column), 0) if own else refers[column]
    return domains, [found[number] for number in range(len(checks))]


def _marked(
    frames: Mapping[str, DataFrame],
    domains: list[list[Column]],
    checks: list[Check],
    places: list[tuple[int, int]],
) -> list[DataFrame]:
    """Each table's checked values as ``domain, place, value``.

    A column that is only checked for NULLs contributes its NULL rows alone.
    """
    kinds: dict[tuple[int, int], set[str]] = {}
    for check, place in zip(checks, places):
        kinds.setdefault(place, set()).add(check.kind)
    marks: dict[str, list] = {}
    for at, columns in enumerate(domains):
        for place, (table, column) in enumerate(columns):
            value = F.col(column)
            mark = F.struct(
                F.lit(at).alias("domain"),
                F.lit(place).alias("place"),
                value.cast("string").alias("value"),
            )
            if len(columns) == 1 and kinds[at, place] == {"not_null"}:
                mark = F.when(value.isNull(), mark)
            marks.setdefault(table, []).append(mark)
    return [
        frames[table].select(F.inline(F.array_compact(F.array(*own)))) for table, own in marks.items()
    ]


def enforce(results: DataFrame) -> None:
    """Raise if any check failed; warnings pass. One row per check reaches the driver."""
    failed = [
        f"{r.check_name}({r.table_name}.{r.column_name}): {r.violations}"
        for r in results.where("status = 'fail'").collect()
    ]
    if failed:
        raise ValueError("data-quality checks failed: " + "; ".join(failed))
