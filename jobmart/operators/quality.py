"""Data-quality checks as rows of a report.

Every check is a small specification; ``quality_report`` evaluates all checks
that need data in one aggregation over the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = "check_name string, column_name string, passed boolean, violations bigint"


class QualityError(ValueError):
    """Raised by ``raise_on_fail``."""


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    violations: Column | int | None  # an aggregate, a count known from the schema alone, or none: repeated values


def check_columns(df: DataFrame, expected: Iterable[str]) -> list[Check]:
    """Required columns that are missing; needs no data."""
    return [Check("columns", c, int(c not in df.columns)) for c in expected]


def check_types(df: DataFrame, expected: Mapping[str, str | T.DataType]) -> list[Check]:
    """Columns whose type is not exactly the expected one; needs no data."""
    checks = []
    for column, wanted in expected.items():
        _require(df, column)
        wanted = T._parse_datatype_string(wanted) if isinstance(wanted, str) else wanted
        checks.append(Check("types", column, int(df.schema[column].dataType != wanted)))
    return checks


def check_not_empty(df: DataFrame) -> list[Check]:
    return [Check("not_empty", "*", (F.count(F.lit(1)) == 0).cast("long"))]


def check_no_nulls(df: DataFrame, columns: Sequence[str]) -> list[Check]:
    """Null count per column; an empty table has none."""
    for column in columns:
        _require(df, column)
    return [Check("no_nulls", c, F.count_if(F.col(c).isNull())) for c in columns]


def check_unique(df: DataFrame, column: str) -> list[Check]:
    """Rows beyond the distinct values, with null counted as one value."""
    _require(df, column)
    return [Check("unique", column, None)]


def _require(df: DataFrame, column: str) -> None:
    if column not in df.columns:
        raise QualityError(f"column {column!r} not found")


def _repeats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``place`` of each column and ``n``, its rows beyond the distinct values.

    Values are counted by a 128-bit hash, so rows of fixed width are summed up
    inside the map tasks and moved, however long the values are.
    """
    keys = [
        F.struct(F.lit(i).alias("place"), F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"), F.col(c).isNull().alias("none"))
        for i, c in enumerate(columns)
    ]
    per_value = df.select(F.inline(F.array(*keys))).groupBy("place", "a", "b", "none").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("place").agg((F.sum("n") - F.count(F.lit(1))).alias("n"))


def quality_report(df: DataFrame, *checks: list[Check]) -> DataFrame:
    """One row per check: one aggregation for all checks of counts, and one for all of uniqueness."""
    flat = [c for group in checks for c in group]
    aggregates = [c.violations for c in flat if isinstance(c.violations, Column)]
    unique = [c for c in flat if c.violations is None]
    if aggregates:
        base = df.agg(*[a.cast("long").alias(f"v{i}") for i, a in enumerate(aggregates)])
    else:
        base = df.sparkSession.range(1)
    if unique:
        repeats = _repeats(df, list(dict.fromkeys(c.column for c in unique)))
        found = repeats.agg(F.map_from_entries(F.collect_list(F.struct("place", "n"))))  # a row per checked column
        base = base.withColumn("repeats", found.scalar())
    positions = iter(range(len(aggregates)))
    places = {c: i for i, c in enumerate(dict.fromkeys(c.column for c in unique))}
    rows = []
    for check in flat:
        if check.violations is None:
            count = F.coalesce(F.col("repeats")[places[check.column]], F.lit(0)).cast("long")
        elif isinstance(check.violations, int):
            count = F.lit(check.violations).cast("long")
        else:
            count = F.col(f"v{next(positions)}")
        rows.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.column).alias("column_name"),
                (count == 0).alias("passed"),
                count.alias("violations"),
            )
        )
    return base.select(F.inline(F.array(*rows)))


def raise_on_fail(report: DataFrame) -> None:
    """Raise with the failed checks; the report holds one row per check, so it is small."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r.check_name}({r.column_name}): {r.violations}" for r in failed))
