"""Keep-first deduplication and distinct dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_keep_first_rank"


def dedup_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given total order; a null key is one group.

    The filter on ``row_number`` makes Spark rank and cut inside every map task
    (a partial window group limit) before it shuffles, so a key that holds a
    third of all rows contributes one row per task, and unlike ``min_by`` over
    a struct of all columns it lets unused columns be pruned below.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def dedup_report(df: DataFrame, key: str) -> DataFrame:
    """One row: input, kept and removed row counts of ``dedup_first`` on the key."""
    kept = F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("input_rows"), kept.cast("long").alias("kept_rows")).withColumn(
        "removed_rows", F.col("input_rows") - F.col("kept_rows")
    )


def plus_unknown(members: DataFrame, unknown: Sequence[Column]) -> DataFrame:
    """Members followed by one extra row for "unknown"."""
    row = members.sparkSession.range(1).select(
        *[value.cast(f.dataType).alias(f.name) for value, f in zip(unknown, members.schema, strict=True)]
    )
    return members.unionAll(row)


def distinct_plus_unknown(members: DataFrame, unknown: Sequence[Column]) -> DataFrame:
    """Distinct members followed by one extra row for "unknown"."""
    return plus_unknown(members.distinct(), unknown)
