"""Upsert as a DataFrame operation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target with the source rows replacing those of equal key and adding the rest.

    The source must hold a key at most once (``sources.tables.upsert_table``
    checks it).  A null key equals nothing: such rows are kept on both sides,
    and they bypass the join so that they cannot pile up in one task.
    """
    if key not in source.columns:
        raise ValueError(f"key column {key!r} is not in the source")
    return replace_keys(target, source, source.select(key), key)


def replace_keys(target: DataFrame, source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Target without its rows of any of ``keys``, and all rows of the source; null keys as in ``upsert``."""
    keyed = target.where(F.col(key).isNotNull())
    unkeyed = target.where(F.col(key).isNull())
    kept = keyed.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_anti").select(*target.columns)
    return kept.unionByName(unkeyed).unionByName(source.select(*target.columns))
