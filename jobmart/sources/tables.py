"""Named tables through the session catalog: read, stage, append, upsert, clear.

A table of a plain file format is an external one in a folder of its own version, ``<namespace>/<table>-<id>``.  New
contents are always written to a new folder; then the catalog is told the new place, of the whole table or of single
partitions.  No job overwrites files that exist, so results do not depend on the session's mode of overwriting.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobmart.operators.merge import replace_keys

NAMESPACES = ["bronze", "silver", "gold", "staging"]
# New contents beside their table, and the property that marks them as complete.
_NEXT, _READY = "__next", "replacement_is_complete"
# Property that holds a count of the rows written; columns that only such counts use begin with the second.
_OBSERVED, CHECKED = "observed.", "_checked_"
# Partition of a table that is upserted by key, and of one that is appended to by run.
BUCKET, RUN = "key_bucket", "load_run"
# Folder of switched partitions in their table's folder.
_PARTS = "_parts"
# Providers that can merge in place; for others an upsert rewrites the table.
_MERGING_PROVIDERS = ("iceberg", "delta")


# -- catalog ------------------------------------------------------------------


def ensure_namespaces(spark: SparkSession, location: str | None = None, prefix: str = "") -> None:
    """Create the four namespaces, below a folder if one is given."""
    for name in NAMESPACES:
        where = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name}{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def get_or_create_table(
    df: DataFrame, name: str, partition_by: str | None = None, provider: str = "parquet"
) -> DataFrame:
    """The table, created empty with the schema of ``df`` if it does not exist."""
    finish_replacement(df.sparkSession, name)
    if not table_exists(df.sparkSession, name):
        _write(df.limit(0), name, provider, *filter(None, [partition_by]))
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop the table and its folder; files of external tables that others made stay."""
    if not table_exists(spark, name):
        return False
    folder = _described(spark, name).get("Location", "")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if folder.rstrip("/").split("/")[-1].startswith(f"{name.split('.')[-1]}-"):
        _delete(spark, folder)
    return True


def recreate_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Drop the table and create it empty with the schema of ``df``."""
    drop_table(df.sparkSession, name)
    return get_or_create_table(df, name, partition_by)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    tables = spark.sql(f"SHOW TABLES IN {namespace}")
    return tables.select(F.col("namespace"), F.col("tableName").alias("table_name"))


# -- data ---------------------------------------------------------------------


def read_table(spark: SparkSession, name: str, allow_empty: bool = False) -> DataFrame:
    """A table that must exist and, unless allowed, hold rows; without the columns that keep its partitions apart."""
    finish_replacement(spark, name)
    if not table_exists(spark, name):
        raise ValueError(f"table {name} does not exist")
    table = spark.table(name).drop(BUCKET, RUN)
    if not allow_empty and table.isEmpty():
        raise ValueError(f"table {name} has no rows")
    return table


def overwrite_table(
    df: DataFrame, name: str, allow_empty: bool = False, counts: dict[str, Column] | None = None
) -> int:
    """Replace the contents of a table, of all its partitions too, and return its rows.

    The new contents are written beside the table, so ``df`` may read the table
    it replaces, a failed job leaves the old contents, and an empty result is
    refused before anything is lost.  Complete contents are marked first; from
    then on every function here that meets the table finishes the replacement,
    so neither the old nor the new rows can be lost by a crash in between.
    Outside ``staging`` the schema must not change; columns may come in any
    order.  Format, partitioning and properties of the table stay.

    ``counts`` names conditions, which may use columns of ``df`` that the table
    has not: rows that meet each are counted while they are written, and
    ``observed`` tells the numbers as long as these contents are in place.
    """
    spark = df.sparkSession
    beside = name + _NEXT
    finish_replacement(spark, name)
    drop_table(spark, beside)
    partition_by, provider, properties = [], "parquet", {}
    if table_exists(spark, name):
        table = spark.table(name)
        provider, properties = _provider(spark, name), _properties(spark, name)
        properties = {k: v for k, v in properties.items() if k != _READY and not k.startswith(_OBSERVED)}
    if counts:
        seen = Observation()
        met = [F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(counts.values())]
        df = df.observe(seen, *met).drop(*[c for c in df.columns if c.startswith(CHECKED)])
    if table_exists(spark, name):
        if set(df.columns) == set(table.columns):
            df = df.select(*table.columns)
            partition_by = _partition_columns(spark, name)
        if not _is_staging(name):
            _require_same_schema(df, table, name)
    rows = _write(df, beside, provider, *partition_by)
    if rows == 0 and not allow_empty:
        drop_table(spark, beside)
        raise ValueError(f"refusing to store an empty result in {name}")
    if counts:
        # Names in hexadecimal: Spark hides properties with words like ``url`` in them.
        properties |= {f"{_OBSERVED}{k.encode().hex()}": str(seen.get[f"c{i}"]) for i, k in enumerate(counts)}
    _set_properties(spark, beside, properties | {_READY: "true"})
    finish_replacement(spark, name)
    return rows


def observed(spark: SparkSession, name: str) -> dict[str, int]:
    """What ``overwrite_table`` counted while it wrote the present contents; empty if nothing."""
    found = {k.removeprefix(_OBSERVED): v for k, v in _properties(spark, name).items() if k.startswith(_OBSERVED)}
    return {bytes.fromhex(k).decode(): int(v) for k, v in found.items()}


def finish_replacement(spark: SparkSession, name: str) -> bool:
    """Bring complete new contents into place, if a replacement of the table was interrupted after it had them.

    Both tables are entries of the catalog; renaming one moves no file, and its partitions keep their places.
    """
    beside = name + _NEXT
    if not table_exists(spark, beside):
        if table_exists(spark, name) and _READY in _properties(spark, name):
            spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{_READY}')")
        return False
    if _READY not in _properties(spark, beside):
        return False
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{_READY}')")
    return True


def append_table(df: DataFrame, name: str, partition_by: str | None = None, run: str | None = None) -> int:
    """Append rows, creating the table if needed, and return how many the input held.

    With ``run`` the rows are a partition of that name, in a column ``load_run``
    after the table's own: appending again under the same name replaces them, so
    that a lost append can simply be run again, and other runs' rows stay.
    """
    if run is not None:
        return _append_run(df, name, run)
    table = get_or_create_table(df, name, partition_by)
    counted, rows = _counted(df.select(*table.columns))
    counted.write.insertInto(name)
    return rows()


def _append_run(df: DataFrame, name: str, run: str) -> int:
    tagged = df.withColumn(RUN, F.lit(run))
    table = get_or_create_table(tagged, name, RUN)
    if RUN not in _partition_columns(df.sparkSession, name):
        raise ValueError(f"table {name} is not kept by run")
    return switch_partitions(tagged.select(*table.columns), name, RUN, [run])


def switch_partitions(df: DataFrame, name: str, column: str, values: list) -> int:
    """Replace the partitions of these values by the rows of ``df``, which has no others; returns its rows.

    The rows are written to a folder of their own, so ``df`` may read what it
    replaces.  Then one partition after the other gets its new place, and old
    files go last: a failure in between leaves each partition either old or new,
    and files of other partitions are never touched.  A value without rows loses
    its partition.  Values are as many catalog calls, so their number must be bounded.
    """
    spark = df.sparkSession
    folder = f"{_described(spark, name)['Location']}/{_PARTS}/{uuid.uuid4().hex}"
    counted, rows = _counted(df)
    counted.write.format(_provider(spark, name)).partitionBy(column).save(folder)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    old, new = [], []
    for value in values:
        spec = f"PARTITION ({column} = {_literal(value)})"
        path = f"{folder}/{column}={value}"
        if f"{column}={value}" in known:
            old.append(_described(spark, name, spec)["Location"])
            if _exists(spark, path):
                spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION {_literal(path)}")
            else:
                spark.sql(f"ALTER TABLE {name} DROP {spec}")
        elif _exists(spark, path):
            new.append(f"{spec} LOCATION {_literal(path)}")
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
    spark.catalog.refreshTable(name)
    for path in old:
        _delete(spark, path)
    return rows()


def upsert_table(df: DataFrame, name: str, key: str, buckets: int | None = None) -> int:
    """Update rows of equal key and insert the others; returns the rows of the input.

    Tables of a format that can merge are merged in place, which rewrites only
    the files touched.  With ``buckets``, a table of another format is created
    with that many partitions by a hash of the key, in a column ``key_bucket``
    after its own, and only partitions that hold a key of the input are written
    again; later calls find the number of buckets in the table's properties.
    Otherwise the whole table is rewritten beside and swapped.  A key that occurs
    twice in the input is an error.
    """
    if key not in df.columns:
        raise ValueError(f"key column {key!r} is not in the input")
    rows, repeated = _count_and_repeats(df, key)
    if repeated:
        raise ValueError(f"{repeated} values of key {key!r} occur more than once in the input")
    if rows == 0:
        return 0
    spark = df.sparkSession
    finish_replacement(spark, name)
    if table_exists(spark, name) and _provider(spark, name) in _MERGING_PROVIDERS:
        match = F.col(f"source.{key}") == F.col(f"{name}.{key}")
        df.alias("source").mergeInto(name, match).whenMatched().updateAll().whenNotMatched().insertAll().merge()
    else:
        replace_by_key(df, df.select(key), name, key, buckets)
    return rows


def replace_by_key(df: DataFrame, keys: DataFrame, name: str, key: str, buckets: int | None = None) -> int:
    """Replace all stored rows of ``keys`` by those of ``df``, which has no other keys; returns the rows of ``df``.

    A key may have any number of rows.  Without ``buckets``, or if the table was
    created without, all of it is rewritten; see ``upsert_table``.
    """
    spark = df.sparkSession
    finish_replacement(spark, name)
    if buckets and not table_exists(spark, name):
        _write(df.withColumn(BUCKET, F.lit(0)).limit(0), name, "parquet", BUCKET)
        _set_properties(spark, name, {BUCKET: str(buckets)})
    table = get_or_create_table(df, name)
    if BUCKET not in _partition_columns(spark, name):
        written, rows = _counted(df.select(*table.columns))
        overwrite_table(replace_keys(table, written, keys, key), name, allow_empty=True)
        return rows()
    bucket = F.pmod(F.xxhash64(key), F.lit(int(_properties(spark, name)[BUCKET]))).cast("int")
    # At most ``buckets`` numbers: they prune the partitions that are read.
    touched = [r[0] for r in keys.select(bucket.alias("bucket")).distinct().collect()]
    source, rows = _counted(df.withColumn(BUCKET, bucket).select(*table.columns))
    stored = table.where(F.col(BUCKET).isin(touched))
    switch_partitions(replace_keys(stored, source, keys, key).select(*table.columns), name, BUCKET, touched)
    return rows()


def clear_tables(spark: SparkSession, names: list[str]) -> dict[str, int]:
    """Empty the tables and keep their schema; a missing table counts as cleared."""
    for name in names:
        if table_exists(spark, name):
            overwrite_table(spark.table(name).limit(0), name, allow_empty=True)
    return {name: 0 for name in names}


# -- helpers ------------------------------------------------------------------


def _counted(df: DataFrame):
    """The same rows, and a function that gives their number once they were written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get.get("rows") or 0


def _write(df: DataFrame, name: str, provider: str, *partition_by: str) -> int:
    """A new table; of a plain format in a folder of its own."""
    counted, rows = _counted(df)
    writer = counted.write.format(provider).partitionBy(*partition_by)
    if provider not in _MERGING_PROVIDERS:
        namespace, table = name.split(".") if "." in name else (df.sparkSession.catalog.currentDatabase(), name)
        base = df.sparkSession.catalog.getDatabase(namespace).locationUri
        writer = writer.option("path", f"{base}/{table.removesuffix(_NEXT)}-{uuid.uuid4().hex}")
    writer.saveAsTable(name)
    return rows()


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _is_staging(name: str) -> bool:
    return name.split(".")[0].endswith("staging")


def _require_same_schema(df: DataFrame, table: DataFrame, name: str) -> None:
    new = [(f.name, f.dataType) for f in df.schema]
    old = [(f.name, f.dataType) for f in table.schema]
    if new != old:
        raise ValueError(f"schema of {name} would change from {old} to {new}")


def _count_and_repeats(df: DataFrame, key: str) -> tuple[int, int]:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.count_if((F.col("n") > 1) & F.col(key).isNotNull())
    row = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), repeated.alias("repeated")).first()
    return row["rows"], row["repeated"]


def _described(spark: SparkSession, name: str, partition: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect()
    # What a partition says of itself comes before what the table says.
    return {r["col_name"]: r["data_type"] for r in reversed(rows)}


def _provider(spark: SparkSession, name: str) -> str:
    return _described(spark, name).get("Provider", "").lower()


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, files = _files(spark, path)
    return files.exists(folder)


def _delete(spark: SparkSession, path: str) -> None:
    folder, files = _files(spark, path)
    files.delete(folder, True)


def _set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(("spark.", "transient_", "option."))}
