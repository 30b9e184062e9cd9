"""Reversible deduplication of lines.

An exact table counts the documents of every line key. Cuckoo filters, one per shard, hold the keys found in enough
documents to be dropped. Documents can be inserted and deleted later: counts change, and only keys that cross the
threshold enter or leave a filter, so a line comes back when the documents that shared it go.

A key is a line without the separators at both ends and with A-Z lower-cased, and is represented by a digest of 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import stored
from jobmart.llm.cuckoo import CuckooFilter

STRIPPED = b" \t\n\x0b\x0c\r"
MIN_DOCS = 10
MIN_LENGTH = 1
#: Filters larger than this together are not sent to the executors; every line is then looked up in the exact table.
BROADCAST_BYTES = 64 << 20
KEYS_PER_SHARD = 500_000


@dataclass(frozen=True)
class LineIndex:
    """``counts`` has key and n_docs of all keys, ``filters`` shard and filter of the frequent ones."""

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_length: int = MIN_LENGTH

    def frequent(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs)


def line_keys(data: bytes | None, min_length: int) -> list[bytes | None]:
    """The digest of each line's key; None for keys too short to count. A null text is one empty line."""
    keys = (line.strip(STRIPPED) for line in (data or b"").lower().split(b"\n"))
    # A key has at least a quarter as many code points as bytes.
    return [
        xxhash.xxh3_128_digest(key)
        if len(key) >= 4 * min_length or len(key.decode("utf-8", "replace")) >= max(1, min_length) else None
        for key in keys
    ]


def shard(key: Column, shards: int) -> Column:
    """Of the digest's last bytes, which the place within a filter does not depend on."""
    return (F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long") % shards).cast("int")


def key_counts(docs: DataFrame, text: str, doc_id: str, min_length: int) -> DataFrame:
    """The number of distinct documents of every key; rows without an id count as one document together."""

    @F.pandas_udf("array<binary>")
    def distinct_keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([list({k for k in line_keys(data, min_length) if k}) for data in batch])

    keys = docs.select(F.col(doc_id).alias("id"), F.explode(distinct_keys(F.col(text).cast("binary"))).alias("key"))
    n_docs = F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))
    return keys.groupBy("key").agg(n_docs.alias("n_docs"))


def _changed_filters(old: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """Filters of all shards after keys were added and removed; ``changes`` has shard, key and added."""

    def change(before: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        number = int((before if len(before) else keys)["shard"].iloc[0])
        coming, going = keys[keys["added"]]["key"], keys[~keys["added"]]["key"]
        if len(before):
            found = CuckooFilter.from_bytes(bytes(before["filter"].iloc[0]))
            if found.table.size < 1.05 * (np.count_nonzero(found.table) + len(coming)):
                # Too full to grow in place: left to the caller, who rebuilds this shard from the counts.
                return pd.DataFrame({"shard": [number], "filter": [None]})
            found.remove(CuckooFilter.halves(going))
        else:
            found = CuckooFilter(len(coming))
        found.add(CuckooFilter.halves(coming))
        return pd.DataFrame({"shard": [number], "filter": [found.to_bytes()]})

    grouped = old.groupBy("shard").cogroup(changes.groupBy("shard"))
    return grouped.applyInPandas(change, "shard int, filter binary")


def _new_filters(frequent: DataFrame, shards: int) -> DataFrame:
    def make(keys: pd.DataFrame) -> pd.DataFrame:
        found = CuckooFilter(len(keys))
        found.add(CuckooFilter.halves(keys["key"]))
        return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "filter": [found.to_bytes()]})

    rows = frequent.select(shard(F.col("key"), shards).alias("shard"), "key")
    return rows.groupBy("shard").applyInPandas(make, "shard int, filter binary")


def build(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_docs: int = MIN_DOCS,
          min_length: int = MIN_LENGTH) -> LineIndex:
    """The index of a set of documents, in written tables."""
    counts = stored(key_counts(docs, text, doc_id, min_length), "line-counts")
    frequent = counts.where(F.col("n_docs") >= min_docs)
    shards = max(4, -(-frequent.count() // KEYS_PER_SHARD))
    return LineIndex(counts, stored(_new_filters(frequent, shards), "line-filters"), shards, min_docs, min_length)


def update(index: LineIndex, inserted: DataFrame | None = None, deleted: DataFrame | None = None,
           text: str = "text", doc_id: str = "doc_id") -> LineIndex:
    """The index after documents came and went, as new written tables; the old ones stay as they are.

    Inserted documents must be new, deleted ones must have been inserted, with the same text. Counts are exact at any
    time, and keys whose last document goes leave the table.
    """
    parts = [index.counts.withColumn("old", F.col("n_docs")).withColumn("change", F.lit(0))]
    for docs, sign in ((inserted, 1), (deleted, -1)):
        if docs is not None:
            delta = key_counts(docs, text, doc_id, index.min_length)
            parts.append(delta.select("key", F.lit(0).alias("n_docs"), F.lit(0).alias("old"), (F.col("n_docs") * sign).alias("change")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    sums = rows.groupBy("key").agg(F.sum("old").alias("old"), F.sum("change").alias("change"))
    both = stored(sums.select("key", "old", (F.col("old") + F.col("change")).alias("n_docs")), "line-counts")
    was, now = F.col("old") >= index.min_docs, F.col("n_docs") >= index.min_docs
    changes = both.where(was != now).select(shard(F.col("key"), index.shards).alias("shard"), "key", now.alias("added"))
    counts = both.where("n_docs > 0").select("key", "n_docs")
    filters = stored(_changed_filters(index.filters, changes, index.shards), "line-filters")
    full = filters.where("filter is null").select("shard")
    frequent = counts.where(F.col("n_docs") >= index.min_docs).withColumn("shard", shard(F.col("key"), index.shards))
    rebuilt = _new_filters(frequent.join(full, "shard", "left_semi"), index.shards)
    filters = filters.where("filter is not null").unionByName(rebuilt)
    return replace(index, counts=counts, filters=stored(filters, "line-filters"))


def _sent(index: LineIndex, limit: int) -> list[CuckooFilter | None] | None:
    """The filters by shard, if they are small enough together to be sent to every executor."""
    size = index.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size > limit:
        return None
    found: list[CuckooFilter | None] = [None] * index.shards
    for row in index.filters.collect():
        found[row["shard"]] = CuckooFilter.from_bytes(bytes(row["filter"]))
    return found


def with_kept(docs: DataFrame, index: LineIndex, text: str = "text", doc_id: str = "doc_id",
              broadcast_bytes: int = BROADCAST_BYTES, into: str = "_kept") -> DataFrame:
    """``docs`` with a struct of ``kept_text``, ``n_lines`` and ``n_dropped``: all lines gone whose key is frequent.

    The filters tell most lines apart where the text lies; those that test positive are looked up in the exact
    counts, so a false positive never drops a line. Other lines stay, joined by a line feed. A null or empty text is
    one empty line and gives an empty text. Every row is kept, repeated rows too.
    """
    spark, shards, min_length = docs.sparkSession, index.shards, index.min_length
    filters = _sent(index, broadcast_bytes)
    sent = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("array<struct<line: int, key: binary>>")
    def candidates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        filters = sent.value
        for batch in batches:
            found = [[(i, k) for i, k in enumerate(line_keys(data, min_length)) if k] for data in batch]
            if filters is not None:
                digests = [k for row in found for _, k in row]
                halves = CuckooFilter.halves(digests)
                # The last four bytes, read as `shard` reads them.
                numbers = np.frombuffer(b"".join(k[12:] for k in digests), dtype=">u4") % shards
                hit = np.zeros(len(digests), dtype=bool)
                for number, f in enumerate(filters):
                    if f is not None:
                        here = numbers == number
                        hit[here] = f.contains(halves[here])
                marks = iter(hit.tolist())
                found = [[x for x in row if next(marks)] for row in found]
            yield pd.Series(found)

    @F.pandas_udf("kept_text string, n_lines long, n_dropped long")
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, dropped in batches:
            rows = []
            for value, numbers in zip(texts, dropped, strict=True):
                split = (value or "").split("\n")
                gone = set(() if numbers is None else numbers.tolist())
                kept = "\n".join(x for i, x in enumerate(split) if i not in gone) if gone else value or ""
                rows.append((kept, len(split), len(gone)))
            yield pd.DataFrame(rows, columns=["kept_text", "n_lines", "n_dropped"])

    rows = docs.withColumn("_hash", F.xxhash64(text))
    hits = rows.select(F.col(doc_id).alias("_id"), "_hash", F.explode(candidates(F.col(text).cast("binary"))).alias("x"))
    hits = hits.select("_id", "_hash", "x.line", "x.key").join(index.frequent().select("key"), "key")
    gone = hits.groupBy("_id", "_hash").agg(F.collect_set("line").alias("_gone"))
    gone = gone.withColumnRenamed("_hash", "_gone_hash")
    same = rows[doc_id].eqNullSafe(gone["_id"]) & (rows["_hash"] == gone["_gone_hash"])
    joined = rows.join(gone, same, "left").withColumn(into, without(F.col(text), F.col("_gone")))
    return joined.select(*docs.columns, into)


def drop_frequent_lines(docs: DataFrame, index: LineIndex, text: str = "text", doc_id: str = "doc_id",
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``with_kept`` as columns of their own; columns of their names are replaced."""
    old = docs.drop("kept_text", "n_lines", "n_dropped")
    return with_kept(old, index, text, doc_id, broadcast_bytes).select(*old.columns, "_kept.*")


def shorten(docs: DataFrame, index: LineIndex, text: str = "text", doc_id: str = "doc_id",
            n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with frequent lines gone from the text, and its length in ``n_chars``, if that column exists.

    Rows without any frequent line stay as they are, null texts too.
    """
    kept = with_kept(docs, index, text, doc_id)
    changed, new = F.col("_kept.n_dropped") > 0, {}
    new[text] = F.when(changed, F.col("_kept.kept_text")).otherwise(F.col(text))
    if n_chars in docs.columns:
        length = F.length("_kept.kept_text").cast(docs.schema[n_chars].dataType)
        new[n_chars] = F.when(changed, length).otherwise(F.col(n_chars))
    return kept.withColumns(new).select(*docs.columns)
