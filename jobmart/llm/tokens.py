"""Token counts with a cache of content digests.

A stored count is found by the digest of a text's content and the digest of the tokenizer file.  Only distinct texts
without a stored count are encoded; their counts are appended to the cache.

The content is the text with null read as empty: any further normalisation would change counts.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE = "digest binary, n_tokens long, version string"

#: Characters that both tokenizer libraries put in the same classes; tests compare them one by one.
ALIKE = r"[\x00-ȳЀ-ҁ‐-‧€]*"
#: How a byte-level tokenizer of this family splits text before merging. Fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def version_of(path: str) -> str:
    """The digest that stands for a tokenizer: of the whole file, so that any change makes older counts unused."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def _merging_encoder(spec: dict):
    """The same merges in a faster library, if the file is a plain byte-level tokenizer; else None."""
    import tiktoken

    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = {"normalizer": None, "truncation": None, "padding": None}
    if any(spec.get(k) != v for k, v in plain.items()) or model.get("type") != "BPE" or model.get("dropout"):
        return None
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    if model.get("ignore_merges") or any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix")):
        return None
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return None
    # Bytes are written as printable characters: those that are none already take the code points from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes([b]): b for b in range(256)}
    for i, merge in enumerate(model["merges"]):
        pair = merge.split(" ") if isinstance(merge, str) else merge
        ranks[bytes(byte[c] for c in "".join(pair))] = 256 + i
    if len(ranks) != 256 + len(model["merges"]):
        return None
    return tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to numbers of tokens, as the library of the file gives them.

    No tokens are added at either end; a special token's string inside a text is treated as the library does by
    default. Files ending in .model are for sentencepiece, others for tokenizers.
    """
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]

    import regex
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    spec = json.loads(Path(path).read_text())
    fast = _merging_encoder(spec | {"truncation": None, "padding": None})
    if fast is None:
        return lambda texts: [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    alike = regex.compile(ALIKE)
    added = sorted((t["content"] for t in spec["added_tokens"]), key=lambda t: -len(t))
    cut = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")

    def count(text: str) -> int:
        if not alike.fullmatch(text):
            return len(tokenizer.encode(text, add_special_tokens=False))
        parts = cut.split(text)
        return len(parts) - 1 + sum(len(fast.encode_ordinary(part)) for part in parts)

    return lambda texts: [count(text) for text in texts]


def content(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(content(text), 256))


def empty_cache(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("version").parquet(path)


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer, one per digest: a retried append may have stored some twice."""
    rows = spark.read.schema(CACHE).parquet(path).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_misses(docs: DataFrame, text: str, cache: str, tokenizer: str) -> None:
    """Encode each distinct text that has no stored count, once, and append the counts.

    Copies meet inside each task before anything is moved, so a text that fills a third of all rows moves once a task.
    """
    version = version_of(tokenizer)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = counter(tokenizer)
        for batch in batches:
            yield pd.Series(measure(batch.tolist()), dtype="int64")

    texts = docs.select(content(F.col(text)).alias("text")).withColumn("digest", digest(F.col("text")))
    known = read_cache(docs.sparkSession, cache, version)
    misses = texts.dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    counted = misses.select("digest", count("text").alias("n_tokens"), F.lit(version).alias("version"))
    counted.write.mode("append").partitionBy("version").parquet(cache)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text; the cache at ``cache`` grows by what it lacked.

    ``cache`` must be a folder that all executors see, and ``tokenizer`` a file at the same place on each of them.
    A null text counts as empty. Every row is kept, repeated rows too; a column named like ``into`` is replaced.
    """
    empty_cache(docs.sparkSession, cache)
    append_misses(docs, text, cache, tokenizer)
    stored = read_cache(docs.sparkSession, cache, version_of(tokenizer))
    stored = stored.select(F.col("digest").alias("_digest"), F.col("n_tokens").alias("_n_tokens"))
    rows = docs.drop(into).withColumn("_digest", digest(F.col(text)))
    joined = rows.join(stored, "_digest", "left")
    return joined.withColumn(into, F.col("_n_tokens")).drop("_digest", "_n_tokens")
