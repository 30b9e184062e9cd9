"""The corpus pipeline: language, repeated lines, near copies, benchmark leaks, and the mix of sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import decontaminate, language, lines, mixing, nearcopies
from jobmart.llm.common import in_small_batches, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


@in_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; rejected ones go."""
    return language.keep_identified(docs)


@in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least ten of them share; ``n_chars`` follows the text."""
    return lines.shorten(docs, lines.build(docs))


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return nearcopies.keep_one(docs)


@in_small_batches
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``repeats``: how many times."""
    mixed = mixing.mix(docs, F.array("source"), mixing.words(F.col("text")))
    taken = mixed.where("taken > 0").withColumn("repeats", F.expr("cast(taken div size as int)"))
    return taken.select(*docs.columns, "size", "taken", "repeats")


STAGES: list[tuple[str, Stage]] = [
    ("language id", identify_language),
    ("line dedup", drop_repeated_lines),
    ("near-copy dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("source mix", mix_sources),
]

#: SQL expresses neither the compression classifier nor the near-duplicate classes.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the last stage keeps; every stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"stage-{number}")
    return docs
