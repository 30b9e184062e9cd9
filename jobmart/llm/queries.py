"""One registered query per corpus operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import (
    decontaminate, language, lines, manifest, mixing, nearcopies, periodic, quality, rules, secretscan, tokens,
    toxicity, transcripts,
)
from jobmart.llm.common import fold, held_out, in_small_batches, stored, table
from jobmart.session import work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512


def query(function: Query) -> Query:
    QUERIES[function.__name__] = in_small_batches(function)
    return function


@query
def op1_language_id(spark, sf_dir):
    """The language of every document, by the smallest encoding."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs)
    return found.select(
        "doc_id", held_out().alias("held_out"), F.col("prediction.lang").alias("lang_pred"),
        F.col("prediction.score").alias("score"), "rejected",
    )


@query
def op2_token_counts(spark, sf_dir):
    """The number of tokens of every document, from a cache that this call starts empty."""
    n_bytes = F.octet_length(tokens.content(F.col("text"))).cast("long")  # before the join, so that no text moves there
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", n_bytes.alias("n_bytes"))
    counted = tokens.count_tokens(docs, work_path(spark, "token-cache"), TOKENIZER)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op3_source_mix(spark, sf_dir):
    """The words a mix of all sources takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    return mixing.mix(stored(docs, "sizes"), F.array("source"), F.col("size")).drop("source")


@query
def op4_secrets(spark, sf_dir):
    """The secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.withColumn("found", secretscan.scan(F.col("text"), secretscan.fit(docs)))
    return found.select(
        "doc_id", "found.n_assign", "found.n_access", "found.n_hex", F.sha2("found.base", 256).alias("base_sha256"),
        "found.spans",
    )


@query
def op5_quality(spark, sf_dir):
    """The quality of every document, from pairwise preferences."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op6_decontamination(spark, sf_dir):
    """The benchmark items found in documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.passages(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op7_line_dedup(spark, sf_dir):
    """Every document without the lines that at least ten documents share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_frequent_lines(docs, lines.build(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op8_chat_transcripts(spark, sf_dir):
    """The turns recovered from all conversations, written out as transcripts in mixed styles, in canonical form."""
    written = transcripts.written_out(table(spark, sf_dir, "conversations"))
    model = transcripts.fit(written.where(fold("conv_id") != 0))
    return transcripts.whole_turns(written.select("conv_id", "segment", "transcript"), model)


@query
def op9_quality_rules(spark, sf_dir):
    """The rule counts of every document, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.apply_rules(docs, model).select("doc_id", *rules.COUNTS, "base_failed", "kept", "probability")


@query
def op10_near_copies(spark, sf_dir):
    """The class of near copies of every document."""
    return nearcopies.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_toxicity(spark, sf_dir):
    """The toxicity of every document, by a recurrent network over all its windows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), usable=~apart)
    return toxicity.classify(docs, model).select("doc_id", apart.alias("held_out"), "score", "predicted")


@query
def op12_periodic_runs(spark, sf_dir):
    """The periodic runs of every document, some of which get a periodic end first, and the text without repetitions."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", periodic.planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.collapse_text(docs)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


@query
def op13_merkle_manifest(spark, sf_dir):
    """The manifest of all documents, and whether a copy of each, some tampered with, is proved by it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    size = F.col("n_chars").cast("long")
    claimed = F.when(tampered, size + 1).otherwise(size)
    leaf, claim = (manifest.digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")) for n in (size, claimed))
    found = manifest.build(docs, leaf, claim)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified", "slot")
