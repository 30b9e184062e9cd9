import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from jobmart.llm import linear, quality, rules
from jobmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def _held_out(spark, found):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").collect()
    return [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op5_quality"](spark, FOLDER)
    rows = _held_out(spark, found)
    assert all(r["held_out"] and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    good, bad = (np.array([r["score"] for r in rows if r["quality"] == q]) for q in (1, 0))
    assert (good[:, None] > bad[None]).mean() > 0.99
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98


def test_rules_of_held_out_documents(spark):
    rows = _held_out(spark, QUERIES["op9_quality_rules"](spark, FOLDER))
    good, bad = ([r for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([r["kept"] for r in good]) > 0.95 and np.mean([r["kept"] for r in bad]) < 0.1
    assert all(not r["kept"] for r in rows if r["base_failed"])
    # Calibrated: the mean probability is near the share of good documents.
    assert abs(np.mean([r["probability"] for r in rows]) - len(good) / len(rows)) < 0.06


def test_rule_counts_by_brute_force(spark, small_docs, edge_docs):
    docs = small_docs.select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text"))
    for r in rules.apply_rules(docs, None).collect():
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
        seen, duplicates = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                duplicates += line in seen
                seen.add(line)
        wanted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered))
        assert tuple(r[c] for c in rules.COUNTS) == wanted
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert r["kept"] == (not r["base_failed"])


def test_nothing_is_learned_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(400)
    labels = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).select(
        "doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")
    )
    assert quality.fit(docs, labels) is None and rules.fit(docs, labels) is None


def test_pairs_give_an_order():
    draw = np.random.default_rng(5)
    real = np.array([2.0, -1.0, 0.0])
    a, b = draw.normal(size=(4_000, 3)), draw.normal(size=(4_000, 3))
    first = draw.random(4_000) < linear.sigmoid((a - b) @ real)
    found = quality.fit_pairs(np.where(first[:, None], a, b), np.where(first[:, None], b, a))
    assert np.abs(found - real).max() < 0.2


def test_calibration():
    draw = np.random.default_rng(6)
    scores = draw.normal(size=20_000)
    labels = (draw.random(20_000) < linear.sigmoid(3 * scores - 1)).astype(int)
    slope, intercept = linear.calibrate(scores, labels)
    assert abs(slope - 3) < 0.15 and abs(intercept + 1) < 0.1


def test_the_threshold_is_a_quantile_of_all_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    # Labels that are often wrong, so that many scores lie about the threshold.
    wrong = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    labels = labels.select("doc_id", F.when(wrong, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"))
    found = quality.classify(docs, quality.fit(docs, labels, rows=40)).join(labels, "doc_id")
    rows = [r for r in found.select("doc_id", "predicted", "quality").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    assert sum(r["predicted"] == 0 for r in rows) == sum(r["quality"] == 0 for r in rows)


def test_ranks_are_exact(spark):
    draw = np.random.default_rng(4)
    values = np.concatenate([draw.normal(size=3_000), np.zeros(500), draw.normal(size=500) * 1e-12])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    ordered = np.sort(values).tolist()
    for rank in (1, 1_700, 2_000, 2_300, 3_999):
        assert quality.ranked(df, "x", rank) == (ordered[rank - 1], ordered[rank])


def test_character_ngrams_are_those_of_characters():
    for text in ("", "ab", "plain words", "học máy 机器学习 𠀀𠀁", "é"):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        assert rules.characters(data).tolist() == [ord(c) for c in text]
        none = np.empty(0, dtype=np.uint64)
        sizes = [len(f) for f in rules.ngram_features(data, none)][2:]
        assert sizes == [n for n in (len(text) - 2, len(text) - 3) if n > 0]
    assert rules.characters(np.frombuffer(b"a\xff", dtype=np.uint8)).tolist() == [ord("a"), 0xFFFD]
    first, second = (list(rules.ngram_features(np.frombuffer(t.encode(), dtype=np.uint8), none)) for t in ("机器学", "学器机"))
    assert first[2].tolist() != second[2].tolist()
