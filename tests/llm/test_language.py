import math

from pyspark.sql import functions as F

from jobmart.llm import language
from jobmart.llm.common import fold, held_out
from jobmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_documents_are_recognised(spark):
    found = QUERIES["op1_language_id"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = found.join(docs, "doc_id").withColumn("good", (F.col("lang_pred") == F.col("lang")).cast("int")).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    apart = [r for r in rows if r["held_out"]]
    assert sum(r["good"] for r in apart) / len(apart) > 0.95
    kept = [r for r in apart if not r["rejected"]]
    assert len(kept) / len(apart) > 0.97 and sum(r["good"] for r in kept) / len(kept) > 0.96


def test_predictions_by_brute_force(spark, small_docs):
    """The smallest encoding, worked out text by text."""
    model = language.fit_on_folds(small_docs)
    encoders = model.encoders()
    found = small_docs.select("doc_id", "text", language.predict(model, F.col("text")).alias("p")).collect()
    for r in found:
        data = r["text"].lower().encode()
        sizes = [sum(len(e.compress(data[i : i + language.BLOCK])) for i in range(0, len(data), language.BLOCK)) for e in encoders]
        best, second = sorted(sizes)[:2]
        assert r["p"]["lang"] == model.dictionaries[sizes.index(best)][0]
        assert math.isclose(r["p"]["margin"], (second - best) / best)


def test_nothing_is_learned_from_the_held_out_fold(spark, small_docs):
    marked = small_docs.withColumn("lang", F.when(held_out(), "secret").otherwise(F.col("lang")))
    assert "secret" not in dict(language.fit_on_folds(marked).dictionaries)
    import zlib

    ids = [r["doc_id"] for r in small_docs.where(fold() == 0).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_without_labels_and_with_one_language(spark, small_docs):
    none = language.identify(small_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r["prediction"]["lang"] == "und" and r["rejected"] for r in none)
    one = language.identify(small_docs.withColumn("lang", F.lit("xx"))).collect()
    assert all(r["prediction"] == ("xx", 1.0, 1.0) and not r["rejected"] for r in one)


def test_ties_go_to_the_first_language(spark):
    model = language.LanguageModel((("aa", b"same words"), ("bb", b"same words")))
    row = spark.createDataFrame([("other text",)], "t string").select(language.predict(model, F.col("t")).alias("p")).first()["p"]
    assert row["lang"] == "aa" and row["margin"] == 0.0
