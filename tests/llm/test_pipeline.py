"""The pipeline against a version that works on lists, over the smallest table."""

import math
import re
from collections import Counter

import duckdb

import corpus_pipeline
from jobmart.llm import language, mixing
from jobmart.llm.common import table
from tests.llm.test_nearcopies import brute_classes

FOLDER = "/root/testdata/sf0.001"


def _line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute_pipeline(spark):
    """(doc_id, text) after each stage, and doc_id to words taken after the last."""
    base = duckdb.connect()
    docs = {r[0]: r for r in base.sql(f"select doc_id, text, source from '{FOLDER}/documents.parquet'").fetchall()}
    items = [r[0] for r in base.sql(f"select text from '{FOLDER}/benchmark.parquet'").fetchall()]
    stages = []

    model = language.fit_on_folds(table(spark, FOLDER, "documents"))
    encoders = model.encoders()
    texts = {}
    for i, (_, text, _) in docs.items():
        data = (text or "").lower().encode()
        sizes = sorted(sum(len(e.compress(data[k : k + language.BLOCK])) for k in range(0, len(data), language.BLOCK)) for e in encoders)
        if text and any(c.isalpha() for c in text) and (sizes[1] - sizes[0]) / sizes[0] >= language.MIN_MARGIN:
            texts[i] = text
    stages.append(dict(texts))

    found = Counter(key for t in texts.values() for key in {_line_key(line) for line in t.split("\n")} if key)
    for i, t in texts.items():
        texts[i] = "\n".join(line for line in t.split("\n") if found[_line_key(line)] < 10)
    stages.append(dict(texts))

    classes = brute_classes(texts)
    texts = {i: t for i, t in texts.items() if classes[i] == i}
    stages.append(dict(texts))

    def words(t):
        return re.findall(r"\w+", t.lower())

    leaks = [{tuple(w[k : k + 8]) for k in range(len(w) - 7)} for w in map(words, items)]
    for i in list(texts):
        w = words(texts[i])
        mine = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        if any(len(mine & leak) >= len(leak) / 2 for leak in leaks):
            del texts[i]
    stages.append(dict(texts))

    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    by = {}
    for i in texts:
        by[docs[i][2]] = by.get(docs[i][2], 0) + sizes[i]
    return stages, sizes, {i: docs[i][2] for i in texts}, mixing.targets(by, mixing.cyclic_weights(list(by)))


def test_every_stage_equals_the_version_on_lists(spark):
    stages, sizes, source, wanted = brute_pipeline(spark)
    docs = table(spark, FOLDER, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language id", "line dedup", "near-copy dedup", "benchmark decontamination", "source mix",
    ]
    for (name, stage), expected in zip(corpus_pipeline.STAGES[:4], stages, strict=True):
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test-stage")
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected, name
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.where("n_chars <> length(text)").count() == 0
    rows = corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).collect()
    taken = {}
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] == r["repeats"] * r["size"] and 1 <= r["repeats"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    longest = {s: max(n for i, n in sizes.items() if source[i] == s) for s in wanted}
    for s, target in wanted.items():
        assert abs(taken.get(s, 0) - target) <= max(1, longest[s] / 2) or math.isclose(taken.get(s, 0), target)


def test_run_equals_its_stages(spark):
    one = sorted((r["doc_id"], r["repeats"]) for r in corpus_pipeline.run(spark, FOLDER).collect())
    two = sorted((r["doc_id"], r["repeats"]) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert one == two and one
