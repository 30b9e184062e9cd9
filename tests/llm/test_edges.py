"""Every operator over odd rows and an empty table: nothing is lost, nothing fails."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobmart.llm import decontaminate, language, lines, mixing, nearcopies, quality, queries, rules, secretscan, tokens, transcripts
from jobmart.session import work_path


def _labels(spark, docs):
    return docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).where("doc_id is not null")


OPERATORS = {
    "language": lambda s, d: language.identify(d),
    "tokens": lambda s, d: tokens.count_tokens(d, work_path(s, "cache"), queries.TOKENIZER),
    "mixing": lambda s, d: mixing.mix(d, F.array("source"), mixing.words(F.col("text"))),
    "secrets": lambda s, d: d.withColumn("found", secretscan.scan(F.col("text"), secretscan.fit(d))),
    "quality": lambda s, d: quality.classify(d, quality.fit(d, _labels(s, d))),
    "lines": lambda s, d: lines.drop_frequent_lines(d, lines.build(d, min_docs=2)),
    "rules": lambda s, d: rules.apply_rules(d, rules.fit(d, _labels(s, d))),
    "near copies": lambda s, d: nearcopies.near_copies(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_all_stay(spark, edge_docs, name):
    found = OPERATORS[name](spark, edge_docs).collect()
    assert len(found) == edge_docs.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(spark, no_docs, name):
    assert OPERATORS[name](spark, no_docs).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_keep_the_columns_and_bear_odd_rows(spark, edge_docs, no_docs, stage):
    folder = "/root/testdata/sf0.001"
    found = stage[1](spark, edge_docs, folder)
    if stage is not corpus_pipeline.STAGES[-1]:
        assert found.schema.names == edge_docs.schema.names
        assert [f.dataType for f in found.schema] == [f.dataType for f in edge_docs.schema]
        assert found.where("not (size <=> 'x' and kept_text <=> 'x' and prediction <=> 'x' and class_id <=> 'x')").count() == 0
    assert 0 < found.count() <= edge_docs.count()
    assert stage[1](spark, no_docs, folder).count() == 0


def test_decontamination_of_odd_rows(spark, edge_docs, no_docs):
    items = edge_docs.select(F.col("doc_id").alias("item_id"), "text")
    found = decontaminate.passages(edge_docs, items)
    # Each text with enough words is found in the rows that hold it; the lost one by its null id.
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} >= {(8, 8), (9, 8), (5, 5)}
    assert decontaminate.passages(no_docs, items).count() == 0
    assert decontaminate.passages(edge_docs, items.where("1 = 0")).count() == 0


def test_conversations_with_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, "bot", "x"), (None, 3, None, ""), (2, 0, "assistant", "b " * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    written = transcripts.written_out(turns)
    assert sum(len(r["blocks"]) for r in written.collect()) == len(rows)
    model = transcripts.fit(written)
    assert written.select(transcripts.parse(F.col("transcript"), model).alias("t")).count() == written.count()
    assert transcripts.written_out(turns.where("1 = 0")).count() == 0


def test_defined_results_of_odd_texts(spark, edge_docs):
    found = {r["doc_id"]: r for r in language.identify(edge_docs).where("doc_id < 7").collect()}
    assert all(found[i]["prediction"]["lang"] == "und" and found[i]["rejected"] for i in (0, 1, 2, 6))
    classes = nearcopies.near_copies(edge_docs).collect()
    of = {}
    for r in classes:
        of.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert of[0] == of[1] == of[2] == {0} and of[8] == of[9] == {8}
    assert len(of[3]) == 2 and 3 not in of[3]  # the least id of two texts names neither
    assert len(of[None]) == 2 and 0 in of[None]
    kept = nearcopies.keep_one(edge_docs)
    assert kept.count() == len(set().union(*of.values()))
