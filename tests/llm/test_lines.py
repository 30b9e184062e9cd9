import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import lines
from jobmart.llm.cuckoo import CuckooFilter
from jobmart.llm.oracle import ORACLE
from jobmart.llm.queries import QUERIES


def _digests(numbers):
    return [int(n).to_bytes(16, "little") for n in numbers]


def test_a_filter_never_loses_a_key():
    draw = np.random.default_rng(0)
    keys = CuckooFilter.halves(draw.bytes(16) for _ in range(5_000))
    found = CuckooFilter(len(keys))
    found.add(keys)
    assert found.contains(keys).all()
    other = CuckooFilter.halves(draw.bytes(16) for _ in range(20_000))
    assert found.contains(other).mean() < 0.002
    found.remove(keys[:2_500])
    again = CuckooFilter.from_bytes(found.to_bytes())
    assert again.contains(keys[2_500:]).all() and again.contains(keys[:2_500]).mean() < 0.01


def test_an_overfull_filter_keeps_the_rest_apart():
    found = CuckooFilter(4)
    keys = CuckooFilter.halves(np.random.default_rng(1).bytes(16) for _ in range(60))
    found.add(keys)
    assert found.apart and found.contains(keys).all()
    assert CuckooFilter.from_bytes(found.to_bytes()).contains(keys).all()
    found.remove(keys)
    assert not found.apart and not found.table.any()


def test_the_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    base = duckdb.connect()
    base.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    wanted = sorted(base.sql(ORACLE["op7_line_dedup"]).fetchall())
    found = QUERIES["op7_line_dedup"](spark, folder)
    assert sorted(tuple(r) for r in found.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == wanted


@pytest.fixture(scope="module")
def shared_lines(spark):
    rows = [(i, "\n".join(["  Footer LINE\t", f"own {i}", "", "Ää" if i % 2 else "often " + "x" * (i % 3)])) for i in range(24)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _kept(docs, index, **options):
    return {r["doc_id"]: r["kept_text"] for r in lines.drop_frequent_lines(docs, index, **options).collect()}


def test_without_sent_filters_the_result_is_the_same(shared_lines):
    index = lines.build(shared_lines)
    kept = _kept(shared_lines, index)
    assert kept == _kept(shared_lines, index, broadcast_bytes=-1)
    assert kept[1] == "own 1\n" and kept[0] == "own 0\n\noften "


def test_documents_can_come_and_go(shared_lines):
    first, second = shared_lines.where("doc_id < 9"), shared_lines.where("doc_id >= 9")
    index = lines.build(first)
    assert "Footer" in _kept(first, index)[1]
    grown = lines.update(index, inserted=second)
    assert _kept(shared_lines, grown) == _kept(shared_lines, lines.build(shared_lines))
    shrunk = lines.update(grown, deleted=second)
    assert _kept(first, shrunk) == _kept(first, index)
    counts = lambda i: sorted((bytes(r["key"]), r["n_docs"]) for r in i.counts.collect())
    assert counts(shrunk) == counts(index)
    both = lines.update(index, inserted=second, deleted=first)
    assert counts(both) == counts(lines.build(second))


def test_a_key_counts_once_a_document(spark):
    docs = spark.createDataFrame([(1, "\n".join(["x"] * 30)), (2, "x\nX ")], "doc_id long, text string")
    assert lines.key_counts(docs, "text", "doc_id", 1).agg(F.max("n_docs")).first()[0] == 2
