import itertools

import pytest
from pyspark.sql import functions as F

from jobmart.llm import mixing
from jobmart.llm.queries import QUERIES


def test_targets_are_capped_and_reshared():
    sizes = {"a": 10, "b": 1_000, "c": 2_000, None: 990}
    weights = mixing.cyclic_weights(list(sizes))
    assert weights == {"a": 1, "b": 2, "c": 3, None: 1}
    found = mixing.targets(sizes, weights)
    # a stops at 30, the other 3970 are shared 2 : 3 : 1.
    assert found == pytest.approx({"a": 30, "b": 3_970 / 3, "c": 3_970 / 2, None: 3_970 / 6})
    assert mixing.targets({}, {}) == {}
    assert mixing.targets({"a": 0, "b": 4}, {"a": 1, "b": 1}) == {"a": 0, "b": 4}


def test_routing_is_cheapest_by_brute_force():
    capacity = [(("a",), 2), (("a", "b"), 3), (("b", "c"), 1)]
    for quota in ({"a": 4, "b": 3, "c": 1}, {"a": 2, "b": 9, "c": 3}, {"a": 0, "b": 1, "c": 0}):
        flows = mixing.route(capacity, quota)
        best = None
        ranges = [range(3 * n + 1) for p, n in capacity for _ in p]
        for x in itertools.product(*ranges):
            it, total, got = iter(x), [], dict.fromkeys(quota, 0)
            for p, _ in capacity:
                given = {s: next(it) for s in p}
                total.append(sum(given.values()))
                for s, n in given.items():
                    got[s] += n
            if any(t > 3 * n for t, (_, n) in zip(total, capacity, strict=True)) or any(got[s] > quota[s] for s in quota):
                continue
            key = (-sum(total), sum(_cost(t, n) for t, (_, n) in zip(total, capacity, strict=True)))
            best = min(best or key, key)
        mine = (-sum(f for f, _ in flows), sum(_cost(f, n) for (f, _), (_, n) in zip(flows, capacity, strict=True)))
        assert mine == best


def _cost(flow, size):
    return sum(min(size, max(0, flow - r * size)) * (r + 1) ** 2 for r in range(3))


def test_the_query_comes_near_its_targets(spark):
    found = QUERIES["op3_source_mix"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text"), "doc_id"
    )
    rows = found.withColumn("n", mixing.words(F.col("text"))).drop("text").collect()
    assert len(rows) == 1_000 and all(r["n"] == r["size"] and r["taken"] in (0, r["n"], 2 * r["n"], 3 * r["n"]) for r in rows)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(mixing.targets(sizes, mixing.cyclic_weights(list(sizes))))
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in sizes)
    again = QUERIES["op3_source_mix"](spark, "/root/testdata/sf0.01").select("doc_id", "taken").collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {tuple(r) for r in again}


def test_overlapping_sources(spark):
    rows = [(i, ["b", "a"] if i % 3 else ["a"], 10) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, of array<string>, n long")
    found = mixing.mix(docs, F.col("of"), F.col("n"), seed=3).collect()
    # a has 3000 words and b 2000; together they are 3000 words wide, wanted 1 : 2.
    assert {r["target"] for r in found if len(r["of"]) == 1} == {1_000.0}
    by = {1: 0, 2: 0}
    for r in found:
        by[len(r["of"])] += r["taken"]
    assert by[1] + by[2] == 3_000 and by[2] >= 2_000


def test_ties_and_sources_that_are_null_or_none(spark):
    rows = [(1, [None], 5)] * 3 + [(2, [], 7), (3, None, 0), (4, ["x", "x"], 9)]
    docs = spark.createDataFrame(rows, "doc_id long, of array<string>, n long")
    found = mixing.mix(docs, F.col("of"), F.col("n")).collect()
    assert len(found) == 6 and len({r["taken"] for r in found if r["doc_id"] == 1}) == 1
    assert next(r for r in found if r["doc_id"] == 3)["taken"] == 0
