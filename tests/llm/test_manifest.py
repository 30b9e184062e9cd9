import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import manifest
from jobmart.llm.bitmaps import SIZE, Container
from jobmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """Levels of a tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def brute(rows, claim=lambda r: r):
    """(doc_id, leaf, subroot, root, proof, folded root) of rows (doc_id, source, lang, n_chars, text), plainly."""

    def leaf(r):
        return h("".join(map(enc, r)))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            proof, node = [], leaf(claim(r))
            for levels, place in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    j = place ^ 1
                    if j < len(level):
                        proof.append(level[j])
                        node = h(level[j] + node if place % 2 else node + level[j])
                    else:
                        node = h(node)
                    place //= 2
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], "".join(proof), node))
    return out


def tampered(r):
    hit = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
    return (*r[:3], r[3] + 1, r[4]) if hit else r


def of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def key(row):
    return tuple(("" if x is None else str(x)) for x in row)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_the_query_by_brute_force(spark, folder):
    found = QUERIES["op13_merkle_manifest"](spark, folder)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    rows = found.collect()
    wanted = brute(of(spark.read.parquet(f"{folder}/documents.parquet")), tampered)
    assert sorted([tuple(r[c] for c in columns) for r in rows], key=key) == sorted([(*w[:4], h(w[4]), w[5]) for w in wanted], key=key)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)
    assert {r["verified"] for r in rows} == {True, False}


def _leaf():
    return manifest.digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])


def test_odd_rows_by_brute_force(spark, edge_docs, no_docs):
    found = manifest.build(edge_docs, _leaf()).collect()
    wanted = brute(of(edge_docs))
    rows = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in found]
    assert sorted(rows, key=key) == sorted(wanted, key=key)
    assert all(r["verified"] for r in found)
    assert manifest.build(no_docs, _leaf()).collect() == []
    one = edge_docs.where("doc_id = 5")
    row = manifest.build(one, _leaf()).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof"] == ""


def test_wide_and_repeated_ids_by_brute_force(spark, monkeypatch):
    """Ids over the whole range, a row that is there thousands of times, many groups, and several rounds of arrays."""
    draw = np.random.default_rng(3)
    ids = [*draw.integers(-(2**63), 2**63 - 1, 300).tolist(), *range(2_500), -1, 2**63 - 1, -(2**63), *[7] * 3_000]
    rows = [(i, "s", "en" if k % 3 else f"g{k % 40}", 5, "a") for k, i in enumerate(ids)]
    rows += [(9, "s", "en", 5, "same")] * 2_100 + [(None, "s", None, 5, f"t{k}") for k in range(1_100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = manifest.build(docs, _leaf())
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"]) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_proofs_bind_the_place():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(11)]
    slots = b"".join(leaves)
    levels = [slots]
    while len(levels[-1]) > 32:
        levels.append(manifest.above(levels[-1]))
    for i, proof in enumerate(manifest.beside(slots, 11)):
        assert manifest.fold(leaves[i], [(i, 11)], proof) == levels[-1]
        assert manifest.fold(leaves[i - 1], [(i, 11)], proof) != levels[-1]


@pytest.mark.parametrize("kind", ["few", "many", "dense", "repeated", "full"])
def test_ranks_of_bitmaps(kind):
    draw = np.random.default_rng(len(kind))
    lows = {
        "few": draw.integers(0, SIZE, 5), "many": draw.integers(0, SIZE, 1_500), "dense": np.arange(100, 3_000),
        "repeated": draw.integers(0, 40, 3_000), "full": np.arange(SIZE),
    }[kind]
    times = draw.integers(1, 4, len(lows))
    made = Container.unpack(Container.of(lows, times).pack())
    every = np.repeat(lows, times)
    asked = np.arange(SIZE)
    assert len(made) == len(every)
    assert made.rank(asked).tolist() == [int((every < x).sum()) for x in asked]
    parts = [Container.of(lows[i::3], times[i::3]) for i in range(3)]
    assert Container.merged(parts).pack() == made.pack()
    assert len(Container.of(np.arange(SIZE), np.ones(SIZE, dtype=int)).pack()) < 20 and len(made.pack()) < 3 + SIZE // 8 + 10 * len(made.low) + 1


def test_no_row_is_sorted(spark, small_docs):
    plan = manifest._placed(manifest._leaves(small_docs, "doc_id", "lang", _leaf(), _leaf()), spark.createDataFrame(
        [], "key string, part int, high long, n long, bitmap binary, base long, total long"
    ))._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan
