import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from jobmart.llm import darts, nearcopies, words
from jobmart.llm.graph import components


def shingle_set(text):
    words = (text or "").lower().split()
    runs = Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()
    return frozenset((run, n) for run in runs for n in range(runs[run]))


def brute_classes(texts):
    """The least id of each id's class, by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            shared = len(sets[a] & sets[b])
            if sets[a] == sets[b] or shared and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def test_components_by_brute_force(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(190)] + [(1_000 + i, 1_001 + i) for i in range(60)]
    edges += [(5_000, 5_000 + i) for i in range(1, 50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = components(spark.createDataFrame(edges, "a long, b long"))
    wanted = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found.collect()} == wanted
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classes_by_brute_force(spark):
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for base in range(25):
        words = draw.choices(vocabulary, k=draw.choice([3, 12, 60, 300]))
        for _ in range(draw.choice([1, 2, 6])):
            copy = list(words)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            text = " ".join(copy)
            texts[len(texts)] = draw.choice([text, text.upper(), text.replace(" ", "\n ")])
    # A chain: neighbours are near, the ends are not.
    words = draw.choices(vocabulary, k=100)
    for step in range(12):
        words[step * 8] = f"new{step}"
        texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in nearcopies.near_copies(docs).collect()}
    assert found == brute_classes(texts)
    assert len({found[i] for i in sorted(texts)[-12:]}) == 1
    kept = {r["doc_id"] for r in nearcopies.keep_one(docs).collect()}
    assert kept == set(found.values())


def test_repeated_words_weigh(spark):
    texts = {1: "a b c d e " * 40, 2: "a b c d e " * 39, 3: "a b c d e " * 20}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nearcopies.near_copies(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_small_documents_by_brute_force(spark, small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    found = nearcopies.near_copies(small_docs.select("doc_id", F.col("text")))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == brute_classes(texts)


def test_sketches_tell_unlike_texts_apart():
    pools = [words.mixed(np.arange(1 + 500 * k, 401 + 500 * k, dtype=np.uint64)) for k in range(2)]
    for size in (180, 1_024):
        a, b = (nearcopies._sketch(darts.signature(x, np.ones(len(x)), size)) for x in pools)
        pairs = (a[:, None] ^ b[:, None]) >> np.arange(0, 64, 2, dtype=np.uint64) & np.uint64(3)
        assert abs((pairs.ravel()[:size] == 0).mean() - 0.25) < 0.12


def _varied(draw, words, edits, name):
    copy = list(words)
    for k, at in enumerate(draw.sample(range(len(words)), edits)):
        copy[at] = f"{name}x{k}"
    return " ".join(copy)


def test_many_that_stray_from_one_original_meet_seldom(spark):
    """Half of the variants are near their original and half are not; as sets they are alike, and no two are near."""
    draw = random.Random(3)
    words = [f"w{draw.randrange(10_000)}" for _ in range(200)]
    texts = {0: " ".join(words)} | {i: _varied(draw, words, 3 + i % 7, f"v{i}") for i in range(1, 160)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nearcopies.near_copies(docs).collect()} == brute_classes(texts)


def test_pairs_by_rarest_elements_miss_none(spark):
    draw = random.Random(5)
    sets = {}
    for base in range(12):
        core = [draw.randrange(5_000) for _ in range(draw.choice([1, 2, 5, 40, 90]))]
        for _ in range(6):
            kept = [x for x in core if draw.random() > draw.choice([0, 0.05, 0.2])] or core[:1]
            sets[len(sets)] = sorted({*kept, *(draw.randrange(200) for _ in range(draw.choice([0, 0, 1, 4])))})
    table = spark.createDataFrame(list(sets.items()), "node long, set array<long>")
    classes = table.select("node", (F.col("node") % 50).alias("class"))
    found = {(r["a"], r["b"]) for r in nearcopies._meeting(table, classes, 0.8).collect()}
    wanted = {
        (a, b) for a in sets for b in sets
        if a > b and a % 50 != b % 50 and len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})
    }
    assert wanted <= found and len(wanted) > 30 and len(found) < 3 * len(wanted)


def test_ids_with_several_texts(spark):
    a, b, c = ("one two three four five six " * 3, "seven eight nine ten eleven " * 4, "red green blue black white " * 5)
    rows = [(1, a), (1, b), (2, a), (1, b), (5, c), (6, c), (None, c), (None, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(nearcopies.near_copies(docs).groupBy("class_id").count().collect())
    assert sorted(r["count"] for r in found) == [1, 2, 2, 3]
    kept = [tuple(r) for r in nearcopies.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (5, c), (None, "x y z")], key=str)
