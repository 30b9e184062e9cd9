import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import gru, toxicity, words
from jobmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"
GONE, APART = "!#$%&'*+-.=?@\\^_`~\"".replace('"', ""), "/,;:|()[]{}<>\"\x7f" + "".join(map(chr, range(33)))


def test_held_out_documents(spark):
    found = QUERIES["op11_toxicity"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = found.join(labels, "doc_id").join(docs, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    apart = [r for r in rows if r["held_out"]]
    harmless = [r["predicted"] for r in apart if not r["toxic"]]
    # Some labels are given to texts without any toxic word; of the others nearly all are found.
    insults = re.compile(r"\b(idiot|moron|scum|loser|stupid|worthless|pathetic|disgusting|trash|clown)\b", re.IGNORECASE)
    plain = [r["predicted"] for r in apart if r["toxic"] and insults.search(r["text"] or "")]
    assert len(plain) > 30 and np.mean(plain) > 0.98 and np.mean(harmless) < 0.03
    assert np.mean([r["predicted"] == r["toxic"] for r in apart]) > 0.96


def test_labels_that_are_held_out_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    assert toxicity.fit(docs, labels, usable=F.lit(False)) is None


def _plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text)
    return re.split(f"[{re.escape(APART)}]+", "".join(c for c in lower if c not in GONE))


TEXTS = ["", "Hello, WORLD! don't", "ÄRGER ÀÞ× über", "a.b.c - ... d/e", "\x00\x1f x", "идиот ИДИОТ 😀", "w " * 75, "...", "x" * 3_000]


def test_words_grams_and_windows_by_brute_force():
    batch = toxicity.batch_of([t.encode() for t in TEXTS])
    at = 0
    for text, first, end in zip(TEXTS, batch.first, [*batch.first[1:], len(batch.windows)], strict=True):
        plain = [w for w in _plain_words(text) if w]
        spans = [plain[a : a + 32] for a in range(0, max(1, len(plain) - 32 + 24), 24)]
        found = [[batch.hashes[i] for i in row if i >= 0] for row in batch.windows[first:end]]
        data = [np.frombuffer(w.encode(), dtype=np.uint8) for w in plain]
        hashed = dict(zip(plain, [words.hashes(d, np.array([0]), np.array([len(d)]))[0] for d in data], strict=True))
        assert found == [[hashed[w] for w in part] for part in spans]
        for w in plain:
            i = int(np.searchsorted(batch.hashes, hashed[w]))
            grams = np.split(batch.grams, batch.starts[1:])[i]
            assert len(grams) == sum(max(0, len(w.encode()) + 2 - k + 1) for k in toxicity.GRAM_SIZES)
        at = end
    assert at == len(batch.windows)


def _network(seed, n_words=5):
    draw = np.random.default_rng(seed)
    net = gru.Network.new(n_words, 1 << toxicity.GRAM_BITS, seed)
    for k, v in net.weights.items():
        net.weights[k] = (v + draw.normal(size=v.shape) * 0.3).astype(np.float32)
    return net


def _one_by_one(net, vectors):
    """A window's logit, word after word as the formulas are worded."""
    w, size = net.weights, gru.HIDDEN
    both = []
    for way in (0, 1):
        state, states = np.zeros(size), []
        for v in vectors if way == 0 else vectors[::-1]:
            x = (v @ w["into"] + w["bias"])[way * 3 * size : (way + 1) * 3 * size]
            g = state @ w["again"][way]
            z, r = 1 / (1 + np.exp(-(x[:size] + g[:size]))), 1 / (1 + np.exp(-(x[size : 2 * size] + g[size : 2 * size])))
            state = (1 - z) * np.tanh(x[2 * size :] + r * g[2 * size :]) + z * state
            states.append(state)
        both.append(states if way == 0 else states[::-1])
    states = np.array([np.concatenate(s) for s in zip(*both, strict=True)])
    marks = np.tanh(states @ w["look"] + w["look_bias"]) @ w["mark"]
    share = np.exp(marks) / np.exp(marks).sum()
    return share @ states @ w["out"] + w["out_bias"][0]


def test_the_network_by_the_formulas():
    texts = [t.encode() for t in (*TEXTS, "one two three " * 40)]
    batch, net = toxicity.batch_of(texts), _network(1)
    model = toxicity.Model(net, batch.hashes[:5])
    inputs = model.inputs(batch)
    vectors = net._vectors(inputs)
    for row, logit in zip(batch.windows, net.logits(inputs, batch.windows), strict=True):
        some = row[row >= 0]
        wanted = _one_by_one(net, vectors[some]) if len(some) else net.weights["out_bias"][0]
        assert abs(wanted - logit) < 1e-4


def test_slopes_by_differences():
    batch, net = toxicity.batch_of([b"one two three four", b"five one", b"", b"six seven " * 30]), _network(2)
    inputs = toxicity.Model(net, batch.hashes[:5]).inputs(batch)
    pull = np.random.default_rng(3).normal(size=len(batch.windows))
    _, slopes = net.gradients(inputs, batch.windows, lambda _: pull)
    for name, weights in net.weights.items():
        # Along the slope itself, so that single precision is enough.
        way = slopes[name] / (np.linalg.norm(slopes[name]) + 1e-9) * 1e-2
        kept = weights.copy()
        weights[...] = kept + way
        up = float(net.logits(inputs, batch.windows) @ pull)
        weights[...] = kept - way
        down = float(net.logits(inputs, batch.windows) @ pull)
        weights[...] = kept
        assert (up - down) / 2 == pytest.approx(float((slopes[name] * way).sum()), rel=0.03, abs=1e-5), name


def test_batches_do_not_change_scores(monkeypatch):
    batch = toxicity.batch_of([t.encode() for t in TEXTS])
    model = toxicity.Model(_network(5), batch.hashes[:5])
    together = model.raw([t.encode() for t in TEXTS])
    alone = np.concatenate([model.raw([t.encode()]) for t in TEXTS])
    assert np.abs(together - alone).max() < 1e-5
    monkeypatch.setattr(toxicity, "BLOCK", 1)
    assert np.abs(model.raw([t.encode() for t in TEXTS]) - alone).max() < 1e-5
    assert len(model.raw([])) == 0


def test_odd_rows(spark, edge_docs, no_docs):
    labels = edge_docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).where("doc_id is not null")
    model = toxicity.fit(edge_docs, labels)
    assert model is not None
    found = toxicity.classify(edge_docs, model)
    assert sorted(found.columns) == sorted(edge_docs.columns)  # columns of these names are replaced
    rows = found.collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["text"] is None or not r["text"].strip()}) == 1
    assert toxicity.classify(no_docs, model).collect() == [] and toxicity.fit(no_docs, labels) is None
    assert {r["score"] for r in toxicity.classify(edge_docs, None).collect()} == {0.0}
