import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobmart.llm import periodic
from jobmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute_runs(ids, least=24, times=3):
    """(start, period, length) by all starts and lags; a period counts if no smaller one fits the stretch."""
    n, found = len(ids), set()
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                part = ids[i : i + size]
                if all(part[r:] != part[:-r] for r in range(1, q)):
                    found.add((i, q, size))
            i = max(j, i + 1)
    return sorted(found)


def made(draw):
    ids = []
    for _ in range(draw.randrange(1, 6)):
        kinds = draw.choice([1, 2, 3, 30, 1_000])
        if draw.random() < 0.6:
            part = [draw.randrange(kinds) for _ in range(draw.randrange(1, 25))]
            ids += (part * draw.randrange(1, 8))[: draw.randrange(1, 200)]
        else:
            ids += [draw.randrange(kinds) for _ in range(draw.randrange(60))]
    return ids


def test_runs_by_brute_force():
    draw, hits = random.Random(3), 0
    for _ in range(1_500):
        ids = made(draw)
        wanted = brute_runs(ids)
        hits += len(wanted)
        assert [(r.start, r.period, r.length) for r in periodic.runs(np.array(ids, dtype=np.int64))] == wanted
    assert hits > 500


def test_other_bounds_by_brute_force():
    draw = random.Random(4)
    for _ in range(400):
        ids, least, times = made(draw), draw.randrange(1, 40), draw.randrange(3, 6)
        found = periodic.runs(np.array(ids, dtype=np.int64), least, times)
        assert [(r.start, r.period, r.length) for r in found] == brute_runs(ids, least, times)


def test_segments_hold_only_words_that_are_common_in_them():
    ids = np.array([*range(50), *[1, 2, 3] * 20, 77, *[5] * 30, 1, 1])
    parts = periodic.segments(ids)
    assert parts == [(50, 110), (111, 141)]
    # A word that is common in the whole text may be rare in a part; then that part is split once more.
    ids = np.array([*[1, 2] * 12, 7, 50, *[3, 4] * 12, 7, 51, *[5, 6] * 12, 7])
    assert periodic.segments(ids) == [(0, 24), (26, 50), (52, 76)]


def test_long_texts_take_a_bounded_time():
    assert [(r.start, r.period, r.length) for r in periodic.runs(np.zeros(100_000, dtype=np.int64))] == [(0, 1, 100_000)]
    part = np.random.default_rng(1).integers(0, 50_000, 40_000)
    found = periodic.runs(np.tile(part, 4)[:-7])
    assert [(r.start, r.period, r.length) for r in found] == [(0, 40_000, 159_993)]
    assert periodic.runs(np.random.default_rng(2).integers(0, 9, 100_000)) == []


def wanted_row(doc_id, text):
    """The query's row by the plainest way."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    known = {}
    found = brute_runs([known.setdefault(w, len(known)) for w in words])
    gone = {i for s, q, size in found for i in range(s + q, s + size)}
    best = max(found, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, q, size in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(found), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_the_query_by_brute_force(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] for r in rows.values()) > 5
    for d in docs:
        if len((d["text"] or "").split()) < 3_000:
            assert tuple(rows[d["doc_id"]][c] for c in COLUMNS) == wanted_row(d["doc_id"], d["text"])


def test_odd_rows(spark, edge_docs, no_docs):
    found = periodic.collapse_text(edge_docs)
    assert found.schema.names[: len(edge_docs.columns)] == edge_docs.columns
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        if r["text"] is None or not r["text"].strip():
            assert (r["n_words"], r["n_runs"], r["runs"], r["collapsed"], r["start"]) == (0, 0, "", "", None)
    many = next(r for r in rows if r["text"] == "\n".join(["same line"] * 50))
    assert (many["n_runs"], many["start"], many["length"], many["period"], many["collapsed"]) == (1, 0, 100, 2, "same line")
    assert periodic.collapse_text(no_docs).collect() == []
    planted = edge_docs.select(periodic.planted(F.col("text"), F.lit(None).cast("long")).cast("string").alias("t"))
    assert planted.exceptAll(edge_docs.select(F.col("text").alias("t"))).count() == 0


@pytest.mark.parametrize("separator", ["\t", "\n\n", "\x0b", "\x0c ", "\r\n"])
def test_separators(spark, separator):
    df = spark.createDataFrame([(separator.join(["a b", "c\x1cd"] * 12),)], "text string")
    row = periodic.collapse_text(df).first()
    assert (row["n_words"], row["length"], row["period"], row["collapsed"]) == (24, 24, 2, "a b c\x1cd")
