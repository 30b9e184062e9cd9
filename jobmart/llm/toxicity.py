"""Toxicity of texts by a recurrent network that reads all overlapping windows of words.

A text is as toxic as its most toxic window. The network is learned from labels of whole texts: a text is toxic if
any of its windows is, so the chances that none is multiply. Words are lower-cased and rid of most punctuation; their
runs of characters let the network know words that it has not seen, by their stems.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm import gru, linear, words
from jobmart.llm.common import labelled_sample

#: Words of a window, and the words from the start of one to that of the next.
WINDOW, STRIDE = 32, 24
#: The score from which a text counts as toxic.
THRESHOLD = 0.3
#: Bounds of the sample: documents of a class, windows of a document, and bytes of a window.
SAMPLE_ROWS, SAMPLE_WINDOWS, SAMPLE_BYTES = 600, 16, 2_000
#: Documents of the sample in which a word must be to have a vector of its own.
MIN_DOCS = 3
GRAM_BITS, GRAM_SIZES = 14, (3, 4, 5)
EPOCHS, BATCH = 5, 48
#: How often a toxic label may be wrong: documents that look harmless in spite of it are not learned by heart.
WRONG = 0.1
#: Bytes of text that are worked on at a time; a longer text is worked on alone.
BLOCK = 1 << 21

_APART, _GONE = 0, 1
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[[*range(0, 33), 127, *b'/,;:|()[]{}<>"']] = _APART
_FORM[[*b"!#$%&'*+-.=?@\\^_`~"]] = _GONE


def _tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the words, lower-cased, and where each begins and ends."""
    form = _FORM[data]
    form = form[form != _GONE]
    # Capitals of the Latin-1 letters: the second of two bytes.
    second = np.flatnonzero(form[:-1] == 0xC3) + 1
    second = second[(form[second] >= 0x80) & (form[second] <= 0x9E) & (form[second] != 0x97)]
    form[second] += 0x20
    inside = np.concatenate([[False], form != _APART, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return form, edges[::2], edges[1::2]


def _grams(form: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the runs of characters of words, ends marked, and where those of each word begin."""
    sizes = ends - starts + 2
    first = np.cumsum(sizes) - sizes
    text = np.full(int(sizes.sum()), 32, dtype=np.uint64)  # a space marks both ends
    inner = np.arange(len(text)) - np.repeat(first, sizes)
    body = (inner > 0) & (inner < np.repeat(sizes, sizes) - 1)
    text[body] = form[(np.repeat(starts, sizes) + inner - 1)[body]]
    left = np.repeat(sizes, sizes) - inner  # characters from here to the word's end
    found, owner, of = [], [], np.repeat(np.arange(len(sizes)), sizes)
    for size in GRAM_SIZES:
        n = len(text) - size + 1
        if n <= 0:
            continue
        code = np.full(n, size, dtype=np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | text[k : k + n]
        whole = left[:n] >= size
        found.append((words.mixed(code[whole]) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        owner.append(of[:n][whole])
    if not found:
        return np.empty(0, dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    grams, owners = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return grams[order], np.searchsorted(owners[order], np.arange(len(sizes)))


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows over texts of so many words each: (text, first word, end) of each, and where those of each text begin.

    Every word is in a window and every text has one, if an empty one.
    """
    many = np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1
    first = np.cumsum(many) - many
    of = np.repeat(np.arange(len(counts)), many)
    base = np.cumsum(counts) - counts
    start = (np.arange(len(of)) - first[of]) * STRIDE
    return np.column_stack([of, base[of] + start, base[of] + np.minimum(counts[of], start + WINDOW)]), first


@dataclass(frozen=True)
class Batch:
    """Texts as windows over distinct words; ``first`` is where the windows of each text begin."""

    hashes: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    windows: np.ndarray
    first: np.ndarray


def batch_of(texts: list[bytes]) -> Batch:
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    form, starts, ends = _tokens(data)
    hashed = words.hashes(form, starts, ends) if len(starts) else np.empty(0, dtype=np.uint64)
    # Where each text ends, in bytes that stay.
    kept = np.concatenate([[0], np.cumsum(_FORM[data] != _GONE)])
    sizes = np.array([len(t) for t in texts])
    bounds = kept[np.cumsum(sizes + 1) - 1]
    upto = np.searchsorted(starts, bounds)
    counts = np.diff(np.concatenate([[0], upto]))
    distinct, index, place = np.unique(hashed, return_index=True, return_inverse=True)
    grams, gram_starts = _grams(form, starts[index], ends[index])
    spans, first = _windows(counts)
    at = spans[:, 1, None] + np.arange(WINDOW)
    inside = at < spans[:, 2, None]
    windows = np.full(at.shape, -1, dtype=np.int64)
    windows[inside] = place[at[inside]]
    return Batch(distinct, grams, gram_starts, windows, first)


@dataclass(frozen=True)
class Model:
    """The network, the hashes of the words with vectors of their own, ascending, and the calibration."""

    network: gru.Network
    known: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def inputs(self, batch: Batch) -> gru.Inputs:
        rows = np.searchsorted(self.known, batch.hashes)
        own = rows < len(self.known)
        own[own] = self.known[rows[own]] == batch.hashes[own]
        return gru.Inputs(np.where(own, rows, len(self.known)), batch.grams, batch.starts)

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """The logit of each text's most toxic window."""
        found, held, size = [np.empty(0)], [], 0
        for k, text in enumerate(texts):
            held.append(text)
            size += len(text)
            if size >= BLOCK or k + 1 == len(texts):
                batch = batch_of(held)
                found.append(np.maximum.reduceat(self.network.logits(self.inputs(batch), batch.windows), batch.first))
                held, size = [], 0
        return np.concatenate(found).astype(float)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        return linear.sigmoid(self.slope * self.raw(texts) + self.intercept)


def excerpts(text: Column) -> Column:
    """Some windows of a text for the sample, spread evenly over it: all of a short one."""

    @F.pandas_udf("array<binary>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                found = (value or b"").split()
                starts = list(range(0, max(1, len(found) - WINDOW + STRIDE), STRIDE))
                step = max(1, -(-len(starts) // SAMPLE_WINDOWS))
                out.append([b" ".join(found[a : a + WINDOW])[:SAMPLE_BYTES] for a in starts[::step]])
            yield pd.Series(out)

    return run(text.cast("binary"))


def train(sample: list[tuple[int, list[bytes]]], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """A network from (label, windows) of documents. Windows of one document share its label: any may be the reason."""
    docs: dict[int, int] = {}
    for _, parts in sample:
        for x in np.unique(batch_of([b" ".join(parts)]).hashes).tolist():
            docs[x] = docs.get(x, 0) + 1
    known = np.array(sorted(x for x, n in docs.items() if n >= MIN_DOCS), dtype=np.uint64)
    model = Model(gru.Network.new(len(known), 1 << GRAM_BITS, seed), known)
    steps, draw = gru.Adam(model.network.weights), np.random.default_rng(seed)
    for epoch in range(epochs):
        steps.rate = 0.02 * (1 - 0.7 * epoch / epochs)
        order = draw.permutation(len(sample))
        for i in range(0, len(order), BATCH):
            chosen = [sample[k] for k in order[i : i + BATCH]]
            batch = batch_of([p for _, parts in chosen for p in parts])
            many = np.array([len(parts) for _, parts in chosen])
            # Each excerpt is a text of its own here; its windows belong to its document.
            per_text = np.diff(np.append(batch.first, len(batch.windows)))
            of = np.repeat(np.repeat(np.arange(len(chosen)), many), per_text)
            labels = np.array([label for label, _ in chosen])

            def slope(logits: np.ndarray, of=of, labels=labels, n=len(chosen)) -> np.ndarray:
                chance = linear.sigmoid(logits)
                none = np.bincount(of, np.logaddexp(0, logits), n)  # minus the logarithm of: no window is toxic
                any_ = -np.expm1(-none)
                trusted = (1 - WRONG) * any_ / ((1 - WRONG) * any_ + WRONG)
                pull = np.where(labels == 1, -trusted / np.expm1(np.maximum(none, 1e-4)), 1.0)
                return chance * pull[of] / n

            _, slopes = model.network.gradients(model.inputs(batch), batch.windows, slope)
            norm = np.sqrt(sum(float((s**2).sum()) for s in slopes.values()))
            steps.step({k: s * min(1.0, 1.0 / max(norm, 1e-9)) for k, s in slopes.items()})
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        rows: int = SAMPLE_ROWS, usable: Column | None = None) -> Model | None:
    """A model from about ``rows`` labelled documents of each class, the bound of the sample; None without both.

    ``usable`` says which rows of ``labels`` may be learned from; all that are not held out, by default. The
    calibration sees the scores of the whole texts of the sample, and how common each class is among all labels.
    """
    sample, counts = labelled_sample(docs, labels, label, rows, excerpts(F.col(text)), doc_id, usable)
    if len({c for c, _ in sample}) < 2:
        return None
    model = train([(c, [bytes(p) for p in parts]) for c, parts in sample])
    scored, _ = labelled_sample(docs, labels, label, rows, raw_score(F.col(text), model), doc_id, usable)
    classes, scores = np.array([c for c, _ in scored]), np.array([s for _, s in scored])
    slope, intercept = linear.calibrate(scores, classes)
    seen = np.bincount(classes, minlength=2)
    prior = np.log((counts[1] / counts[0]) / (seen[1] / seen[0]))
    return Model(model.network, model.known, slope, intercept + float(prior))


def raw_score(text: Column, model: Model) -> Column:
    """The score of whole texts, of any size."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.raw([value or b"" for value in batch]))

    return run(text.cast("binary"))


def score(text: Column, model: Model | None) -> Column:
    """0 to 1, higher for more toxic texts. Null counts as empty. Without a model every text scores 0."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.probabilities([value or b"" for value in batch]))

    return run(text.cast("binary"))


def classify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, 1 from the threshold on; columns of these names are replaced.

    Rows that repeat score alike; an empty table gives no rows.
    """
    old = docs.drop(*{"score", "predicted"} - {text})
    found = docs.select(*old.columns, score(F.col(text), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
