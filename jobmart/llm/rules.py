"""Quality rules: exact counts over a text's words and lines, then a calibrated classifier on hashed n-grams.

The counts alone fail a text that is too short or repeats itself. What passes is judged by logistic regression on
hashed word and character n-grams, learned from labelled rows and scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm import linear, words
from jobmart.llm.common import labelled_sample

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Probability of good quality from which a text is kept.
KEEP_FROM = 0.5

BITS = 16
SAMPLE_ROWS = 400
STRIPPED = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated_words(hashed: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in a window found at least twice in the text."""
    runs = words.windows(hashed, size)
    if len(runs) < 2:
        return 0
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(hashed) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    covered[at] += 1
    np.subtract.at(covered, at + size, 1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in data.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip(STRIPPED):
            seen.add(line)
    return found


def characters(data: np.ndarray) -> np.ndarray:
    """The code points of UTF-8 bytes; what is not UTF-8 becomes U+FFFD."""
    if not (data & 0x80).any():
        return data.astype(np.uint32)
    return np.frombuffer(data.tobytes().decode(errors="replace").encode("utf-32-le"), dtype="<u4").astype(np.uint32)


def ngram_features(data: np.ndarray, hashed: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed features: words, pairs of words, and runs of three and four characters."""
    shift = np.uint64(64 - BITS)
    for kind, runs in enumerate((hashed, words.windows(hashed, 2))):
        yield (words.numbered(runs, 100 + kind) >> shift).astype(np.int64)
    wide = characters(data)
    for size in (3, 4):
        n = len(wide) - size + 1
        if n > 0:
            code = wide[:n].copy()
            for k in range(1, size):
                code = code * np.uint32(0x01000193) + wide[k : k + n]
            yield ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class RuleModel:
    """Weights of the hashed features, and slope and intercept of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    intercept: float = 0.0

    def probability(self, data: np.ndarray, hashed: np.ndarray) -> float:
        """Of good quality. The mean weights of each kind of feature are summed, so long and short texts are alike."""
        score = self.bias + sum(float(self.weights[f].mean()) for f in ngram_features(data, hashed) if len(f))
        return float(linear.sigmoid(self.slope * score + self.intercept))


def feature_shares(text: Column) -> Column:
    """The share of each hashed feature among the features of its kind."""

    @F.pandas_udf("features array<int>, shares array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                data = words.as_bytes(value)
                hashed = words.hashes(data, *words.bounds(data))
                shares = np.zeros(1 << BITS)
                for f in ngram_features(data, hashed):
                    if len(f):
                        shares += np.bincount(f, minlength=1 << BITS) / len(f)
                at = np.flatnonzero(shares)
                out.append((at.astype(np.int32), shares[at].astype(np.float32)))
            yield pd.DataFrame(out, columns=["features", "shares"])

    return run(text.cast("binary"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        rows: int = SAMPLE_ROWS) -> RuleModel | None:
    """A model from about ``rows`` labelled documents of each class, the bound of the sample; None without both.

    Every fourth document of the sample is kept out of the weights and used for the calibration, whose intercept
    then accounts for how common each class is among all labels.
    """
    sample, counts = labelled_sample(docs, labels, label, rows, feature_shares(F.col(text)), doc_id)
    classes = np.array([c for c, _ in sample])
    if len(set(classes)) < 2:
        return None
    order = np.argsort(classes, kind="stable")
    rank = np.empty(len(order), dtype=int)
    rank[order] = np.arange(len(order))
    apart = rank % 4 == 0
    if len(set(classes[apart])) < 2 or len(set(classes[~apart])) < 2:
        apart = np.zeros(len(classes), dtype=bool)
    index = np.repeat(np.arange(len(sample)), [len(f["features"]) for _, f in sample])
    features = np.concatenate([np.array(f["features"], dtype=np.int64) for _, f in sample])
    shares = np.concatenate([np.array(f["shares"]) for _, f in sample])
    learned = ~apart
    place = np.cumsum(learned) - 1
    use = learned[index]
    weights, bias = linear.fit_sparse(
        place[index[use]], features[use], shares[use], classes[learned], 1 << BITS
    )
    scores = np.bincount(index, weights[features] * shares, len(sample)) + bias
    judged = apart if apart.any() else learned
    slope, intercept = linear.calibrate(scores[judged], classes[judged])
    seen = np.bincount(classes[judged], minlength=2)
    prior = np.log((counts[1] / counts[0]) / (seen[1] / seen[0]))
    return RuleModel(weights.astype(np.float32), bias, slope, intercept + float(prior))


def judge(text: Column, model: RuleModel | None) -> Column:
    """A struct of the counts in ``COUNTS`` and ``probability``; null and empty texts have no words and no line.

    Without a model the probability is 1: the counts alone decide.
    """

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS) + ", probability double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                data = words.as_bytes(value)
                starts, ends = words.bounds(data)
                hashed = words.hashes(data, starts, ends)
                chars = int((((data & 0xC0) != 0x80) & ~words.SEPARATOR[data]).sum())
                out.append((
                    len(hashed), chars, int(_SYMBOL[data].sum()), duplicate_lines(value or b""), repeated_words(hashed),
                    1.0 if model is None else model.probability(data, hashed),
                ))
            yield pd.DataFrame(out, columns=[*COUNTS, "probability"])

    return run(text.cast("binary"))


def apply_rules(docs: DataFrame, model: RuleModel | None, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``probability`` and ``kept``; columns of these names are replaced."""
    old = docs.drop(*COUNTS, "base_failed", "probability", "kept")
    found = docs.select(*old.columns, judge(F.col(text), model).alias("_found")).select(*old.columns, "_found.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= keep_from))
