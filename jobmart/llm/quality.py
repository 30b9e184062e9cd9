"""A quality classifier by pairwise ranking.

Pairs of a better and a worse document give a Bradley-Terry model: the probability that one is preferred is the
logistic function of the difference of their scores, and a score is a linear function of a text's features. Documents
are then told apart by a quantile of the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm import linear, rules, words
from jobmart.llm.common import fold, labelled_sample, stored

#: The score that stands for the quantile's threshold.
THRESHOLD = 0.3
SAMPLE_ROWS = 700
PAIRS = 20_000
#: Parts into which a range of scores is cut at a time, to find a rank.
PARTS = 4_096

_UPPER, _LETTER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
N_FEATURES = 18


def features(value: bytes | None) -> np.ndarray:
    """Shares and means that describe a text's form, whatever its length; all but the size are 0 for an empty one."""
    data = words.as_bytes(value)
    starts, ends = words.bounds(data)
    n = len(starts)
    if not n:
        return np.zeros(N_FEATURES)
    hashed, sizes = words.hashes(data, starts, ends), ends - starts
    inside = int(sizes.sum())
    counts = np.unique(hashed, return_counts=True)[1]
    letters = max(1, int(_LETTER[data].sum()))
    lines = (value or b"").count(b"\n") + 1
    bare = ~_LETTER[data[starts]]
    last = _MARK[data[ends - 1]]
    double = last & (sizes > 1) & _MARK[data[np.maximum(ends - 2, 0)]]
    return np.array([
        np.log1p(n), sizes.mean(), sizes.std(), _UPPER[data].sum() / letters, _MARK[data].sum() / inside,
        _DIGIT[data].sum() / inside, rules._SYMBOL[data].sum() / inside, bare.mean(), last.mean(), double.mean(),
        (sizes == 1).mean(), counts.max() / n, len(counts) / n, rules.repeated_words(hashed) / n,
        rules.duplicate_lines(value or b"") / lines, np.log1p(n / lines), min(n, 20) / 20,
        (hashed[1:] == hashed[:-1]).sum() / n,
    ])


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(value) for value in batch])

    return run(text.cast("binary"))


@dataclass(frozen=True)
class PreferenceModel:
    """Scores are ``weights`` times the standardised features; ``threshold`` is the quantile's score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6) @ self.weights

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, ``THRESHOLD`` at the threshold."""
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return linear.sigmoid(self.slope * (self.scores(rows) - self.threshold) + at)


def fit_pairs(better: np.ndarray, worse: np.ndarray, steps: int = 40, penalty: float = 1e-3) -> np.ndarray:
    """Weights that make the difference of preferred and other features positive; logistic loss, Newton steps."""
    gap = better - worse
    weights = np.zeros(gap.shape[1])
    for _ in range(steps):
        p = linear.sigmoid(gap @ weights)
        slope = -(gap * (1 - p)[:, None]).mean(0) + penalty * weights
        bend = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + penalty * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        rows: int = SAMPLE_ROWS, pairs: int = PAIRS) -> PreferenceModel | None:
    """A model from ``pairs`` pairs out of about ``rows`` labelled documents of each class; None without both classes.

    The threshold is the quantile at the share of label 0, of the scores of all labelled documents that are not held out.
    """
    sample, _ = labelled_sample(docs, labels, label, rows, feature_column(F.col(text)), doc_id)
    classes = np.array([c for c, _ in sample])
    if len(set(classes)) < 2:
        return None
    x = np.array([f for _, f in sample])
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -6, 6)
    draw = np.random.default_rng(7)
    good, bad = np.flatnonzero(classes == 1), np.flatnonzero(classes == 0)
    weights = fit_pairs(z[draw.choice(good, pairs)], z[draw.choice(bad, pairs)])
    scores = z @ weights
    slope, _ = linear.calibrate(scores, classes)
    model = PreferenceModel(mean, scale, weights, 0.0, slope)

    usable = labels.where(F.col(label).isin(0, 1)).where(fold(doc_id) != 0)
    known = usable.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    # Scored before the join, so that no text moves there.
    scored = docs.where(fold(doc_id) != 0).select(F.col(doc_id).alias("_id"), raw_score(F.col(text), model).alias("_score"))
    found = stored(scored.join(known, "_id").select("_label", "_score"), "label-scores")
    low, high = ranked(found, "_score", found.where("_label = 0").count())
    return replace(model, threshold=(low + high) / 2)


def ranked(df: DataFrame, column: str, rank: int) -> tuple[float, float]:
    """The ``rank``-th least number of a column and the one after it, exactly: the range that holds it is cut until it is
    one number, so no more than ``PARTS`` counts are ever in one place. The rank is from 1 to one less than the rows.
    """
    x = F.col(column)
    low, high = df.agg(F.min(x), F.max(x)).first()
    after = high
    while low < high:
        part = F.least(F.floor((x - low) / (high - low) * PARTS), F.lit(PARTS - 1))
        counts = df.where(x.between(low, high)).groupBy(part.alias("part")).agg(
            F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")
        )
        parts = sorted(counts.collect(), key=lambda r: r["low"])
        below = df.where(x < low).count()
        for k, r in enumerate(parts):
            if below + r["n"] >= rank:
                break
            below += r["n"]
        low, high = r["low"], r["high"]
        after = parts[k + 1]["low"] if k + 1 < len(parts) else after
    return low, low if df.where(x <= low).count() > rank else after


def raw_score(text: Column, model: PreferenceModel) -> Column:
    """The score itself, of any size."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(np.array([features(value) for value in batch]).reshape(-1, N_FEATURES)))

    return run(text.cast("binary"))


def score(text: Column, model: PreferenceModel | None) -> Column:
    """0 to 1, higher for better texts. Null counts as empty. Without a model every text scores 1."""
    if model is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [features(value) for value in batch]
            yield pd.Series(model.probabilities(np.array(rows).reshape(-1, N_FEATURES)))

    return run(text.cast("binary"))


def classify(docs: DataFrame, model: PreferenceModel | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, 1 from the threshold on; columns of these names are replaced."""
    old = docs.drop("score", "predicted")
    found = docs.select(*old.columns, score(F.col(text), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
