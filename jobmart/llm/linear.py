"""Logistic regression on sparse hashed features, and its calibration; for bounded samples on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_sparse(
    rows: np.ndarray, features: np.ndarray, values: np.ndarray, labels: np.ndarray, size: int,
    steps: int = 120, rate: float = 0.5, penalty: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and intercept, by adaptive gradient steps over the whole sample; classes weigh alike."""
    n = len(labels)
    share = np.array([max(1, (labels == c).sum()) for c in (0, 1)])
    importance = 0.5 / share[labels.astype(int)]
    weights, square, bias, bias_square = np.zeros(size), np.full(size, 1e-12), 0.0, 1e-12
    for _ in range(steps):
        scores = np.bincount(rows, weights[features] * values, n) + bias
        off = (sigmoid(scores) - labels) * importance
        slope = np.bincount(features, off[rows] * values, size) + penalty * weights
        square += slope * slope
        weights -= rate * slope / np.sqrt(square)
        bias_square += off.sum() ** 2
        bias -= rate * off.sum() / np.sqrt(bias_square)
    return weights, bias


def calibrate(scores: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and intercept that turn scores into probabilities, by Newton steps on smoothed labels."""
    pos, neg = labels.sum(), len(labels) - labels.sum()
    wanted = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.column_stack([scores, np.ones(len(scores))])
    found = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ found)
        slope = x.T @ (p - wanted) + 1e-6 * found
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        found -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(found[0], 1e-6)), float(found[1])
