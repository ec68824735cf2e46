"""Logistic regression on a bounded sample, and sparse rows for it."""

from __future__ import annotations

import numpy as np


class SparseRows:
    """Rows of (column, value) pairs, stored one after the other."""

    def __init__(self, columns: list[np.ndarray], values: list[np.ndarray]):
        self.row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        self.column = np.concatenate(columns) if columns else np.empty(0, dtype=np.int64)
        self.value = np.concatenate(values) if values else np.empty(0)
        self.size = len(columns)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], minlength=self.size)

    def back(self, errors: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, self.value * errors[self.row], minlength=width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(
    rows: SparseRows, labels: np.ndarray, width: int, l2: float = 1e-4, steps: int = 300, rate: float = 0.1,
) -> np.ndarray:
    """Weights (the last one for the constant) for labels from 0 to 1, by Adam with the full gradient."""
    weights, first, second = (np.zeros(width + 1) for _ in range(3))
    n = max(rows.size, 1)
    for step in range(1, steps + 1):
        error = sigmoid(rows.times(weights[:-1]) + weights[-1]) - labels
        slope = np.append(rows.back(error, width) / n + l2 * weights[:-1], error.sum() / n)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights
