"""A linear support vector machine (squared hinge loss, L2 penalty) by dual coordinate descent, in numpy."""

from __future__ import annotations

import numpy as np


def fit(x: np.ndarray, rows: np.ndarray, positive: np.ndarray, cost: float = 10.0, epochs: int = 30, seed: int = 0) -> np.ndarray:
    """Weights from the given rows of ``x``, whose last column is the constant 1; ``positive`` has their classes.
    Both classes weigh the same, whatever their counts. No copy of ``x`` is made."""
    n = len(rows)
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, n / (2 * max(1, positive.sum())), n / (2 * max(1, (~positive).sum())))
    diagonal = 1 / (2 * cost * share)
    q = np.array([x[i] @ x[i] for i in rows], dtype=np.float64) + diagonal
    w, alpha = np.zeros(x.shape[1], dtype=x.dtype), np.zeros(n)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n):
            row = x[rows[i]]
            gradient = y[i] * (row @ w) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / q[i])
            if new != alpha[i]:
                w += x.dtype.type((new - alpha[i]) * y[i]) * row
                moved = max(moved, abs(new - alpha[i]) * q[i])
                alpha[i] = new
        if moved < 1e-2:
            break
    return w
