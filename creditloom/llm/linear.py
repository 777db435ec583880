"""Small trained linear models for bounded samples, in numpy."""

from __future__ import annotations

import numpy as np


def linear_svm(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cost: float = 10.0, epochs: int = 60, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and offset of an L2-loss linear SVM by dual coordinate descent over the ``rows`` of ``x``; ``y`` is +1 or -1.

    Classes are weighted to equal sums, so a rare one isn't given up. ``x`` is never copied.
    """
    sign = y[rows]
    positive = max(1, int((sign > 0).sum()))
    weight = np.where(sign > 0, len(rows) / (2 * positive), len(rows) / (2 * max(1, len(rows) - positive)))
    diagonal = 0.5 / (cost * weight)
    norms = np.array([float(x[r] @ x[r]) for r in rows]) + 1.0 + diagonal
    w, offset, alpha, rng = np.zeros(x.shape[1]), 0.0, np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            row = x[rows[i]]
            gradient = sign[i] * (row @ w + offset) - 1 + diagonal[i] * alpha[i]
            step = max(alpha[i] - gradient / norms[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * sign[i] * row
                offset += step * sign[i]
                moved = max(moved, abs(step) * norms[i])
        if moved < 1e-3:
            break
    return w, offset


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def platt(margin: np.ndarray, positive: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the sigmoid that turns margins into probabilities (Platt's smoothed targets, Newton steps)."""
    n1 = float(positive.sum())
    n0 = float(len(positive) - n1)
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([d @ margin, d.sum()])
        hess = np.array([[h @ margin ** 2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        move = np.linalg.solve(hess, g)
        a, b = a - float(np.clip(move[0], -2, 2)), b - float(np.clip(move[1], -2, 2))
        if np.abs(move).max() < 1e-8:
            break
    return max(a, 1e-3), b
