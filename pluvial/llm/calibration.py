"""Scores in [0, 1] from margins: a two-parameter logistic fit in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


def fit_logistic(margin: np.ndarray, label: np.ndarray, rate: float = 0.5,
                 steps: int = 60) -> tuple[float, float]:
    """(slope, offset) of P(1 | margin), class 1 weighted to a share of ``rate``.

    Newton steps on smoothed targets (as in Platt's scaling), so separable
    classes give a finite slope.  With fewer than two classes: (1, 0).
    """
    margin, label = np.asarray(margin, float), np.asarray(label, int)
    n1, n0 = int((label == 1).sum()), int((label != 1).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    rate = min(max(rate, 0.01), 0.99)
    weight = np.where(label == 1, rate / n1, (1 - rate) / n0) * (n1 + n0)
    scale = max(float(np.std(margin)), 1e-9)
    x = np.stack([margin / scale, np.ones_like(margin)], axis=1)
    theta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ theta)
        grad = x.T @ (weight * (p - target)) + 1e-3 * theta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= step * min(1.0, 4.0 / max(float(np.abs(step).max()), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(theta[0] / scale), 1e-9), float(theta[1])
