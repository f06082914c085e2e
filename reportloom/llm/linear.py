"""Logistic regression on a bounded sample of labelled rows, fitted with numpy."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the intercept last) of a ridge-penalised logistic regression by Newton's method.

    ``x`` is dense with few columns; the intercept is not penalised.  A sample with one class only
    gives zero weights and the (smoothed) log odds of that class.
    """
    n = len(y)
    rate = (y.sum() + 0.5) / (n + 1.0)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(rate / (1 - rate))
    if n == 0 or y.min() == y.max():
        return w
    x1 = np.hstack([x, np.ones((n, 1))])
    ridge = np.full(x1.shape[1], l2)
    ridge[-1] = 1e-9
    for _ in range(rounds):
        p = sigmoid(x1 @ w)
        g = x1.T @ (p - y) + ridge * w
        h = (x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w = w - step * min(1.0, 8.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
