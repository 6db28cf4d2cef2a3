"""Logistic regression on sparse rows with a held-out fold for calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by Newton's method on smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * z + b)
        d, w = p - goal, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, [(d * z).sum() + 1e-3 * (a - 1), d.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class Logistic:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, places: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[places] @ values) + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * np.asarray(margin, np.float64) + self.shift)


def _descend(places, values, row, n, y, dim, ridge, epochs) -> Logistic:
    """Full-batch gradient steps scaled by each weight's past gradients."""
    w, b = np.zeros(dim), 0.0
    gw, gb = np.full(dim, 1e-8), 1e-8
    for _ in range(epochs):
        z = np.bincount(row, values * w[places], n) + b
        d = (sigmoid(z) - y) / n
        g, g0 = np.bincount(places, values * d[row], dim) + ridge * w / n, d.sum()
        gw += g * g
        gb += g0 * g0
        w -= 0.5 * g / np.sqrt(gw)
        b -= 0.5 * g0 / np.sqrt(gb)
    return Logistic(w, b)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int, ridge: float = 0.1, epochs: int = 60) -> Logistic:
    """Weights from all rows; calibration from the margins that two halves give each other.

    With one class only, every probability is that class's smoothed share.
    """
    y = np.asarray(y, np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Logistic(np.zeros(dim), float(np.log(share / (1 - share))))

    def stack(chosen):
        return (
            np.concatenate([rows[i][0] for i in chosen]),
            np.concatenate([rows[i][1] for i in chosen]),
            np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen]),
            len(chosen),
        )

    # Every second row of each class.
    half = np.zeros(len(y), int)
    for label in (0, 1):
        at = np.flatnonzero(y == label)
        half[at] = np.arange(len(at)) % 2
    z = np.zeros(len(y))
    for k in (0, 1):
        part = _descend(*stack(np.flatnonzero(half != k)), y[half != k], dim, ridge, epochs)
        for i in np.flatnonzero(half == k):
            z[i] = part.margin(*rows[i])
    model = _descend(*stack(np.arange(len(y))), y, dim, ridge, epochs)
    model.slope, model.shift = platt(z, y)
    model.weights = model.weights.astype(np.float32)
    return model
