"""Sparse logistic regression by stochastic gradient descent with per-weight steps; the classifiers on hashed n-grams use it.

A text's features are its n-gram counts over the square root of their total, so that long and short texts compare.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .ngrams import Hasher
from .samples import Example, class_weights


def scaled(n: np.ndarray) -> np.ndarray:
    return (n / np.sqrt(max(n.sum(), 1))).astype(np.float32)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Linear:
    hasher: Hasher
    weight: np.ndarray
    bias: float
    slope: float = 1.0  # probability = sigmoid(slope * z + shift)
    shift: float = 0.0

    def z(self, ids: np.ndarray, n: np.ndarray) -> float:
        return self.bias + float(self.weight[ids] @ scaled(n)) if len(ids) else self.bias

    def scores(self, block: list[memoryview | None]) -> np.ndarray:
        total, n = self.hasher.sums(block, self.weight)
        return sigmoid(self.slope * (self.bias + total / np.sqrt(np.maximum(n, 1))) + self.shift)


def train(found: list[Example], hasher: Hasher, epochs: int = 6, rate: float = 0.1, l2: float = 1e-6, seed: int = 1,
          twins: list[Example | None] | None = None, pull: float = 0.0, by_ratio: bool = False) -> Linear:
    """``twins``: for each example a counterpart (or None) whose score should be the same; ``pull`` weighs that penalty,
    pull * (z - z of the twin) ** 2. ``by_ratio``: features are multiplied by the log ratio of the shares of texts of either
    label that have them, so that few labelled rows suffice. Without rows of both labels: zero weights and the smoothed share of
    label 1."""
    rng = np.random.default_rng(seed)
    size = 1 << hasher.bits
    weight, seen = np.zeros(size, np.float32), np.full(size, 1e-3, np.float32)
    ones = sum(e.label for e in found)
    if not 0 < ones < len(found):
        return Linear(hasher, weight, float(np.log((ones + 1) / (len(found) - ones + 1))))
    bias, bias_seen, balance = 0.0, 1e-3, class_weights(found)
    ratio = _log_ratio(found, size) if by_ratio else np.ones(size, np.float32)

    def step(ids: np.ndarray, gradient: np.ndarray) -> None:
        seen[ids] += gradient * gradient
        weight[ids] -= rate * gradient / np.sqrt(seen[ids])

    for _ in range(epochs):
        for k in rng.permutation(len(found)):
            e = found[k]
            x = scaled(e.n) * ratio[e.ids]
            z = bias + float(weight[e.ids] @ x)
            error = float(sigmoid(z) - e.label) * balance[e.label]
            step(e.ids, error * x + l2 * weight[e.ids])
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
            if twins and (twin := twins[k]) is not None:
                ids = np.union1d(e.ids, twin.ids)
                gap = np.zeros(len(ids), np.float32)
                gap[np.searchsorted(ids, e.ids)] += x
                gap[np.searchsorted(ids, twin.ids)] -= scaled(twin.n) * ratio[twin.ids]
                differ = gap != 0
                ids, gap = ids[differ], gap[differ]
                if len(ids):
                    step(ids, 2 * pull * float(weight[ids] @ gap) * gap)
    return Linear(hasher, weight * ratio, bias)


def _log_ratio(found: list[Example], size: int) -> np.ndarray:
    texts = np.ones((2, size))
    for e in found:
        texts[e.label, e.ids] += 1
    shares = texts / (np.array([[sum(e.label == k for e in found)] for k in (0, 1)]) + 2)
    return np.log(shares[1] / shares[0]).astype(np.float32)


def calibrate(model: Linear, held: list[Example], rounds: int = 200) -> Linear:
    """Slope and shift by Platt's method on rows that the weights were not fitted on; targets are smoothed by class counts."""
    ones = sum(e.label for e in held)
    if not 0 < ones < len(held):
        return model
    z = np.array([model.z(e.ids, e.n) for e in held])
    y = np.array([e.label for e in held])
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(held) - ones + 2))
    balance = class_weights(held)
    w = np.where(y == 1, balance[1], balance[0])
    a, b = 1.0, 0.0
    for _ in range(rounds):  # Newton's method with a small ridge
        p = sigmoid(a * z + b)
        g = np.array([(w * (p - target) * z).sum(), (w * (p - target)).sum()])
        s = w * np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
        move = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return Linear(model.hasher, model.weight, model.bias, max(a, 1e-3), b) if a > 0 else model
