"""Sparse multinomial logistic regression by FTRL-proximal (McMahan et al., 2013).

Per coordinate, the follow-the-regularised-leader step keeps a sum of adjusted
gradients ``z`` and of squared gradients ``n``; a weight is zero while ``|z|`` is at
most the L1 penalty, and shrunk by the L2 penalty else (elastic net). Works on a
bounded training sample, in mini-batches of sparse rows.
"""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: ``ptr`` (n + 1), ``idx`` and ``val``; a bias feature is added as the last."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_features: int):
        self.n_features = n_features
        lens = np.array([len(i) + 1 for i, _ in rows], np.int64)
        self.ptr = np.concatenate([[0], np.cumsum(lens)])
        # Filled in place: the bias is what stays at the end of each row.
        self.idx = np.full(self.ptr[-1], n_features, np.int32)
        self.val = np.ones(self.ptr[-1])
        for at, (i, v) in zip(self.ptr.tolist(), rows):
            self.idx[at:at + len(i)] = i
            self.val[at:at + len(i)] = v

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(idx, val, row number) of the chosen rows."""
        lens = np.diff(self.ptr)[which]
        row = np.repeat(np.arange(len(which)), lens)
        at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(self.ptr[which], lens)
        return self.idx[at], self.val[at], row


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def logits(weights: np.ndarray, rows: Rows, which: np.ndarray) -> np.ndarray:
    idx, val, row = rows.take(which)
    out = np.zeros((len(which), weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(row, val * weights[idx, k], minlength=len(which))
    return out


def ftrl(rows: Rows, y: np.ndarray, n_classes: int, which: np.ndarray, l1: float, l2: float, alpha: float = 0.1, beta: float = 1.0, epochs: int = 5, batch: int = 16, seed: int = 0) -> np.ndarray:
    """Weights (n_features + 1, n_classes) fitted on the rows ``which``; the bias has no L1 penalty."""
    z = np.zeros((rows.n_features + 1, n_classes))
    n = np.zeros_like(z)
    penalty = np.full((rows.n_features + 1, 1), l1)
    penalty[-1] = 0.0

    def solve(z, n, pen):
        return np.where(np.abs(z) <= pen, 0.0, -(z - np.sign(z) * pen) / ((beta + np.sqrt(n)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(which)
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            idx, val, row = rows.take(some)
            u, inv = np.unique(idx, return_inverse=True)
            w = solve(z[u], n[u], penalty[u])
            x = np.zeros((len(some), n_classes))
            for k in range(n_classes):
                x[:, k] = np.bincount(row, val * w[inv, k], minlength=len(some))
            err = softmax(x)
            err[np.arange(len(some)), y[some]] -= 1.0
            g = np.stack([np.bincount(inv, val * err[row, k], minlength=len(u)) for k in range(n_classes)], 1)
            g /= np.sqrt(len(some))
            sigma = (np.sqrt(n[u] + g * g) - np.sqrt(n[u])) / alpha
            z[u] += g - sigma * w
            n[u] += g * g
    return solve(z, n, penalty)
