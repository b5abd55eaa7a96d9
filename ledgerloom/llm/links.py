"""Counting links and connecting rows inside one task."""

from __future__ import annotations

import numpy as np


class Links:
    """Counts of links and connected rows among rows 0, 1, 2 and so on."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.root = np.arange(len(weights))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        n = len(self.root)
        self.counts += np.bincount(a, self.weights[b], n).astype(np.int64)
        self.counts += np.bincount(b, self.weights[a], n).astype(np.int64)
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(self.root, after := self.root[self.root]):
                self.root = after
