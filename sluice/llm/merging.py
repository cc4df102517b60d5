"""Union of the rows of one block, for operators that return spanning edges instead of pairs."""

from __future__ import annotations

import numpy as np


class Merged:
    """Which of n rows belong together; each set's root is its smallest row."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def _root(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Joins i[k] with j[k]; pairs are first reduced to the distinct pairs of their present roots."""
        n = len(self.up)
        for pair in np.unique(self.up[i] * n + self.up[j]).tolist():
            a, b = self._root(pair // n), self._root(pair % n)
            if a != b:
                self.up[max(a, b)] = min(a, b)
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, root) of the rows that aren't their own root."""
        rows = np.flatnonzero(self.up != np.arange(len(self.up)))
        return rows, self.up[rows]
