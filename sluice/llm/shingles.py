"""Sets of word shingles as sorted 64-bit hashes, and MinHash signatures of them.

A shingle's hash chains the keyed hashes of its words. Two given shingles share one with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textops import LOWER, blocks, mix64, span_hashes, text_buffers, word_spans

SHINGLE_WORDS = 5
_rng = np.random.default_rng(5_7_75)
_ODD = lambda n: _rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
_STEP = _ODD(1)[0]
_SHORT = _ODD(SHINGLE_WORDS)


def _chained(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((state ^ (state >> np.uint64(29))) * _STEP) ^ words


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each block of rows, the sorted distinct shingle hashes of each row.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased. A row with one to four words
    has its whole sequence as its only shingle; a row without words has none.
    """
    offsets, data = text_buffers(column)
    w = SHINGLE_WORDS
    for i, j in blocks(offsets):
        part, bounds = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, rows = word_spans(part, bounds)
        words = span_hashes(part, starts, ends)
        limits = np.searchsorted(rows, np.arange(j - i + 1))
        sums = np.full(max(0, len(words) - w + 1), w, dtype=np.uint64)
        for k in range(w):
            sums = _chained(sums, words[k : k + len(sums)])
        sums = mix64(sums)
        found = []
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            if b - a >= w:
                found.append(np.unique(sums[a : b - w + 1]))
            elif b > a:
                short = _SHORT[b - a : b - a + 1]
                for k in range(a, b):
                    short = _chained(short, words[k : k + 1])
                found.append(mix64(short))
            else:
                found.append(words[:0])
        yield found


class Signer:
    """MinHash signatures of ``slots`` symbols of 16 bits."""

    def __init__(self, slots: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.slots = slots
        self.flip = rng.integers(0, 1 << 63, slots, dtype=np.uint64)
        self.scale = rng.integers(0, 1 << 62, slots, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row for each set; a set must not be empty."""
        if not sets:
            return np.zeros((0, self.slots), dtype=np.uint16)
        flat = np.concatenate(sets)
        sizes = np.array([len(x) for x in sets])
        first = np.cumsum(sizes) - sizes
        out = np.empty((len(sets), self.slots), dtype=np.uint16)
        # flipping with a multiple makes the slots differ in more than scale; blocks keep the work in cache
        for k in range(self.slots):
            low = np.minimum.reduceat((flat ^ self.flip[k]) * self.scale[k], first)
            out[:, k] = (mix64(low) >> np.uint64(48)).astype(np.uint16)
        return out
