"""Rows of groups in tiles of bounded size, and the pairs that a tile stands for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textops import ragged_positions

#: Pairs that are looked at together.
PAIRS = 1 << 19


def grouped(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Consecutive rows with the same key, many groups in one table; no group is divided."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def limits_of(keys: np.ndarray) -> np.ndarray:
    """Where groups of equal consecutive keys begin, and the end."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(1, dtype=np.int64)


def open_pairs(tiles: np.ndarray, sides: np.ndarray, marked: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs of rows sorted by tile and side, at most one of them marked; each pair once in all tiles.

    Side 0 holds rows to be compared with those of side 1; rows of side 2 are compared with each other.
    """
    limits = limits_of(tiles)
    group = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    rows = np.flatnonzero((sides != 1) & ~marked)
    partners = limits[:-1] + np.bincount(group[sides == 0], minlength=len(limits) - 1)
    begin, end = partners[group[rows]], limits[1:][group[rows]]
    sizes = end - begin
    ends = np.cumsum(sizes)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        i, j = np.repeat(rows[at:to], sizes[at:to]), ragged_positions(begin[at:to], sizes[at:to])
        keep = (marked[j] & (ids[i] != ids[j])) | (ids[j] > ids[i])
        yield i[keep], j[keep]
        at = to
