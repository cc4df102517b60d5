"""Vectorised text handling for Arrow batches: byte buffers, spans, their ids and hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

#: Texts are handled in blocks of at most this many bytes; one longer text is a block of its own.
BLOCK_BYTES = (2 << 20) - 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: The key of the words' hashes; a fixed value, so that all tasks and runs agree.
_KEY = "sluice words 16b"


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit words."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return offsets, data


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most ``limit`` bytes together; every row lies in exactly one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of bytes other than space and 0x09-0x0D.

    ``bounds`` holds the rows' limits within ``data``; no run crosses one.
    """
    solid = ~SPACE[data]
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    before[:1], before[1:] = False, solid[:-1]
    after[-1:], after[:-1] = False, solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... for lengths[i] entries, one range after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(distinct byte spans, number of each span's); told apart by their bytes themselves."""
    if not len(starts):
        return [], np.zeros(0, dtype=np.int64)
    part = data[starts[0] : ends[-1]]
    if not np.array_equal(starts[1:], ends[:-1]):
        steps = np.zeros(len(part) + 1, dtype=np.int8)  # spans are disjoint; those that touch cancel out between them
        steps[starts - starts[0]] += 1
        steps[ends - starts[0]] -= 1
        part = part[np.cumsum(steps[:-1], dtype=np.int8).view(bool)]
    packed, offsets = part, np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of a keyed SipHash of each byte span, made once for every distinct one of the block."""
    spans, number = distinct_spans(data, starts, ends)
    if not spans:
        return np.zeros(0, dtype=np.uint64)
    objects = np.empty(len(spans), dtype=object)
    objects[:] = spans
    return hash_array(objects, hash_key=_KEY, categorize=False)[number]


class SpanTokens:
    """Token ids of byte spans, remembered by the spans themselves in a pool of bounded size."""

    def __init__(self, encode_many: Callable[[list[bytes]], list[list[int]]], most_bytes: int = 44 << 20) -> None:
        self.encode_many, self.most_bytes = encode_many, most_bytes
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.held = 0
        self.starts = np.zeros(1024, dtype=np.int64)
        self.lengths = np.zeros(1024, dtype=np.int64)
        self.pool, self.used = np.zeros(1 << 14, dtype=np.uint32), 0

    def _learn(self, spans: list[bytes]) -> None:
        found = self.encode_many(spans)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((x for ids in found for x in ids), dtype=np.uint32, count=int(lengths.sum()))
        first, total = len(self.slots), len(self.slots) + len(found)
        while len(self.starts) < total:
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while len(self.pool) < self.used + len(flat):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.starts[first:total] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:total] = lengths
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.held += sum(map(len, spans)) + 64 * len(spans)
        self.slots.update(zip(spans, range(first, total), strict=True))

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, number of ids of each span)."""
        if len(starts) == 0:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        if self.held > self.most_bytes:
            self._reset()
        spans, number = distinct_spans(data, starts, ends)
        missing = [x for x in spans if x not in self.slots]
        if missing:
            self._learn(missing)
        slot = np.fromiter(map(self.slots.__getitem__, spans), dtype=np.int64, count=len(spans))[number]
        lengths = self.lengths[slot]
        return self.pool[ragged_positions(self.starts[slot], lengths)], lengths
