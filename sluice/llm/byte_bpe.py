"""Byte-level BPE by monoid tree reduction.

Encoding. A text is halved again and again until its parts have at most LEAF bytes; every part is encoded
as a text of its own. Neighbours are then joined up the tree: the tokens next to the cut are given up, one
after another on both sides, until the window between the rest begins and ends at sure boundaries (or at the
ends of the two parts), and the window is encoded anew. The tokens outside stay: they are those of the
whole. Joining is associative, with the empty text as its neutral element, so any tree gives the same ids.

Why a boundary is sure: every match of PATTERN is white space alone, or at most one space followed
by characters that are not white space. So at a white-space character that follows a character surely
not white space, a match ends and a new one begins, whatever lies to the left; what follows is split as
if the text began there. Ids on both sides of a sure boundary therefore can't influence each other. Under
another pattern no boundary is sure, and windows grow to the whole of both parts.

Decoding halves the ids likewise and concatenates the bytes up the tree.

Defined results: null and empty texts have no ids; every row stands by itself, so repeated rows repeat their
result; a text of any length is encoded whole; an empty table gives no rows; a null doc_id stays null; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .session import ship
from .textops import SPACE, SpanTokens, blocks, text_buffers

#: Bytes of a leaf when encoding, ids of one when decoding; any other numbers give the same results.
LEAF, LEAF_IDS = 512, 256
#: The pattern whose boundaries are known; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_MOST_WINDOWS = 200_000


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.pieces: list[bytes] = [b""] * size
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.sizes = [len(x) for x in self.pieces]
        self.decimals = [str(i) for i in range(size)]
        self.knows_boundaries = pattern == PATTERN
        self.tokens = SpanTokens(lambda spans: [self._plain.encode_ordinary(x.decode()) for x in spans])
        self._windows: dict[bytes, list[int]] = {b"": []}

    def window(self, raw: bytes) -> list[int]:
        """Ids of a window both of whose ends are sure."""
        ids = self._windows.get(raw)
        if ids is None:
            ids = self._plain.encode_ordinary(raw.decode())
            if len(raw) <= 64:
                if len(self._windows) >= _MOST_WINDOWS:
                    self._windows = {b"": []}
                self._windows[raw] = ids
        return ids

    def join(self, raw: bytes, sure: bytes, a: int, left: list[int], at: int, right: list[int], b: int) -> list[int]:
        """Ids of raw[a:b] from those of raw[a:at] and raw[at:b]; ``sure`` is not 0 where a boundary is."""
        begin, end, i, j = at, at, len(left), 0
        while begin > a and not sure[begin]:
            i -= 1
            begin -= self.sizes[left[i]]
        while end < b and not sure[end]:
            end += self.sizes[right[j]]
            j += 1
        return [*left[:i], *self.window(raw[begin:end]), *right[j:]]

    def decode(self, ids: list[int], leaf: int = LEAF_IDS) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.pieces.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half], leaf) + self.decode(ids[half:], leaf)


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def sure_boundaries(data: np.ndarray) -> np.ndarray:
    """Where a space or 0x09-0x0D follows a character that surely isn't white space.

    Sure are ASCII characters but those, two-byte characters from U+00C0 on, and three-byte characters from
    U+4000 to U+DFFF; others may be white space, so no boundary is claimed after them.
    """
    if len(data) < 2:
        return np.zeros(0, dtype=np.int64)
    space = SPACE[data]
    solid = (data < 0x80) & ~space
    solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF) & (data[1:] >= 0x80)
    solid[2:] |= (data[:-2] >= 0xE4) & (data[:-2] <= 0xED) & (data[1:-1] >= 0x80) & (data[2:] >= 0x80)
    return np.flatnonzero(space[1:] & solid[:-1]) + 1


def middle(raw: bytes, a: int, b: int, leaf: int) -> int:
    """Where raw[a:b] is halved, at the start of a character; ``a`` if it is a leaf."""
    if b - a <= leaf:
        return a
    at = (a + b) // 2
    while at > a and raw[at] & 0xC0 == 0x80:
        at -= 1
    return at


def cuts(raw: bytes, a: int, b: int, leaf: int) -> list[int]:
    """All inner limits of the leaves of raw[a:b]."""
    at = middle(raw, a, b, leaf)
    return [] if at == a else [*cuts(raw, a, at, leaf), at, *cuts(raw, at, b, leaf)]


def encode_batch(column: pa.Array, c: Codec, leaf: int = LEAF) -> Iterator[list[int]]:
    """Ids of each text of a column."""
    offsets, data = text_buffers(column)
    for i, j in blocks(offsets):
        part, bounds = data[offsets[i] : offsets[j]], (offsets[i : j + 1] - offsets[i]).tolist()
        raw = part.tobytes()
        limits = np.array([*bounds, *(x for a, b in zip(bounds[:-1], bounds[1:], strict=True) for x in cuts(raw, a, b, leaf))], dtype=np.int64)
        boundaries = sure_boundaries(part) if c.knows_boundaries else limits[:0]
        marks = np.zeros(len(part) + 1, dtype=np.uint8)
        marks[boundaries] = 1
        sure = marks.tobytes()
        # The leaves' own ids: within a leaf its sure boundaries part spans that are encoded by themselves.
        edged = marks.copy()
        edged[limits] = 1
        edges = np.flatnonzero(edged)
        starts, ends = edges[:-1], edges[1:]
        ids, lengths = c.tokens.ids(part, starts, ends)
        place = np.zeros(len(part) + 1, dtype=np.int64)
        place[edges] = np.concatenate([[0], np.cumsum(lengths)])

        def node(a: int, b: int) -> list[int]:
            at = middle(raw, a, b, leaf)
            if at == a:
                return ids[place[a] : place[b]].tolist()
            return c.join(raw, sure, a, node(a, at), at, node(at, b), b)

        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield node(a, b)


def _many(table: list, ids: list[int]) -> tuple:
    return itemgetter(*ids)(table) if len(ids) > 1 else tuple(table[i] for i in ids)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True, leaf: int = LEAF) -> DataFrame:
    """Ids of every whole text and the bytes they decode to.

    Columns: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the
    decoded bytes), and ids and decoded if asked for.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            counts, encoded, decoded, kept, texts = [], [], [], [], []
            for listed in encode_batch(batch.column(1), c, leaf):
                raw = c.decode(listed)
                counts.append(len(listed))
                encoded.append(hashlib.sha256(",".join(_many(c.decimals, listed)).encode()).hexdigest())
                decoded.append(hashlib.sha256(raw).hexdigest())
                if with_ids:
                    kept.append(listed)
                    texts.append(raw)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(kept, pa.list_(pa.int32())), pa.array(texts, pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
