"""Document quality from raw bytes: a small convolutional network in numpy.

Bytes are embedded in 4 numbers. 16 learned filters of 8 bytes run with stride 2 over chunks of 512 bytes
that overlap by 64 and cover the whole text; each filter is max-pooled over its chunk, a hidden layer makes
one logit of the pooled values and the chunk's length (a short chunk has few chances to excite a filter),
and the mean logit of a document's chunks, corrected for the classes' true shares, gives its probability.

Learning uses a bounded sample of labelled documents: of each class the DOCS_PER_CLASS with the smallest
hashes of their ids. The steps learn from DRAWS chunks of each class, drawn by hash with replacement: every document of the
sample has the same share of them, every chunk of a whole text the same chance. In a third of the draws of a step, of
either class, the chunk is cut to a random length, as texts may be short. Scoring reads every byte.

Defined results: a null or empty text is one chunk of zero bytes and gets that chunk's score; texts of any length are
scored whole; documents with contradictory labels aren't learned from; of rows that share a doc_id one is learned from; null
labels are ignored; with only one class among the labels its share decides every score (0.5 without any); repeated rows
get the same score; an empty table gives no rows; columns other than text are never inputs and pass through ``score``,
which refuses a table that has a column of the score's name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .folds import in_fold
from .session import ship
from .textops import blocks, text_buffers

CHUNK, OVERLAP = 512, 64
DIMENSIONS, TAPS, STRIDE, FILTERS, HIDDEN = 4, 8, 2, 16, 8
DOCS_PER_CLASS, DRAWS = 1200, 16_000
STEPS, BATCH, RATE = 1000, 64, 0.01
#: Bytes that are scored together; they take some 110 bytes each while they are.
BLOCK = 1 << 18


def chunk_starts(n: int) -> np.ndarray:
    """Where the chunks of n bytes begin; the last one may be shorter."""
    return np.arange(0, max(1, n - OVERLAP), CHUNK - OVERLAP)


class ByteCnn:
    """Weights and both directions of the network."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32)
        self.filters = rng.normal(0, 1 / math.sqrt(TAPS * DIMENSIONS), (TAPS * DIMENSIONS, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.hidden = rng.normal(0, 1 / math.sqrt(FILTERS), (FILTERS + 1, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, dtype=np.float32)
        self.out = rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, dtype=np.float32)
        self.offset = 0.0

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every second byte of a buffer of at least TAPS bytes."""
        x = self.embedding[data]
        n = (len(data) - TAPS) // STRIDE + 1
        item = x.itemsize
        windows = np.lib.stride_tricks.as_strided(x, (n, TAPS * DIMENSIONS), (STRIDE * DIMENSIONS * item, item), writeable=False)
        return np.maximum(windows @ self.filters + self.bias, 0)

    def head(self, pooled: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, hidden values, logits) of chunks of ``sizes`` bytes."""
        inputs = np.concatenate([pooled, np.log2(np.maximum(sizes, 1)).astype(np.float32)[:, None] / 9], axis=1)
        inner = np.tanh(inputs @ self.hidden + self.hidden_bias)
        return inputs, inner, inner @ self.out + self.out_bias[0]

    def step(self, data: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss over chunks (rows of CHUNK bytes, padded with zeros)."""
        x = self.embedding[data].reshape(len(data), -1)
        n = (CHUNK - TAPS) // STRIDE + 1
        item = x.itemsize
        windows = np.lib.stride_tricks.as_strided(x, (len(data), n, TAPS * DIMENSIONS), (x.strides[0], STRIDE * DIMENSIONS * item, item), writeable=False)
        raw = windows @ self.filters + self.bias
        raw[np.arange(n)[None, :] >= np.maximum(1, (sizes[:, None] - TAPS) // STRIDE + 1)] = -1e9
        at = raw.argmax(axis=1)
        best = np.take_along_axis(raw, at[:, None, :], 1)[:, 0, :]
        pooled = np.maximum(best, 0)
        inputs, inner, logits = self.head(pooled, sizes)
        d_logit = (1 / (1 + np.exp(-logits)) - labels).astype(np.float32) / len(labels)
        d_inner = d_logit[:, None] * self.out * (1 - inner**2)
        d_best = (d_inner @ self.hidden[:FILTERS].T) * (best > 0)
        picked = windows[np.arange(len(data))[:, None], at]  # chunk, filter, taps * dimensions
        d_filters = np.einsum("bf,bfk->kf", d_best, picked)
        d_windows = d_best[:, :, None] * self.filters.T[None]
        d_embedding = np.zeros_like(self.embedding)
        places = at[:, :, None] * STRIDE + np.arange(TAPS)
        np.add.at(d_embedding, data[np.arange(len(data))[:, None, None], places], d_windows.reshape(*at.shape, TAPS, DIMENSIONS))
        return [d_embedding, d_filters, d_best.sum(0), inputs.T @ d_inner, d_inner.sum(0), inner.T @ d_logit, d_logit.sum(keepdims=True)]

    def fit(self, data: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 11) -> None:
        """Adam over chunks drawn by weight; a third of them is cut to a random length."""
        rng = np.random.default_rng(seed)
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        for t in range(1, STEPS + 1):
            rows = rng.choice(len(data), BATCH, p=weights)
            rate = RATE * (1 - 0.9 * t / STEPS)
            short = rng.random(BATCH) < 1 / 3
            left = np.where(short, np.minimum(sizes[rows], (16 * 2 ** (5 * rng.random(BATCH))).astype(np.int64)), sizes[rows])
            seen = data[rows] * (np.arange(CHUNK)[None, :] < left[:, None])
            for p, g, m, v in zip(self.parameters(), self.step(seen, left, labels[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    def chunk_logits(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all chunks of some texts' bytes, one text after the other, and how many chunks each text has."""
        sizes = np.array([len(t) for t in texts])
        gaps = np.maximum(TAPS, sizes + sizes % STRIDE)  # every text begins at a place that the stride meets
        bounds = np.concatenate([[0], np.cumsum(gaps)])
        part = np.zeros(int(bounds[-1]) + TAPS, dtype=np.uint8)
        for at, text in zip(bounds.tolist(), texts, strict=False):
            part[at : at + len(text)] = text
        response = np.concatenate([self.responses(part), np.zeros((1, FILTERS), dtype=np.float32)])
        starts = [chunk_starts(n) for n in sizes.tolist()]
        counts = np.array([len(s) for s in starts])
        local = np.concatenate(starts)
        base = np.repeat(bounds[:-1], counts)
        length = np.minimum(CHUNK, np.repeat(sizes, counts) - local)
        lo = (base + local) // STRIDE
        hi = lo + np.maximum(1, (length - TAPS) // STRIDE + 1)
        pooled = np.maximum.reduceat(response, np.stack([lo, hi], axis=1).ravel())[::2]
        return self.head(pooled, length)[2], counts

    def mean_logit(self, text: np.ndarray) -> float:
        """Of a text's chunks, some BLOCK bytes at a time; a part holds whole chunks, so they are those of the text."""
        starts, step = chunk_starts(len(text)), BLOCK // CHUNK
        parts = (text[starts[k] : starts[min(k + step, len(starts)) - 1] + CHUNK] for k in range(0, len(starts), step))
        return sum(float(self.chunk_logits([part])[0].sum(dtype=np.float64)) for part in parts) / len(starts)

    def scores(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Probabilities of a column's texts, block by block; memory is bounded by a block, whatever a text's length."""
        offsets, data = text_buffers(column)
        for i, j in blocks(offsets, BLOCK):
            texts = [data[offsets[k] : offsets[k + 1]] for k in range(i, j)]
            if len(texts) == 1 and len(texts[0]) > BLOCK:
                mean = np.array([self.mean_logit(texts[0])])
            else:
                logits, counts = self.chunk_logits(texts)
                mean = np.add.reduceat(logits, np.cumsum(counts) - counts) / counts
            yield 1 / (1 + np.exp(-(mean.astype(np.float64) + self.offset)))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5) -> ByteCnn:
    """The network learned from labels (doc_id, quality) outside fold 0."""
    ship(docs.sparkSession)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .filter("doc_id is not null and y in (0, 1)")
        .filter(in_fold(F.col("doc_id"), folds) != 0)
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("z"))
        .filter("y = z")
        .select("doc_id", "y")
    )
    shares = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model = ByteCnn()
    if len(shares) < 2:
        model.out[:] = 0
        model.offset = 0.0 if not shares else (10.0 if 1 in shares else -10.0)
        return model
    ids = [known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(DOCS_PER_CLASS) for y in (0, 1)]
    sample = ids[0].unionByName(ids[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "y")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode()
                starts = chunk_starts(len(raw))
                draws = -(-DRAWS // min(DOCS_PER_CLASS, shares[y]))
                places, times = np.unique(np.random.default_rng([doc_id & (1 << 63) - 1, 29]).integers(0, len(starts), draws), return_counts=True)
                rows += [(doc_id, k, raw[starts[k] : starts[k] + CHUNK], n / draws, y) for k, n in zip(places.tolist(), times.tolist(), strict=True)]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["doc_id", "k", "piece", "share", "y"])

    rows = sorted(texts.mapInArrow(pieces, "doc_id long, k long, piece binary, share double, y int").collect(), key=lambda r: (r.doc_id, r.k))
    if not rows:
        model.out[:] = 0
        return model
    data = np.zeros((len(rows), CHUNK), dtype=np.uint8)
    for k, r in enumerate(rows):
        data[k, : len(r.piece)] = np.frombuffer(r.piece, dtype=np.uint8)
    y = np.array([r.y for r in rows], dtype=np.float32)
    weights = np.array([r.share for r in rows])
    for side in (y == 0, y == 1):
        if side.any():
            weights[side] /= weights[side].sum()
    weights /= weights.sum()
    model.fit(data, np.array([len(r.piece) for r in rows]), y, weights)
    model.offset = math.log(shares[1] / shares[0])
    return model


def score(docs: DataFrame, model: ByteCnn, name: str = "score") -> DataFrame:
    """``docs`` with the score in one more column."""
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {name} already")
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [*model.scores(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found) if found else [], pa.float64())], names=[*batch.schema.names, name])

    out = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, out)
