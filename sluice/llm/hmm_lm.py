"""A hidden Markov language model over words, beside an additive unigram score.

Tokens are words (A-Z lower-cased) and one end mark for each text. Counts come from all training texts.
The model's STATES hidden states emit classes of words: each of the WORD_CLASSES most frequent tokens is a
class of its own, the others fall in SUFFIX_CLASSES by a hash of their last three bytes; a word's share of
its class is its smoothed count. For learning a text is cut into sequences of at most SEGMENT tokens, the first of which
begins the text and the others where the chain is in the long run. Baum-Welch starts on the driver from a sample of SAMPLE sequences, drawn by hash from all places of all training texts;
then every full iteration gathers expected counts over all training texts, summed across partitions, until
their likelihood gains less than SETTLED a token. Scoring runs the scaled forward recursion through each whole
text, which gives the exact log-likelihood under the model.

Counts of the HEAD most frequent tokens travel to every task (a fixed bound); rarer words of a text are
joined with the table of counts, so the vocabulary may grow without bound.

Tokens are told apart by keyed 64-bit hashes. Defined results: a null or empty text is the end mark alone; texts of any
length are scored whole; repeated rows are scored alike and each counts for training; a null doc_id is held out; an empty table
gives no rows; without training texts all counts are zero and the states' classes are equally likely; columns other than doc_id
and text, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .folds import in_fold
from .session import settle, ship, work_dir
from .textops import LOWER, blocks, span_hashes, text_buffers, word_spans

STATES = 8
WORD_CLASSES, SUFFIX_CLASSES, HEAD = 4096, 2048, 1 << 17
CLASSES = WORD_CLASSES + SUFFIX_CLASSES
SEGMENT, SAMPLE, SAMPLE_ROUNDS, ROUNDS = 256, 3200, 20, 2
#: Full iterations, ROUNDS at least, end when the natural log-likelihood of a training token gains less.
SETTLED = 1e-3
#: Cells of a grid of sequences that are handled at once.
CELLS = 600_000
ADD = 0.1
END = -1  # stands for the end mark's hash


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of rows: token hashes, suffix classes, and the limits of the rows; each row ends with the end mark."""
    offsets, data = text_buffers(column)
    for i, j in blocks(offsets):
        part, bounds = LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, rows = word_spans(part, bounds)
        hashes = span_hashes(part, starts, ends).astype(np.int64)
        hashes[hashes == END] = 0
        tail = np.zeros(len(starts), dtype=np.int64)
        for k in (1, 2, 3):
            tail = tail * 257 + np.where(ends - k >= starts, part[np.maximum(ends - k, 0)], 0)
        suffix = WORD_CLASSES + (tail * 2654435761 >> 7) % SUFFIX_CLASSES
        last = np.cumsum(np.bincount(rows, minlength=j - i))
        yield np.insert(hashes, last, END), np.insert(suffix, last, WORD_CLASSES), np.concatenate([[0], last + np.arange(1, j - i + 1)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, class, c): each batch's tokens."""
    for batch in batches:
        for hashes, suffix, _ in tokens(batch.column(0)):
            distinct, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(suffix[first].astype(np.int32)), pa.array(counts)], names=["h", "class", "c"])


class Vocabulary:
    """Totals, the head's counts, and the classes' totals beyond the words that are classes themselves."""

    def __init__(self, head: list[tuple[int, int, int]], total: int, distinct: int, classes: dict[int, tuple[int, int]]) -> None:
        self.total, self.distinct = total, distinct
        order = sorted(range(len(head)), key=lambda k: head[k][0])
        self.hashes = np.array([head[k][0] for k in order], dtype=np.int64)
        self.counts = np.array([head[k][2] for k in order], dtype=np.int64)
        self.classes = np.array([k if k < WORD_CLASSES else head[k][1] for k in order], dtype=np.int64)
        self.class_counts, self.class_sizes = np.zeros(CLASSES), np.zeros(CLASSES)
        for k, (c, n) in classes.items():
            self.class_counts[k], self.class_sizes[k] = c, n
        for h, k, c in head[:WORD_CLASSES]:
            self.class_counts[k] -= c
            self.class_sizes[k] -= 1

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADD) / (self.total + ADD * (self.distinct + 1)))

    def share_divisor(self) -> np.ndarray:
        """By class: what a count plus ADD is divided by; only meant for suffix classes."""
        return self.class_counts + ADD * (self.class_sizes + 1)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the head, whether it is there)."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def _encode(vocabulary: Vocabulary):
    """(doc_id, training, classes, n_tokens, n_known, base, within, rare): what every text has under the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        divisor = vocabulary.share_divisor()
        for batch in batches:
            row = 0
            for hashes, suffix, limits in tokens(batch.column(2)):
                n = len(limits) - 1
                distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                at, known = vocabulary.find(distinct)
                counts = np.where(known, vocabulary.counts[at] if len(vocabulary.counts) else 0, 0)
                classes = np.where(known, vocabulary.classes[at] if len(vocabulary.classes) else 0, suffix[first])
                base = np.where(known, vocabulary.base_log(counts), 0.0)
                within = np.where(known & (classes >= WORD_CLASSES), np.log10((counts + ADD) / divisor[classes]), 0.0)
                all_classes = classes[inverse].astype("<u2")
                n_known, base_sum, within_sum = (np.add.reduceat(x[inverse], limits[:-1]) for x in (known.astype(np.int64), base, within))
                # Rare tokens of each row with their counts, as one flat list.
                places = np.flatnonzero(~known[inverse])
                pairs, tf = np.unique((np.searchsorted(limits, places, side="right") - 1) * len(distinct) + inverse[places], return_counts=True)
                ids = pairs % len(distinct)
                edges = np.searchsorted(pairs // len(distinct), np.arange(n + 1)).astype(np.int32)
                struct = pa.StructArray.from_arrays([pa.array(distinct[ids]), pa.array(classes[ids].astype(np.int32)), pa.array(tf.astype(np.int64))], names=["h", "class", "tf"])
                columns = [
                    batch.column(0).slice(row, n),
                    batch.column(1).slice(row, n),
                    pa.array([all_classes[a:b].tobytes() for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)], pa.binary()),
                    pa.array(np.diff(limits)),
                    *(pa.array(x) for x in (n_known, base_sum, within_sum)),
                    pa.ListArray.from_arrays(pa.array(edges), struct),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "training", "classes", "n_tokens", "n_known", "base", "within", "rare"])
                row += n

    return run


_ENCODED = "doc_id long, training boolean, classes binary, n_tokens long, n_known long, base double, within double, rare array<struct<h:long,class:int,tf:long>>"


class Hmm:
    """Start, transition and emission probabilities; emissions are kept by class."""

    def __init__(self, class_counts: np.ndarray, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        share = (class_counts + ADD) / (class_counts + ADD).sum()
        self.start = np.full(STATES, 1 / STATES)
        self.move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(self.move, 0.9)
        emit = share[:, None] * rng.uniform(0.2, 1.8, (len(share), STATES))
        self.emit = emit / emit.sum(0)
        self.share = share
        self._settle()

    def _settle(self) -> None:
        """The states' long-run distribution, from which the later sequences of a text begin."""
        within = np.full(STATES, 1 / STATES)
        for _ in range(64):
            within = within @ self.move
        self.within = within / within.sum()

    def update(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """The maximizing step; every class keeps a little of its corpus share in every state."""
        start, move, emit = start + 1.0, move + 1.0, emit + self.share[:, None] * 5.0
        self.start, self.move, self.emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
        self._settle()

    def log_likelihoods(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural logs, by the scaled forward recursion over all of each text."""
        sizes = np.array([len(x) for x in texts])
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([texts[k] for k in order])
        starts = np.cumsum(sizes[order]) - sizes[order]
        active = np.searchsorted(-sizes[order], -np.arange(int(sizes.max())), side="left")
        total = np.zeros(len(texts))
        alpha = self.start * self.emit[flat[starts]]
        for t, n in enumerate(active.tolist()):
            if t:
                alpha = (alpha[:n] @ self.move) * self.emit[flat[starts[:n] + t]]
            scale = alpha.sum(1)
            total[:n] += np.log(scale)
            alpha /= scale[:, None]
        out = np.empty(len(texts))
        out[order] = total
        return out

    def expected(self, texts: list[np.ndarray], begins: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected start, transition and emission counts; ``begins`` tells which of the arrays begin a text."""
        return self.counted(texts, begins)[:3]

    def counted(self, texts: list[np.ndarray], begins: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The expected counts, and the natural log-likelihood of the sequences with their number of tokens.

        Only the first sequence of a text counts as a start; later ones begin from the long-run distribution.
        """
        begins = begins or [True] * len(texts)
        parts = sorted(((x[k : k + SEGMENT], b and k == 0) for x, b in zip(texts, begins, strict=True) for k in range(0, len(x), SEGMENT)), key=lambda p: len(p[0]), reverse=True)
        start, move, emit, fit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(self.emit.shape), np.zeros(2)
        at = 0
        while at < len(parts):  # sequences of like length together, so that the grid has few empty cells
            step = max(1, CELLS // len(parts[at][0]))
            for total, found in zip((start, move, emit, fit), self._expected(parts[at : at + step]), strict=True):
                total += found
            at += step
        return start, move * self.move, emit, fit

    def _expected(self, sequences: list[tuple[np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of sequences from the longest to the shortest; the transitions lack the factor of their own probability."""
        parts, first = [x for x, _ in sequences], np.array([b for _, b in sequences])
        sizes = np.array([len(x) for x in parts])
        longest, n = int(sizes[0]), len(parts)
        grid = np.zeros((longest, n), dtype=np.int64)
        for k, x in enumerate(parts):
            grid[: len(x), k] = x
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        forward = np.zeros((longest, n, STATES))
        scales = np.ones((longest, n))
        alpha = np.where(first[:, None], self.start, self.within) * self.emit[grid[0]]
        for t, m in enumerate(active.tolist()):
            if t:
                alpha = (forward[t - 1, :m] @ self.move) * self.emit[grid[t, :m]]
            scales[t, :m] = alpha.sum(1)
            forward[t, :m] = alpha / scales[t, :m, None]
        move = np.zeros((STATES, STATES))
        beta = np.ones((n, STATES))
        for t in range(longest - 1, -1, -1):
            m = int(active[t])
            ahead = self.emit[grid[t, :m]] * beta[:m] / scales[t, :m, None]
            forward[t, :m] *= beta[:m]  # now the posterior of the states
            if t:
                move += forward[t - 1, :m].T @ ahead
                beta[:m] = ahead @ self.move.T
        posterior = np.concatenate([forward[t, : int(m)] for t, m in enumerate(active)])
        classes = np.concatenate([grid[t, : int(m)] for t, m in enumerate(active)])
        emit = np.stack([np.bincount(classes, weights=posterior[:, k], minlength=len(self.emit)) for k in range(STATES)], axis=1)
        return forward[0][first].sum(0), move, emit, np.array([np.log(scales).sum(), sizes.sum()])


def _texts(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype="<u2").astype(np.int64) for x in column.to_pylist()]


def _portions(texts: list[np.ndarray], limit: int) -> Iterator[tuple[int, int]]:
    sizes = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    return blocks(sizes, limit)


def _expected_counts(model: Hmm):
    """(row, v): summed expected counts of a task; rows below 0 hold transitions, then starts, then the fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            texts = _texts(batch.column(0))
            for i, j in _portions(texts, 400_000):
                found = model.counted(texts[i:j])
                sums = found if sums is None else tuple(a + b for a, b in zip(sums, found, strict=True))
        if sums is not None:
            start, move, emit, fit = sums
            seen = np.flatnonzero(emit.sum(1))
            rows = np.concatenate([-1 - np.arange(STATES + 2), seen])
            values = np.concatenate([move, start[None], np.pad(fit, (0, STATES - 2))[None], emit[seen]])
            yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(values[:, k]) for k in range(STATES))], names=["row", *(f"s{k}" for k in range(STATES))])

    return run


def _scored(model: Hmm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(1))
            found = [model.log_likelihoods(texts[i:j]) for i, j in _portions(texts, 2_000_000)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found) / math.log(10) if found else [], pa.float64())], names=["uid", "states"])

    return run


class LanguageModel:
    """The vocabulary, the HMM, where the run's tables lie, and the log-likelihood of a training token before each full iteration."""

    def __init__(self, vocabulary: Vocabulary, hmm: Hmm, counts: DataFrame, encoded: DataFrame, fits: list[float]) -> None:
        self.vocabulary, self.hmm, self.counts, self.encoded, self.fits = vocabulary, hmm, counts, encoded, fits


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """At most ``most`` tokens, the most frequent ones, cut where a step of 1/64 of a doubling begins."""
    step = F.floor(F.log2("c") * 64).cast("int")
    room, least = most, None
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r.step
    return counts.filter(step >= least) if least is not None else counts.limit(0)


def _sequences(training: DataFrame) -> tuple[list[np.ndarray], list[bool]]:
    """At most SAMPLE sequences of the training texts, by the hash of their text's id and place, and which of them begin a text."""
    place = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / SEGMENT).cast("int"))).alias("k")
    drawn = training.select("uid", "doc_id", place).withColumn("draw", F.xxhash64("doc_id", "k")).orderBy("draw", "uid", "k").limit(SAMPLE)
    part = F.col("classes").substr(F.col("k") * (2 * SEGMENT) + 1, F.lit(2 * SEGMENT)).alias("classes")
    rows = training.select("uid", "classes").join(F.broadcast(drawn.select("uid", "k", "draw")), "uid").select("draw", "uid", "k", part).collect()
    rows.sort(key=lambda r: (r.draw, r.uid, r.k))
    return [np.frombuffer(bytes(r.classes), dtype="<u2").astype(np.int64) for r in rows], [r.k == 0 for r in rows]


def _gathered(training: DataFrame, hmm: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``counted`` gives for all training texts."""
    gathered = training.select("classes").mapInArrow(_expected_counts(hmm), "row long, " + ", ".join(f"s{k} double" for k in range(STATES)))
    start, move, emit, fit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES)), np.zeros(2)
    for r in gathered.groupBy("row").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(STATES))).collect():
        values = [r[f"s{k}"] for k in range(STATES)]
        if r.row >= 0:
            emit[r.row] = values
        elif r.row == -2 - STATES:
            fit[:] = values[:2]
        elif r.row == -1 - STATES:
            start[:] = values
        else:
            move[-1 - r.row] = values
    return start, move, emit, fit


def learn(docs: DataFrame, folds: int = 10, rounds: int = ROUNDS) -> LanguageModel:
    """Counts, classes and states from the rows of ``docs`` (doc_id, text) outside fold 0."""
    spark = docs.sparkSession
    ship(spark)
    path = work_dir(spark, "hmm")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (in_fold(F.col("doc_id"), folds) != 0).alias("training"), F.col("text").cast("string").alias("text"))
    counted = marked.filter("training").select("text").mapInArrow(_count, "h long, class int, c long")
    counts = settle(counted.groupBy("h").agg(F.first("class").alias("class"), F.sum("c").alias("c")), f"{path}/counts")

    by_class = counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    head = [(r.h, r["class"], r.c) for r in _most_frequent(counts, HEAD).collect()]
    head.sort(key=lambda x: (-x[2], x[0]))
    vocabulary = Vocabulary(head, sum(r.c for r in by_class), sum(r.n for r in by_class), {r["class"]: (r.c, r.n) for r in by_class})
    encoded = settle(marked.mapInArrow(_encode(vocabulary), _ENCODED).withColumn("uid", F.monotonically_increasing_id()), f"{path}/encoded")

    share = vocabulary.class_counts.copy()
    share[: min(WORD_CLASSES, len(head))] = [c for _, _, c in head[:WORD_CLASSES]]
    hmm = Hmm(np.maximum(share, 0))
    training = encoded.filter("training")
    sample, begins = _sequences(training)
    if sample:
        for _ in range(SAMPLE_ROUNDS):
            hmm.update(*hmm.expected(sample, begins))
    fits: list[float] = []
    while sample and (len(fits) < max(rounds, 2) or fits[-1] - fits[-2] >= SETTLED):
        start, move, emit, (total, n) = _gathered(training, hmm)
        hmm.update(start, move, emit)
        fits.append(float(total / n))
    return LanguageModel(vocabulary, hmm, counts, encoded, fits)


def score(model: LanguageModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every encoded row."""
    spark = model.encoded.sparkSession
    v = model.vocabulary
    divisor = spark.createDataFrame([(k, float(x)) for k, x in enumerate(v.share_divisor()) if k >= WORD_CLASSES], "class int, divisor double")
    states = model.encoded.select("uid", "classes").mapInArrow(_scored(model.hmm), "uid long, states double")
    rare = model.encoded.select("uid", F.inline("rare"))
    c = F.coalesce("c", F.lit(0))
    looked_up = rare.join(model.counts.select("h", "c"), "h", "left").join(F.broadcast(divisor), "class")
    sums = looked_up.groupBy("uid").agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("tf") * F.log10((c + ADD) / F.lit(v.total + ADD * (v.distinct + 1)))).alias("rare_base"),
        F.sum(F.col("tf") * F.log10((c + ADD) / F.col("divisor"))).alias("rare_within"),
    )
    out = model.encoded.select("uid", "doc_id", "training", "n_tokens", "n_known", "base", "within").join(states, "uid").join(sums, "uid", "left")
    zero = F.lit(0)
    return out.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("states") + F.col("within") + F.coalesce("rare_within", zero)).alias("score"),
    )
