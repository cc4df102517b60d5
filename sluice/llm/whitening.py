"""Whitening of embeddings by the singular vectors of their centred rows.

Components become whole numbers, x = floor(scale * c) + shift, so counts and sums over all rows are exact. With n rows and sums S a row's
centred vector is (n * x - S) / n, taken from whole numbers before anything is multiplied. Its squared length times n^2, the row's
deviation, is exact too, and so is the deviations' sum, from which the total variance comes, apart from the decomposition.

Spark MLlib's ``RowMatrix.computeSVD`` decomposes the centred rows. All singular values are asked for, since then the decomposition of the
Gramian is a dense one in full precision; asked for a few, it would be iterative. A singular value s of n centred rows belongs to the eigenvalue s^2 / n of
their covariance with divisor n, and a row is whitened by its products with the singular vectors over the roots of these.
A last pass measures the whitened rows' own covariance.

What a task holds is a batch of rows and the vectors, D * D numbers; the driver gets sums of D columns, the D * D vectors and the
covariances of the whitened columns. D is the length of a vector, at most a few thousand; nothing is shuffled by a key.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry are dropped, and so are those with an entry of LARGEST or more,
for which sums would leave 64 bits, and vectors of another length than the most frequent one (of equally frequent ones the
longest). Rows that share an id, or have none, are rows of their own. Signs make each singular vector's largest entry positive.
Components without variance, whose eigenvalue isn't over FLAT of the largest, are left out (a double can't tell them from rounding): one row,
equal rows and an empty table give no rows. Other columns aren't read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from .session import settle, ship, work_dir

SCALE, SHIFT, COMPONENTS = 1024.0, 100_000, 8
LARGEST = float(1 << 30)
FLAT = 1e-10


def _whole(scale: float, shift: int):
    """(vec_id, x) of the rows whose entries are all finite and below LARGEST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            offsets = vectors.offsets.to_numpy().astype(np.int64)
            values = vectors.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = offsets - offsets[0]
            with np.errstate(invalid="ignore"):
                fine = np.abs(values) < LARGEST  # not so for null, which is NaN here
            bad = np.concatenate([[0], np.cumsum(~fine)])
            good = (bad[offsets[1:]] == bad[offsets[:-1]]) & (np.diff(offsets) > 0) & vectors.is_valid().to_numpy(zero_copy_only=False)
            x = np.floor(scale * np.where(fine, values, 0.0)).astype(np.int64) + shift
            lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(x)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["vec_id", "x"]).filter(pa.array(good))

    return run


def _rows_of(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), dtype=np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of a task: the number of its rows and their sums."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            part = _rows_of(batch.column(0)).sum(0)
            exact = [int(v) for v in part]
            n, total = n + batch.num_rows, exact if total is None else [a + b for a, b in zip(total, exact, strict=True)]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[Decimal(v) for v in total]], pa.list_(pa.decimal128(38, 0)))], names=["n", "sums"])


@dataclass(frozen=True)
class Whitening:
    """A fit: rows, exact sums, eigenvalues of the covariance, the vectors (a column each), and the total variance."""

    n: int
    sums: list[int]
    variances: np.ndarray
    vectors: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S in whole numbers, as Python's where 64 bits might not hold them or their squares' sum."""
        most = self.n * (int(np.abs(x).max(initial=0)) + 1) + max((abs(s) for s in self.sums), default=0)
        if most < 1 << 62:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            if int(np.abs(apart).max(initial=0)) ** 2 * max(1, x.shape[1]) < 1 << 63:
                return apart
            return apart.astype(object)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)


def _decimals(squares: np.ndarray) -> pa.Array:
    """Sums of the rows of exact squares."""
    sums = squares.sum(1)
    return pa.array([Decimal(int(v)) for v in sums], pa.decimal128(38, 0)) if sums.dtype == object else pa.array(sums).cast(pa.decimal128(38, 0))


def _centred(fit: Whitening):
    """(deviation, centred): exact, and as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = fit.centred(_rows_of(batch.column(0)))
            deviation = _decimals(apart * apart)
            centred = (apart / fit.n).astype(np.float64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(centred.ravel()), centred.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([deviation, lists], names=["deviation", "centred"])

    return run


def _whitened(fit: Whitening):
    """(vec_id, deviation, w1, w2, ...)"""
    weights = fit.vectors / np.sqrt(fit.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = fit.centred(_rows_of(batch.column(1)))
            deviation = _decimals(apart * apart)
            white = (apart / fit.n).astype(np.float64) @ weights
            columns = [pa.array(np.ascontiguousarray(white[:, k])) for k in range(white.shape[1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, *columns], names=["vec_id", "deviation", *(f"w{k + 1}" for k in range(len(columns)))])

    return run


def whole_rows(vectors: DataFrame, path: str, scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): the rows that take part, as whole numbers."""
    ship(vectors.sparkSession)
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = settle(raw.mapInArrow(_whole(scale, shift), "vec_id long, x array<long>"), f"{path}/whole")
    often = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (often["d"] if often else 0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """From all of ``rows`` (x)."""
    parts = rows.select("x").mapInArrow(_sums, "n long, sums array<decimal(38,0)>")
    sums = parts.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    found = Whitening(sums[0]["n"] if sums else 0, [int(r["s"]) for r in sums], np.zeros(0), np.zeros((len(sums), 0)), 0.0)
    if not sums:
        return found
    apart = rows.select("x").mapInArrow(_centred(found), "deviation decimal(38,0), centred array<double>")
    deviations = int(apart.agg(F.sum("deviation")).first()[0])
    if not deviations:
        return found
    matrix = MLUtils.convertVectorColumnsFromML(apart.select(array_to_vector("centred").alias("centred")), "centred")
    svd = RowMatrix(matrix, 0, len(sums)).computeSVD(len(sums), computeU=False)
    variances = svd.s.toArray()[:components] ** 2 / found.n
    k = int((variances > FLAT * variances[0]).sum())
    vectors = svd.V.toArray()[:, :k]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    return Whitening(found.n, found.sums, variances[:k], vectors, float(Fraction(deviations, found.n**3)))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row that takes part and each component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where a long can't hold it; ``exact_deviation`` always has it.
    """
    path = work_dir(vectors.sparkSession, "whitening")
    rows = whole_rows(vectors, path)
    found = fit(rows, components)
    k = len(found.variances)
    names = [f"w{i + 1}" for i in range(k)]
    schema = "vec_id long, deviation decimal(38,0)" + "".join(f", {w} double" for w in names)
    white = rows.select("vec_id", "x").mapInArrow(_whitened(found), schema)
    error = 0.0
    if k:
        white = settle(white, f"{path}/white")
        pairs = list(itertools.combinations_with_replacement(range(k), 2))
        measured = white.agg(*(F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
        error = max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    each = [F.struct(F.lit(i + 1).alias("component"), F.col(w).alias("whitened"), F.lit(float(found.variances[i]) / found.total).alias("explained")) for i, w in enumerate(names)]
    listed = F.array(*each) if k else F.array().cast("array<struct<component:int,whitened:double,explained:double>>")
    return white.select("vec_id", "deviation", F.explode(listed).alias("c")).select(
        "vec_id", "c.component", F.lit(found.n).cast("long").alias("n"), F.col("deviation").try_cast("long").alias("deviation"),
        "c.whitened", "c.explained", F.lit(error).alias("identity_error"), F.col("deviation").alias("exact_deviation"),
    )
