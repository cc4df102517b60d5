"""Moments of all pairs of columns as one aggregate.

Each task adds up blocks of products of its rows as matrices, and the tasks' matrices are added row by row, in two levels. The plan's size doesn't
depend on the number of columns, and no machine holds more than one matrix: a task holds 4 * D^2 numbers of D columns.
Columns are shifted by their means first, so large means cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..functions.missing import finite_or_null

#: Parts that the tasks' matrices are added up in first, and rows that are multiplied together.
PARTS, ROWS = 64, 4096
_KINDS = ("n", "sx", "sxx", "sxy")
_SCHEMA = "i int, part int, " + ", ".join(f"{k} array<double>" for k in _KINDS)


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, n, sx, sxx, sxy): for each column an array by the other column, over rows where both are finite, of values less their means.

    n counts the rows, sx and sxx add up the column and its square, sxy the products.
    """
    values = df.select(*(finite_or_null(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(columns)))
    means = values.agg(*(F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in values.columns)).first()
    shift, width = np.array(means, dtype=np.float64), len(columns)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, ROWS).columns], axis=1).astype(np.float64) - shift
                there = np.isfinite(x)
                x, m = np.where(there, x, 0.0), there.astype(np.float64)
                sums += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        if sums[0].any():
            yield from _rows(sums, TaskContext.get().partitionId() % PARTS)

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, width))
        for batch in batches:
            for k, kind in enumerate(_KINDS):
                total[k] += batch.column(kind).flatten().to_numpy().reshape(-1, width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), *(pa.array([t]) for t in total)], names=["i", "part", *_KINDS])

    def _rows(sums: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(s.ravel()), width).cast(pa.list_(pa.float64())) for s in sums]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, part, dtype=np.int32)), *lists], names=["i", "part", *_KINDS])

    found = values.mapInArrow(products, _SCHEMA)
    for by in (["i", "part"], ["i"]):
        found = found.groupBy(*by).applyInArrow(added, _SCHEMA)
    return found.drop("part")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for each pair of columns, over rows where both are finite; NaN without two rows or without variance."""
    rows = pair_moments(df, columns)
    own = rows.select("i", F.posexplode(F.arrays_zip(*_KINDS)).alias("j", "m")).select("i", "j", *(F.col(f"m.{k}").alias(k) for k in _KINDS))
    other = own.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("sx").alias("sy"), F.col("sxx").alias("syy"))
    both = own.filter("i < j").join(other, ["i", "j"])
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    r = F.when((n > 1) & (vx > 0) & (vy > 0), (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx) / F.sqrt(vy)).otherwise(F.lit(float("nan")))
    names = F.array(*map(F.lit, columns))
    return both.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), r.alias("r"))
