"""Carving a table into arriving chunks, a frozen golden set, holdouts and stratified pools.

Draws are made by the order of a hash of seed and row id, so any engine repeats them. All samples are
disjoint, of exact size, and keep the rows' order (by row id).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.identity import seeded
from .ordering import global_rank


def systematic_sample(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    """Every k-th row, k = rows // n, and of these the first n; row ids must be 0, 1, ..."""
    total = df.count()
    step = max(1, total // n) if n > 0 else 1
    return df.filter((F.col(row_id) % step == 0) & (F.col(row_id) < step * n))


def holdout_size(n: int, fraction: float) -> int:
    """How many of n rows are held out: none of fewer than two, else at least one and never all."""
    return 0 if fraction <= 0 or n < 2 else min(n - 1, max(1, round(n * fraction)))


def holdout_split(df: DataFrame, fraction: float, seed: str, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(kept, held out) rows; the same content and seed give the same split."""
    n_held = holdout_size(df.count(), fraction)
    if not n_held:
        return df, df.limit(0)
    ranked = global_rank(df, [seeded(seed, row_id), F.col(row_id)], "_draw")
    return ranked.filter(F.col("_draw") >= n_held).drop("_draw"), ranked.filter(F.col("_draw") < n_held).drop("_draw")


def mark_holdout(df: DataFrame, fraction: float, seed: Column, within: str, row_id: str = "row_id") -> DataFrame:
    """``df`` with the flag ``held``: of every chunk ``within`` the rows that ``holdout_split`` would hold out, for all chunks in one job.

    ``seed`` is a column of strings, the same for all rows of a chunk.
    """
    if fraction <= 0:
        return df.withColumn("held", F.lit(False))
    draw = F.sha2(F.concat(seed, F.lit("#"), F.col(row_id).cast("string")), 256)
    ranked = global_rank(df, [draw, F.col(row_id)], "_draw", [within])
    sizes = df.groupBy(within).agg(F.count("*").alias("_n"))
    n_held = F.when(F.col("_n") < 2, 0).otherwise(F.least(F.col("_n") - 1, F.greatest(F.lit(1), F.bround(F.col("_n") * fraction, 0).cast("long"))))
    return ranked.join(F.broadcast(sizes), within).withColumn("held", F.col("_draw") < n_held).select(*df.columns, "held")


#: Quotas of so many sizes are broadcast, 16 bytes each; those of more are joined by a shuffle.
BROADCAST_SIZES = 100_000


def stratified_quotas(counts: DataFrame, n: int, size: str = "size", count: str = "n") -> DataFrame:
    """(size, quota): how many rows of each size; equal shares as far as there are rows, the rest by what is left.

    ``counts`` has a row for each size; sizes below 1 are left out. Two aggregates, four numbers, come to the driver, whatever the number of sizes.
    """
    own = counts.filter(F.col(size) > 0)
    share = F.lit(max(1, n // max(1, own.count())))
    first = F.least(F.col(count), share)
    sums = own.agg(F.sum(first).alias("given"), F.sum(F.col(count) - first).alias("spare")).first()
    left, spare = n - (sums.given or 0), sums.spare or 0
    if left <= 0 or spare <= 0:
        return own.select(size, first.cast("long").alias("quota"))
    more = F.bround(F.lit(float(left)) * (F.col(count) - first) / F.lit(float(spare)), 0).cast("long")
    return own.select(size, (first + F.least(F.col(count) - first, more)).cast("long").alias("quota"))


def stratified_pool(df: DataFrame, size: str, n: int, seed: str, row_id: str = "row_id") -> DataFrame:
    """About n rows spread over the sizes (0 and missing sizes are left out), with ``position`` by size and row id."""
    sized = df.filter(F.col(size) > 0).withColumn("_size", F.col(size).cast("long"))
    counts = sized.groupBy("_size").agg(F.count("*").alias("_n"))
    limits = stratified_quotas(counts, n, "_size", "_n").withColumnRenamed("quota", "_quota")
    few = limits.limit(BROADCAST_SIZES + 1).count() <= BROADCAST_SIZES
    ranked = global_rank(sized, [seeded(seed, row_id), F.col(row_id)], "_draw", ["_size"])
    pool = ranked.join(F.broadcast(limits) if few else limits, "_size").filter(F.col("_draw") < F.col("_quota")).drop("_draw", "_size", "_quota")
    return global_rank(pool, [F.col(size), F.col(row_id)], "position")


def chunk_bounds(n: int, n_chunks: int) -> list[int]:
    """Where the chunks of n rows begin, and n."""
    return [int(x) for x in np.linspace(0, n, n_chunks + 1)]


def golden_sample(df: DataFrame, sizes: dict[int, int], fraction: float, seed: str, chunk: str = "chunk", row_id: str = "row_id") -> DataFrame:
    """``df`` with the flag ``golden`` on round(size * fraction) rows of each chunk."""
    quotas = df.sparkSession.createDataFrame([(k, round(n * fraction)) for k, n in sizes.items()], f"`{chunk}` int, _quota long")
    ranked = global_rank(df, [seeded(seed, row_id), F.col(row_id)], "_draw", [chunk])
    return ranked.join(F.broadcast(quotas), chunk).withColumn("golden", F.col("_draw") < F.col("_quota")).drop("_draw", "_quota")


def split_into_chunks(
    df: DataFrame, size: str, n_rows: int = 5000, n_chunks: int = 6, golden_fraction: float = 0.15, seed: str = "0", mode: str = "size_ramp", row_id: str = "row_id"
) -> DataFrame:
    """Rows of the pool with ``position``, ``chunk`` (0, 1, ...) and ``golden``.

    ``size_ramp`` takes a pool stratified by size and ordered by it, so that chunks drift on purpose;
    ``sequential`` takes every k-th row in file order.
    """
    if n_chunks < 1:
        raise ValueError("n_chunks must be at least 1")
    if mode == "size_ramp":
        pool = stratified_pool(df, size, n_rows, seed, row_id)
    elif mode == "sequential":
        pool = global_rank(systematic_sample(df, n_rows, row_id), [F.col(row_id)], "position")
    else:
        raise ValueError(f"unknown mode {mode!r}; known: size_ramp, sequential")
    bounds = chunk_bounds(pool.count(), n_chunks)
    chunk = sum(((F.col("position") >= b).cast("int") for b in bounds[1:-1]), F.lit(0))
    sizes = {k: b - a for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))}
    return golden_sample(pool.withColumn("chunk", chunk), sizes, golden_fraction, f"{seed}/golden", "chunk", row_id)


def leakage(train: DataFrame, golden: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Golden rows whose keys also occur in training data."""
    return golden.join(train.select(*keys), list(keys), "left_semi")
