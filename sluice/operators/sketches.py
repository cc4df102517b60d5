"""Distributions kept as mergeable quantile sketches, one for each chunk.

A chunk is read once: what is kept of it is, for each column, a KLL sketch of about k numbers with count, mean and deviation. References and
drift of any set of chunks come from merging these, so a new chunk re-reads no old one; the same aggregate runs over
windows of a stream. Sketches are exact up to k values; beyond, the rank of any value is off by at most ``rank_error(k)``, with a probability
of 99 % a sketch, whatever the distribution, and merging keeps that bound.

A statistic compares the quantiles i / STEPS of both sides; between neighbours a cumulative share can't change by more than 1 / STEPS.
Null, NaN and infinite values don't count, as elsewhere in ``drift``; a column without values has no sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .drift import ColumnReference, Reference, long_form

K, STEPS = 2000, 400


def rank_error(k: int = K) -> float:
    """The published normalized rank error of a KLL sketch, two-sided, at 99 % confidence."""
    return 2.296 / k**0.9021


def ks_error(k: int = K, steps: int = STEPS) -> float:
    """By how much ``sketched_ks`` may differ from the exact statistic."""
    return 2 * (rank_error(k) + 1 / steps)


def moments(value: str = "value", k: int = K) -> list[Column]:
    """Aggregates of one distribution: n, mean, m2 (the sum of squared deviations), low, high, sketch."""
    return [
        F.count(value).alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("m2"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.kll_sketch_agg_double(value, k).alias("sketch"),
    ]


def sketched(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """(by..., column, n, mean, m2, low, high, sketch): one row for each group and column, from one pass with partial aggregation."""
    return long_form(df, columns, by).groupBy(*by, "column").agg(*moments(k=k))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of groups as those of their unions: (by..., column, n, mean, m2, low, high, sketch)."""
    key = [*by, "column"]
    centres = sketches.groupBy(*(F.col(c).alias(f"_{c}") for c in key)).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    apart = sketches.join(centres, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
    m2 = F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("centre")) * (F.col("mean") - F.col("centre")))
    return apart.groupBy(*key).agg(
        F.sum("n").alias("n"), F.first("centre").alias("mean"), m2.alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def quantiles(sketch: Column, low: Column, high: Column, steps: int = STEPS) -> Column:
    """The quantiles 0, 1/steps, ...; the ends are exact."""
    inner = F.kll_sketch_get_quantile_double(sketch, F.lit([i / steps for i in range(steps + 1)]))
    return F.transform(inner, lambda q, i: F.when(i == 0, low).when(i == steps, high).otherwise(q))


def _shares(points: Column, grid: Column) -> Column:
    """What share of a grid is at or below each of the points."""
    return F.transform(points, lambda x: F.size(F.filter(grid, lambda q: q <= x)) / F.size(grid))


def sketched_ks(sample: DataFrame, reference: DataFrame, by: Sequence[str] = (), steps: int = STEPS) -> DataFrame:
    """(by..., column, n, ks) of sketched samples against one sketched reference for each column; NaN where there is none.

    A projection of ``sample``, so that it also runs on a stream; its work grows with steps^2 for each sketch, not with the rows behind it.
    """
    known = reference.select("column", quantiles(F.col("sketch"), F.col("low"), F.col("high"), steps).alias("expected"))
    # A row for each column that the caller names.
    both = sample.join(F.broadcast(known), "column", "left").withColumn("seen", quantiles(F.col("sketch"), F.col("low"), F.col("high"), steps))
    both = both.withColumn("points", F.array_distinct(F.concat("seen", "expected")))
    gaps = F.zip_with(_shares(F.col("points"), F.col("seen")), _shares(F.col("points"), F.col("expected")), lambda a, b: F.abs(a - b))
    return both.select(*by, "column", "n", F.coalesce(F.array_max(gaps), F.lit(float("nan"))).alias("ks"))


def reference_of(sketches: DataFrame, steps: int = STEPS) -> Reference:
    """The frozen reference of merged sketches: a row for each column comes to the driver."""
    rows = sketches.select("column", "n", "mean", "m2", quantiles(F.col("sketch"), F.col("low"), F.col("high"), steps).alias("q")).collect()
    columns = {r["column"]: ColumnReference(tuple(r.q), r["mean"], (r.m2 / r.n) ** 0.5) for r in rows}
    return Reference(steps + 1, max((r.n for r in rows), default=0), columns)


class SketchStore:
    """Sketches of chunks as a Parquet table at ``path``, one folder for each chunk."""

    def __init__(self, spark: SparkSession, path: str, k: int = K) -> None:
        self.spark, self.path, self.k = spark, path, k

    def add(self, df: DataFrame, columns: Sequence[str], chunk: str = "chunk_id") -> None:
        """Keeps the sketches of the chunks of ``df``, in place of earlier ones of the same chunks; others aren't touched."""
        rows = sketched(df.withColumn("chunk_id", F.col(chunk).cast("string")), columns, ["chunk_id"], self.k)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(self.path)

    def sketches(self) -> DataFrame:
        """(chunk_id, column, n, mean, m2, low, high, sketch)"""
        schema = "column string, n long, mean double, m2 double, low double, high double, sketch binary, chunk_id string"
        return self.spark.read.schema(schema).parquet(self.path)

    def reference(self, upto: str | None = None) -> Reference:
        """Of all chunks, or those up to one."""
        return reference_of(merged(self.sketches() if upto is None else self.sketches().filter(F.col("chunk_id") <= upto)))


def sketched_windows(events: DataFrame, time_column: str, columns: Sequence[str], window: str, watermark: str | None = None, k: int = K) -> DataFrame:
    """(start, column, n, mean, m2, low, high, sketch) of event-time windows, batch and streaming alike; with a watermark late events don't count."""
    timed = events.withColumn("_t", F.col(time_column).cast("timestamp"))
    long = long_form(timed.withWatermark("_t", watermark) if watermark else timed, columns, ["_t"])
    return long.groupBy(F.window("_t", window).alias("w"), "column").agg(*moments(k=k)).select(F.col("w.start").alias("start"), "column", "n", "mean", "m2", "low", "high", "sketch")
