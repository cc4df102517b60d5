"""Distribution shift against a frozen reference: Kolmogorov-Smirnov and population stability.

Several columns, and several groups of rows, are handled in one job: values are brought to long form,
counted by value before they are compared, and cumulated in ranges (see ``ordering``). Null, NaN and
infinite values don't count. A side without values gives NaN.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.missing import finite_or_null
from ..sources.storage import read_bytes, storage_of
from .ordering import by_ranges, dealt_by_ranges, running_totals, totals_before

N_QUANTILES = 401


@dataclass(frozen=True)
class ColumnReference:
    quantiles: tuple[float, ...]
    mean: float
    std: float


@dataclass(frozen=True)
class Reference:
    """Quantile grids, means and population standard deviations of the reference's columns."""

    n_quantiles: int
    n_rows: int
    columns: Mapping[str, ColumnReference]

    @staticmethod
    def load_if_there(path: str | Path) -> Reference | None:
        if not storage_of(path).exists(path):
            return None
        raw = json.loads(read_bytes(path))
        columns = {c: ColumnReference(tuple(map(float, x["quantiles"])), x["mean"], x["std"]) for c, x in raw.get("columns", {}).items() if x}
        return Reference(raw.get("n_quantiles", N_QUANTILES), raw.get("n_rows", 0), columns)

    def save(self, path: str | Path) -> str:
        columns = {c: {"quantiles": list(x.quantiles), "mean": x.mean, "std": x.std} for c, x in self.columns.items()}
        text = json.dumps({"n_quantiles": self.n_quantiles, "n_rows": self.n_rows, "columns": columns}, indent=2, sort_keys=True)
        storage_of(path).write(path, text.encode())
        return str(path)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value): one row for each finite value."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), finite_or_null(F.col(c)).alias("value")) for c in columns))
    return df.select(*keep, F.inline(pairs)).filter("value is not null")


def quantile_grids(df: DataFrame, columns: Sequence[str], n_quantiles: int = N_QUANTILES, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, quantiles, mean, std, n): exact interpolated quantiles, in one job for all columns."""
    return grids_of(long_form(df, columns, keep), n_quantiles - 1, keep)


def grids_of(long: DataFrame, steps: int, keep: Sequence[str] = ()) -> DataFrame:
    """The quantiles 0, 1/steps, ... of a long form (keep..., column, value), with mean, std and n.

    Values are counted and cumulated in ranges, so no task holds a column. A value that covers the ranks a to b (from 0)
    is the lower neighbour of the quantiles k with a <= floor(k (n - 1) / steps) <= b, and the upper one likewise.
    """
    by = [*keep, "column"]
    facts = long.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("*").alias("n"))
    counts = long.groupBy(*by, "value").agg(F.count("*").alias("c"))
    cumulated = running_totals(counts, [F.col("value")], {"upto": F.col("c")}, by)
    q, last = F.lit(steps).cast("long"), F.greatest(F.col("n") - 1, F.lit(1))

    def least(rank: Column) -> Column:
        """The least k whose lower rank is at least ``rank``."""
        return F.greatest(F.lit(0).cast("long"), F.ceil((rank * q) / last.cast("decimal(20,0)")).cast("long"))

    placed = cumulated.join(F.broadcast(facts.select(*by, "n")), by)  # a row for each column and group that the caller names
    a, b = F.col("upto") - F.col("c"), F.col("upto") - 1
    single = F.col("n") == 1

    def covered(lo: Column, hi: Column) -> Column:
        first, end = least(lo), F.least(least(hi + 1) - 1, q)
        return F.when(single, F.sequence(F.lit(0).cast("long"), q)).when(first <= end, F.sequence(first, end)).otherwise(F.array().cast("array<long>"))

    top = b == F.col("n") - 1  # the upper neighbour of the last rank is itself
    lower = placed.select(*by, "value", F.explode(covered(a, b)).alias("k"), F.lit(True).alias("low"))
    upper = placed.select(*by, "value", F.explode(covered(a - 1, F.when(top, b).otherwise(b - 1))).alias("k"), F.lit(False).alias("low"))
    ends = lower.unionByName(upper).groupBy(*by, "k").agg(F.max(F.when(F.col("low"), F.col("value"))).alias("lo"), F.max(F.when(~F.col("low"), F.col("value"))).alias("hi"))
    exact = ends.join(F.broadcast(facts.select(*by, "n")), by)
    share = F.pmod(F.col("k") * (F.col("n") - 1), q) / q
    grid = exact.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", (F.col("lo") + share * (F.col("hi") - F.col("lo"))).alias("v")))), lambda x: x.v).alias("quantiles"))
    return facts.join(grid, by).select(*by, "quantiles", "mean", "std", "n")


def freeze_reference(df: DataFrame, columns: Sequence[str], n_quantiles: int = N_QUANTILES) -> Reference:
    """The reference of a frame; columns without finite values are left out."""
    there = [c for c in columns if c in df.columns]
    rows = quantile_grids(df, there, n_quantiles).collect()
    return Reference(n_quantiles, df.count(), {r.column: ColumnReference(tuple(r.quantiles), r["mean"], r["std"]) for r in rows})


def ks_long(sample: DataFrame, reference: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, ks): the largest gap between cumulative shares of two long forms.

    ``sample`` has (by..., column, value), ``reference`` (column, value). Every group of the sample is
    compared with the whole reference of its column; groups whose column has no reference give NaN.
    """
    values = sample.groupBy(*by, "column", "value").agg(F.count("*").alias("s"))
    base = reference.groupBy("column", "value").agg(F.count("*").alias("r"))
    # Values of all groups and of the reference lie in the same ranges, so one pass cumulates both sides.
    stored = by_ranges(values.withColumn("r", F.lit(0).cast("long")).unionByName(base.withColumn("s", F.lit(0).cast("long")), allowMissingColumns=True), [F.col("column"), F.col("value")], together=True)
    groups = stored.filter("s > 0").groupBy(*by, "column").agg(F.sum("s").alias("n_s"))
    sizes = stored.groupBy("column").agg(F.sum("r").alias("n_r")).filter("n_r > 0")
    own, whole = (Window.partitionBy(*key, "column", "_range").orderBy("value").rangeBetween(Window.unboundedPreceding, 0) for key in (by, ()))
    local = dealt_by_ranges(stored, ["column"]).withColumns({"cs": F.sum("s").over(own), "cr": F.sum("r").over(whole), "here": F.sum("r").over(Window.partitionBy("column", "_range", "value"))})
    seen, expected = (totals_before(stored, {n: F.col(n)}, key).drop("_first") for n, key in (("s", [*by, "column"]), ("r", ["column"])))
    gaps = local.filter("s > 0").join(seen, [*by, "column", "_range"]).join(expected, ["column", "_range"]).join(groups, [*by, "column"]).join(F.broadcast(sizes), "column")
    cs, cr = F.col("cs") + F.col("_before_s"), F.col("cr") + F.col("_before_r")
    # Between two values of the sample its share stands still, so the gap is widest at a value or just before one.
    at = F.abs(cs / F.col("n_s") - cr / F.col("n_r"))
    before = F.abs((cs - F.col("s")) / F.col("n_s") - (cr - F.col("here")) / F.col("n_r"))
    found = gaps.groupBy(*by, "column").agg(F.max(F.greatest(at, before)).alias("ks"))
    return groups.join(found, [*by, "column"], "left").select(*by, "column", F.coalesce("ks", F.lit(float("nan"))).alias("ks"))


def psi_long(sample: DataFrame, reference: DataFrame, by: Sequence[str] = (), buckets: int = 10, epsilon: float = 1e-6) -> DataFrame:
    """(by..., column, psi) of long forms, as for ``ks_long``.

    The edges are quantiles of the reference; the expected share of a bucket is counted, not assumed, so
    piles of equal reference values do no harm. Empty buckets count as ``epsilon``.
    """
    if buckets < 2:
        raise ValueError("buckets must be at least 2")
    edges = grids_of(reference, buckets).select("column", F.col("n").alias("n_r"), F.col("quantiles").alias("q"))
    edges = edges.select("column", "n_r", F.array_sort(F.array_distinct(F.slice("q", 2, buckets - 1))).alias("edges"))
    # A row for each column, which a plan names one by one: small by construction.
    edges = F.broadcast(edges)
    bucket = F.size(F.filter("edges", lambda e: e <= F.col("value")))
    s = sample.join(edges, "column").groupBy(*by, "column", bucket.alias("bucket")).agg(F.count("*").alias("s"))
    r = reference.join(edges, "column").groupBy("column", bucket.alias("bucket")).agg(F.count("*").alias("r"))
    groups = s.groupBy(*by, "column").agg(F.sum("s").alias("n_s"))
    every = groups.join(edges, "column").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.size("edges"))))
    both = every.join(s, [*by, "column", "bucket"], "left").join(r, ["column", "bucket"], "left")
    p = F.greatest(F.coalesce(F.col("s"), F.lit(0)) / F.col("n_s"), F.lit(epsilon))
    q = F.greatest(F.coalesce(F.col("r"), F.lit(0)) / F.col("n_r"), F.lit(epsilon))
    found = both.groupBy(*by, "column").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    missing = sample.select(*by, "column").distinct().join(found, [*by, "column"], "left")
    return missing.select(*by, "column", F.coalesce("psi", F.lit(float("nan"))).alias("psi"))


def drift_statistics(df: DataFrame, reference: Reference, columns: Sequence[str], method: str = "ks", buckets: int = 10) -> dict[str, float]:
    """Each column's statistic against the reference's quantile grid, in one job; NaN without finite values."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(c, float(v)) for c in columns for v in reference.columns[c].quantiles], "column string, value double")
    sample = long_form(df, columns)
    found = psi_long(sample, grid, buckets=buckets) if method == "psi" else ks_long(sample, grid)
    values = {r["column"]: r[method] for r in found.collect()}
    return {c: float(values.get(c, math.nan)) for c in columns}


def ks_statistic(sample: DataFrame, reference: DataFrame, column: str = "value") -> float:
    """The statistic of one column of two frames."""
    a, b = long_form(sample, [column]), long_form(reference, [column])
    row = ks_long(a, b).first()
    return float(row.ks) if row else math.nan


def psi_statistic(sample: DataFrame, reference: DataFrame, column: str = "value", buckets: int = 10, epsilon: float = 1e-6) -> float:
    row = psi_long(long_form(sample, [column]), long_form(reference, [column]), (), buckets, epsilon).first()
    return float(row.psi) if row else math.nan
