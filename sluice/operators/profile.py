"""Profiles of tables, chunks, registries and runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.missing import finite_or_null
from .decisions import GateDecision
from .drift import ks_long, long_form
from .matrices import correlations

#: Bounds of R² from element counts, and what they say.
COUNTING, SIZE = 0.99, 0.9


def size_profile(df: DataFrame, size: str, row_id: str = "row_id") -> DataFrame:
    """(size, n, first_row, fraction): how many rows of each size, and where the first one is."""
    counts = df.filter(F.col(size).isNotNull()).groupBy(F.col(size).alias("size")).agg(F.count("*").alias("n"), F.min(row_id).alias("first_row"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("size", "n", "first_row", (F.col("n") / F.col("total")).alias("fraction"))


def scale_disparity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std, mean_abs, range, orders): orders of magnitude above the smallest deviation."""
    stats = long_form(df, columns).groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.avg(F.abs("value")).alias("mean_abs"), (F.max("value") - F.min("value")).alias("range")
    )
    least = stats.filter("std > 0").agg(F.min("std").alias("least"))
    orders = F.when(F.col("std") > 0, F.bround(F.log10(F.col("std") / F.col("least")), 2))
    return stats.crossJoin(F.broadcast(least)).select("column", "mean", "std", "mean_abs", "range", orders.alias("orders"))


def size_dominance(df: DataFrame, columns: Sequence[str], size: str) -> DataFrame:
    """(column, r2) of straight lines in ``size``, over rows where both are finite."""
    aggs = []
    x = finite_or_null(F.col(size))
    for c in columns:
        y = finite_or_null(F.col(c))
        aggs.append(F.regr_r2(F.when(x.isNotNull(), y), F.when(y.isNotNull(), x)).alias(c))
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("r2")) for c in columns))))


def linear_r2(df: DataFrame, columns: Sequence[str], inputs: Sequence[str]) -> dict[str, float]:
    """R² of least squares with intercept on several inputs: sums of products in one job, solved on the driver."""
    terms = [F.lit(1.0), *(F.col(c).cast("double") for c in inputs)]
    width = len(terms)
    aggs = {}
    for t, c in enumerate(columns):
        y = finite_or_null(F.col(c))
        for i, j in [(i, j) for i in range(width) for j in range(i, width)]:
            aggs[f"{t}x{i}_{j}"] = F.sum(F.when(y.isNotNull(), terms[i] * terms[j]))
        for i in range(width):
            aggs[f"{t}y{i}"] = F.sum(terms[i] * y)
        aggs[f"{t}yy"] = F.sum(y * y)
    row = df.agg(*(a.alias(n) for n, a in aggs.items())).first()
    found = {}
    for t, c in enumerate(columns):
        n = row[f"{t}x0_0"]
        if not n:
            found[c] = float("nan")
            continue
        gram = np.array([[row[f"{t}x{min(i, j)}_{max(i, j)}"] for j in range(width)] for i in range(width)], dtype=float)
        right = np.array([row[f"{t}y{i}"] for i in range(width)], dtype=float)
        beta = np.linalg.lstsq(gram, right, rcond=None)[0]
        around_mean = row[f"{t}yy"] - right[0] ** 2 / n
        left = row[f"{t}yy"] - 2 * beta @ right + beta @ gram @ beta
        found[c] = float(1 - left / around_mean) if around_mean > 0 else float("nan")
    return found


def dominance_verdict(r2: float) -> str:
    return "atom counting" if r2 > COUNTING else "mostly size" if r2 > SIZE else "real chemistry"


def target_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for each pair of columns, over rows where both are finite."""
    return correlations(df, columns)


def chunk_drift(chunks: DataFrame, reference: DataFrame, columns: Sequence[str], chunk: str = "chunk_id") -> DataFrame:
    """(chunk, column, ks) of every chunk against one reference sample, in one job."""
    return ks_long(long_form(chunks, columns, [chunk]), long_form(reference, columns), [chunk])


def chunk_drift_matrix(chunks: DataFrame, reference: DataFrame, columns: Sequence[str], chunk: str = "chunk_id") -> DataFrame:
    """The same with a column for each target."""
    return chunk_drift(chunks, reference, columns, chunk).groupBy(chunk).pivot("column", list(columns)).agg(F.first("ks"))


def chunk_sizes(chunks: DataFrame, size: str, chunk: str = "chunk_id") -> DataFrame:
    return chunks.groupBy(chunk).agg(F.count("*").alias("n"), F.avg(size).alias("mean_size"), F.min(size).alias("min_size"), F.max(size).alias("max_size"))


def triage_funnel(decision: GateDecision) -> DataFrame:
    """(step, check, kept, total, dropped) of every check with a mask, and of all together; one pass."""
    if decision.frame is None:
        raise ValueError("this decision is not about rows")
    return mask_funnel(decision.frame, dict(decision.masks))


def mask_funnel(frame: DataFrame, masks: Mapping[str, str]) -> DataFrame:
    """The funnel of named boolean columns."""
    every = F.lit(True)
    for m in masks.values():
        every = every & F.col(m)
    kept = [F.coalesce(F.sum(c.cast("long")), F.lit(0)) for c in (*(F.col(m) for m in masks.values()), every)]
    row = frame.agg(F.count("*").alias("total"), *(c.alias(f"k{i}") for i, c in enumerate(kept)))
    steps = [F.struct(F.lit(i).alias("step"), F.lit(n).alias("check"), F.col(f"k{i}").alias("kept"), F.col("total"), (F.col("total") - F.col(f"k{i}")).alias("dropped")) for i, n in enumerate((*masks, "all"))]
    return row.select(F.inline(F.array(*steps)))


def model_trajectory(registry: DataFrame, eval_set: str = "golden") -> DataFrame:
    """(version, stage, created_at, score, failed) by time; failed joins the names of the failed checks."""
    decision = F.from_json("gate_decision", "results array<struct<name:string,verdict:boolean,blocking:boolean>>")
    failed = F.filter(decision["results"], lambda r: ~r["verdict"] & r["blocking"])
    score = F.get_json_object("metrics", f"$.{eval_set}.normalized_score").cast("double")
    return registry.select(
        "version", "stage", "created_at", score.alias("score"), F.coalesce(F.array_join(F.transform(failed, lambda r: r["name"]), ", "), F.lit("")).alias("failed")
    ).orderBy("created_at", "version")


_METRICS = "per_target map<string,struct<mae:double,rmse:double,r2:double,n:long>>, slices map<string,struct<normalized_mae:double,n:long>>"


def per_target_metrics(registry: DataFrame, eval_set: str = "golden") -> DataFrame:
    """(version, target, mae) with the last 13 characters of the version."""
    parsed = registry.select("version", F.from_json(F.get_json_object("metrics", f"$.{eval_set}"), _METRICS).alias("m"))
    return parsed.select(F.right("version", F.lit(13)).alias("version"), F.explode("m.per_target").alias("target", "v")).select("version", "target", F.col("v.mae").alias("mae"))


def slice_table(registry: DataFrame, version: str, eval_set: str = "golden") -> DataFrame:
    """(slice, normalized_mae, n) of one model."""
    parsed = registry.filter(F.col("version") == version).select(F.from_json(F.get_json_object("metrics", f"$.{eval_set}"), _METRICS).alias("m"))
    return parsed.select(F.explode("m.slices").alias("slice", "v")).select("slice", F.col("v.normalized_mae").alias("normalized_mae"), F.col("v.n").alias("n"))


def findings(raw: DataFrame, chunks: DataFrame, targets: Sequence[str], size: str, counts: Sequence[str], row_id: str = "row_id", head: int | None = None) -> dict[str, Any]:
    """The headline numbers of a data set; dominance is measured on all rows, or on those with a row id below ``head``."""
    profile = size_profile(raw, size, row_id).orderBy(F.desc("n")).first()
    first = raw if head is None else raw.filter(F.col(row_id) < head)
    lowest = chunks.agg(F.min("chunk_id")).first()[0]
    drift = chunk_drift(chunks, chunks.filter(F.col("chunk_id") == lowest), targets)
    worst = drift.filter(~F.isnan("ks")).groupBy("chunk_id").agg(F.max("ks").alias("ks")).orderBy("chunk_id").collect()
    r2 = linear_r2(first, targets, counts)
    return {
        "n_rows": raw.count(),
        "largest_size": profile["size"] if profile else None,
        "fraction_largest": profile["fraction"] if profile else None,
        "scale_orders": scale_disparity(raw, targets).agg(F.max("orders")).first()[0],
        "r2_from_counts": r2,
        "verdicts": {t: dominance_verdict(x) for t, x in r2.items()},
        "max_ks_by_chunk": {r.chunk_id: r.ks for r in worst},
        "max_ks": max((r.ks for r in worst), default=None),
    }
