"""Global ranks and running totals without a global window.

Spark deals the rows to ranges of the sort key, and they are stored in that order once, each with its range and its place. What is
asked for is then counted from the stored rows: totals of the ranges before are added to places or windows within a range. The cuts are
Spark's own, and others by place, and don't show in the plan; they only balance the work, the result doesn't depend on them. A group ``within`` is part of
the key, so one that holds most rows is spread over ranges like any other.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.shared import work_folder


#: A range has at most 2^this rows, and those with the last one's key; a task of ``dealt_by_ranges`` has about so many ranges.
BITS, RANGES_A_TASK = 15, 4


def by_ranges(df: DataFrame, keys: Sequence[Column], within: Sequence[str] = (), together: bool = False) -> DataFrame:
    """``df``, stored by ranges of the keys: with the columns _range and _at, places that ascend within a range.

    What Spark deals to one task is cut into ranges by place. With ``together`` rows of equal keys are in the same range; these should be few.
    """
    spark = df.sparkSession
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.withColumns(dict(zip(names, keys, strict=True)))
    order = [F.col(c).asc_nulls_first() for c in (*within, *names)]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = dealt.withColumn("_at", F.monotonically_increasing_id())
    first = F.min("_at").over(Window.partitionBy(*within, *names)) if together else F.col("_at")
    placed = placed.withColumn("_range", F.shiftright(first, BITS)).drop(*names)
    path = work_folder(spark, "ordering")
    placed.write.mode("overwrite").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def dealt_by_ranges(stored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``stored`` in as many tasks as it has ranges to fill, so that what a task sorts doesn't grow with the table."""
    n = stored.select("_range").distinct().count()
    return stored.repartition(max(1, math.ceil(n / RANGES_A_TASK)), *keys, "_range")


def totals_before(stored: DataFrame, totals: dict[str, Column], within: Sequence[str] = ()) -> DataFrame:
    """(within..., _range, _first, _before_<name>...): of each group and range the first place, and the sums over the ranges before it."""
    sums = stored.groupBy(*within, "_range").agg(F.min("_at").alias("_first"), *(F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()))
    # One row for each range and for each group that begins in it.
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*within, "_range", "_first", *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals))


def _with_offsets(stored: DataFrame, offsets: DataFrame, within: Sequence[str]) -> DataFrame:
    """``stored`` with what ``offsets`` has for its group and range; null is a group."""
    other = offsets.select(*(F.col(c).alias(f"_of_{c}") for c in (*within, "_range")), *(c for c in offsets.columns if c not in (*within, "_range")))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within] + [F.col("_range") == F.col("_of__range")]
    return stored.join(other, same).drop(*(f"_of_{c}" for c in (*within, "_range")))


def running_totals(df: DataFrame, keys: Sequence[Column], totals: dict[str, Column], within: Sequence[str] = ()) -> DataFrame:
    """``df`` with the sums of ``totals`` over all rows up to each row in the order of ``keys``, by group ``within``."""
    stored = by_ranges(df, keys, within)
    joined = _with_offsets(stored, totals_before(stored, totals, within), within)
    order = Window.partitionBy(*within, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns({n: F.sum(c).over(order) + F.col(f"_before_{n}") for n, c in totals.items()})
    return out.drop("_range", "_at", "_first", *(f"_before_{n}" for n in totals))


def global_rank(df: DataFrame, keys: Sequence[Column], name: str = "rank", within: Sequence[str] = ()) -> DataFrame:
    """``df`` with the 0-based position of each row in the order of ``keys``; the first rows of equal keys are any of them."""
    stored = by_ranges(df.drop(name), keys, within)
    placed = _with_offsets(stored, totals_before(stored, {"n": F.lit(1).cast("long")}, within), within)
    return placed.withColumn(name, (F.col("_before_n") + F.col("_at") - F.col("_first")).cast("long")).drop("_range", "_at", "_first", "_before_n")


def value_keys(value: Column, row_id: Column, largest: bool) -> list[Column]:
    """Sort keys: numbers in the wanted order, then NaN and null; ties by row id."""
    v = value.cast("double")
    number = v.isNotNull() & ~F.isnan(v)
    return [(~number).cast("int"), F.when(number, -v if largest else v).otherwise(F.lit(0.0)), row_id]
