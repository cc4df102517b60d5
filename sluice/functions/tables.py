"""Table functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from .shipping import ship


@udtf(returnType="target string, slice string, n long, total double")
class SliceSums:
    """Sums of the absolute errors of each slice in a partition of (target, slices, error).

    ``SELECT * FROM slice_sums(TABLE(errors) PARTITION BY (target, part))``: a partition is read row by row, and what it holds is one sum for each
    of its slices. With a part that deals a target's rows out, sums of the parts are added by an ordinary GROUP BY.
    """

    def __init__(self) -> None:
        self.target: str | None = None
        self.sums: dict[str, tuple[int, float]] = {}

    def eval(self, row: Row) -> None:
        self.target = row["target"]
        if row["error"] is not None:
            for name in row["slices"] or ():
                n, total = self.sums.get(name, (0, 0.0))
                self.sums[name] = n + 1, total + abs(row["error"])

    def terminate(self) -> Iterator[tuple[str | None, str, int, float]]:
        for name, (n, total) in self.sums.items():
            yield self.target, name, n, total


def register_tables(spark: SparkSession) -> None:
    """Makes ``slice_sums`` known to the session's SQL."""
    ship(spark)
    spark.udtf.register("slice_sums", SliceSums)
