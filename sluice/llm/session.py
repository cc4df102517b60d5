"""Where jobs of this subpackage keep intermediate tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.shared import clear_work, work_folder
from ..functions.shipping import ship

__all__ = ["clear_work", "fresh_names", "settle", "ship", "work_dir"]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run's tables below ``spark.checkpoint.dir``, shared by driver and executors.

    Results are read from it lazily, so it is the caller who clears it (``clear_work``) when results have been used.
    """
    return work_folder(spark, name)


def fresh_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, lengthened where a column of that name (in any case) is taken."""
    used, found = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        found.append(name)
    return found


def settle(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage so that lost executors cost no more than a reread."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
