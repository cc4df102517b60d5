"""Waiting until files are quiet, as the state of a stream.

Each path has one state: the last version seen and when it will be due. A change moves the due time on; a timer hands the version on once
nothing has come for the wait. State and timers are in the stream's checkpoint, so what is pending survives a restart. Contents that
have been handed on under any name are dropped afterwards, so a copy is the same data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.shipping import ship
from ..sources.folder_source import FILES, chunk_folder

_STORE, _ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EMPTY = "spark.sql.streaming.noDataMicroBatches.enabled"


_FACTS = Row(*(field.split()[0] for field in FILES.split(", ")))


class QuietFiles(StatefulProcessor):
    """The last version of each path, ``wait`` milliseconds after its last change was seen."""

    def __init__(self, wait: int) -> None:
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", f"{FILES}, due long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(rows, key=lambda r: r.changed)
        if held := self.last.get():
            self.handle.deleteTimer(held[-1])
        due = timerValues.getCurrentProcessingTimeInMs() + self.wait
        self.last.update((*newest, due))
        self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.last.get()
        self.last.clear()
        if held:
            yield _FACTS(*held[:-1])

    def close(self) -> None:
        """Nothing is open."""


def quiet_files(files: DataFrame, wait: float) -> DataFrame:
    """``files`` (the stream of facts of a ``chunk_folder``) once they are quiet for ``wait`` seconds; each content once.

    The query must be started with a state store that keeps timers; see ``store_with_timers``.
    """
    processor = QuietFiles(round(wait * 1000))
    due = files.groupBy("path").transformWithState(processor, StructType.fromDDL(FILES), "append", "processingTime")
    return due.dropDuplicates(["data_version"])


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """What queries started meanwhile find in the session; a query takes its own copy of the settings when it starts."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store_with_timers(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries started meanwhile keep their state in a store that has timers."""
    return settings(spark, {_STORE: _ROCKS})


def watch_quiet(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], Any], wait: float = 5.0, interval: str = "1 second", glob: str = "chunk_*.csv", only_new: bool = False) -> StreamingQuery:
    """Runs ``handle`` on the facts of files that have become quiet, batch by batch, until the query is stopped.

    Batches also run where no file is new, the first after a restart too, so that timers go off. With ``only_new`` they run for new files
    alone: those that come together stay pending, however long their batch takes, until a later batch or a later run.
    """
    ship(spark)
    files = chunk_folder(spark, folder, glob, content="files", stream=True, ticks=not only_new)

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            handle(batch, number)

    writer = quiet_files(files, wait).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval)
    with store_with_timers(spark), settings(spark, {_EMPTY: str(not only_new).lower()}):
        return writer.start()
