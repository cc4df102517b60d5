"""Arriving files and arriving events.

``ArrivalPoller`` lists a folder and hashes contents: a copy under a new name is the same data, a file edited
in place is new. ``stream_arrivals`` and ``stream_contents`` are the low-latency way in: a stream of the folder's data source,
which brings edited files again. (``quiet`` adds the wait as stream state.) ``windowed_statistics`` and ``windowed_drift`` watch event streams.
"""

from __future__ import annotations

import fnmatch
import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.chunks import Chunk, CsvChunkSource, content_versions
from ..sources.folder_source import chunk_folder
from ..sources.registry import ModelRegistry
from ..sources.storage import FileFacts, join, name_of, storage_of

log = logging.getLogger(__name__)

@dataclass
class ArrivalPoller:
    """Files that have been quiet for ``debounce`` seconds and whose content no model was trained on."""

    source: CsvChunkSource
    registry: ModelRegistry
    debounce: float = 5.0
    seen: dict[str, FileFacts] = field(default_factory=dict)
    done: set[str] = field(default_factory=set)

    def due(self, now: float | None = None) -> list[str]:
        """Paths of quiet files with new content; a file is looked at again only when it changes or its run failed."""
        now = time.time() if now is None else now
        quiet = [f for f in self.source.facts() if self.seen.get(f.name) != f and now - f.changed >= self.debounce]
        versions = content_versions(self.source.spark, self.source.path, quiet)
        out = []
        for f in quiet:
            self.seen[f.name] = f
            v = versions[f.name]
            if v not in self.done and self.registry.find_by_data_version(v) is None:
                self.done.add(v)
                out.append(join(self.source.path, f.name))
        return out

    def failed(self, path: str, version: str) -> None:
        """The file is due again in the next round."""
        self.seen.pop(name_of(path), None)
        self.done.discard(version)

    def watch(self, run: Callable[[Chunk], Any], rounds: int | None = None, interval: float = 1.0) -> Iterator[Any]:
        """Runs every chunk that is due, in the order of names, again and again; one whose run raises is tried again."""
        n = 0
        while rounds is None or n < rounds:
            wanted = set(self.due())
            for chunk in self.source.chunks() if wanted else []:
                if chunk.path in wanted:
                    try:
                        result = run(chunk)
                    except Exception:
                        log.exception("the run of %s failed", chunk.path)
                        self.failed(chunk.path, chunk.data_version)
                        continue
                    yield result
            n += 1
            if rounds is None or n < rounds:
                time.sleep(interval)


def backfill(source: CsvChunkSource, run: Callable[[Chunk], Any]) -> list[Any]:
    """Every chunk once, in order; chunks already trained are skipped by the run itself."""
    return [run(c) for c in source.chunks()]


def unseen(versions: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of ``versions`` (data_version, ...) whose content no registered model was trained on."""
    known = registry.select(F.col("versions")["data"].alias("data_version")).distinct()
    return versions.join(known, "data_version", "left_anti").select(*versions.columns)


def new_contents(spark: SparkSession, folder: str, glob: str, registry: DataFrame) -> DataFrame:
    """(path, data_version) of files whose content isn't in the registry. Files too large for a row are hashed as streams."""
    found = [f for f in storage_of(folder).files(folder) if fnmatch.fnmatch(f.name, glob)]
    versions = content_versions(spark, folder, found)
    listed = spark.createDataFrame([(join(folder, n), v) for n, v in versions.items()], "path string, data_version string")
    return unseen(listed, registry)


def stream_arrivals(spark: SparkSession, folder: str, glob: str, checkpoint: str, handle: Callable[[str, str], Any], available_now: bool = True) -> StreamingQuery:
    """Hands (path, data_version) of files that are new or were edited in place to ``handle``, in the order of paths within a batch."""

    def each(batch: DataFrame, _: int) -> None:
        for r in batch.select("path", "data_version").orderBy("path").toLocalIterator():
            handle(r.path, r.data_version)

    writer = chunk_folder(spark, folder, glob, "files", stream=True).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()


def stream_contents(spark: SparkSession, folder: str, glob: str, checkpoint: str, out: str) -> StreamingQuery:
    """Appends the facts of files with content that no earlier file had to the Parquet table ``out``; what is there now, then it ends."""
    fresh = chunk_folder(spark, folder, glob, "files", stream=True).dropDuplicates(["data_version"])
    return fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_statistics(events: DataFrame, time_column: str, value: str, window: str, slide: str | None = None, watermark: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(start, by..., n, mean, std) of event-time windows; batch and streaming alike."""
    timed = events.withColumn("_t", F.col(time_column).cast("timestamp"))
    if watermark:
        timed = timed.withWatermark("_t", watermark)
    span = F.window("_t", window, slide) if slide else F.window("_t", window)
    out = timed.groupBy(span.alias("w"), *by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return out.select(F.col("w.start").alias("start"), *by, "n", "mean", "std")


def windowed_drift(statistics: DataFrame, mean: float, std: float) -> DataFrame:
    """How many reference deviations each window's mean is away; a labelled extension, cheap enough for streams."""
    return statistics.withColumn("shift", (F.col("mean") - F.lit(mean)) / F.lit(std if std > 0 else 1.0))
