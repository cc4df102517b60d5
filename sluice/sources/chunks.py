"""Units of arriving data: files that are read lazily, with a content identity and row ids."""

from __future__ import annotations

import csv
import fnmatch
import io
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, partial
from pathlib import Path
from typing import Any, Protocol
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.identity import content_hash, content_hash_column
from .storage import FileFacts, first_line, join, name_of, stem_of, storage_of

# The numeric columns of the molecular data sets that configurations name, and what counts as missing.
NUMERIC = (
    "A", "B", "C", "mu", "alpha", "homo", "lumo", "gap", "r2", "zpve", "u0", "u298", "h298", "g298", "cv", "u0_atom", "u298_atom", "h298_atom", "g298_atom",
)
MISSING = ("", "NA", "N/A", "n/a", "nan", "NaN", "NULL", "null", "None")


@dataclass
class Chunk:
    """One file's rows; ``data_version`` is a hash of its bytes, so a renamed copy is the same data.

    ``rows`` may be what reads them: numbering rows takes a look at all of them, which a run that skips the chunk doesn't need.
    """

    chunk_id: str
    path: str
    data_version: str
    rows: DataFrame | Callable[[], DataFrame]

    @cached_property
    def frame(self) -> DataFrame:
        return self.rows() if callable(self.rows) else self.rows

    @property
    def n_rows(self) -> int:
        return self.frame.count()


class Source(Protocol):
    kind: str

    def chunks(self) -> list[Chunk]: ...


def with_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """0-based positions in the order of the scan; only the number of rows of each partition passes through the driver."""
    marked = df.withColumn("_at", F.monotonically_increasing_id())
    part = F.shiftright("_at", 33)
    counts = sorted((r.p, r.n) for r in marked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for p, n in counts:
        starts.append((p, before))
        before += n
    at = F.col("_at").bitwiseAND((1 << 33) - 1)
    if len(starts) <= 1:
        return marked.withColumn(name, at.cast("long")).drop("_at")
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _start long")  # a row for each partition
    placed = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, (at + F.col("_start")).cast("long")).select(*df.columns, name)


def read_csv(spark: SparkSession, path: str | Path, numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """A CSV file with its header's columns: the named ones as doubles, all others as strings."""
    header = next(csv.reader([first_line(path)]), [])
    schema = StructType([StructField(c, DoubleType() if c in numeric else StringType()) for c in header])
    raw = spark.read.csv(str(path), header=True, schema=schema, mode="PERMISSIVE", enforceSchema=True)
    texts = {c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in header if c not in numeric}
    return with_row_ids(raw.withColumns(texts) if texts else raw)


#: Files up to this size are hashed by tasks, one file a row; larger ones are streamed through the driver.
HASHED_BY_TASKS = 512 << 20
Known = dict[str, tuple[FileFacts, str]]


def content_versions(spark: SparkSession, folder: str | Path, files: Sequence[FileFacts], known: Known | None = None) -> dict[str, str]:
    """Content hashes of files of a folder, in one job.

    A file in ``known`` isn't read again if its stamp is the same, which no edit can keep; without stamps all are read. ``known`` then
    holds the given files and no others.
    """
    known = {} if known is None else known
    same = {f.name: known[f.name][1] for f in files if f.stamp is not None and f.name in known and known[f.name][0] == f}
    fresh = [f for f in files if f.name not in same]
    small = [f for f in fresh if f.size <= HASHED_BY_TASKS]
    if len(small) > 1:
        read = spark.read.format("binaryFile").load([join(folder, f.name) for f in small])
        same |= {unquote(name_of(r.path)): r.v for r in read.select("path", content_hash_column(F.col("content")).alias("v")).collect()}
    found = {f.name: same.get(f.name) or content_hash(join(folder, f.name)) for f in files}
    known.clear()
    known.update({f.name: (f, found[f.name]) for f in files})
    return found


@dataclass
class CsvChunkSource:
    """All files of a folder, in the order of their names."""

    spark: SparkSession
    path: str | Path
    glob: str = "chunk_*.csv"
    numeric: Sequence[str] = NUMERIC
    kind: str = "csv_chunks"
    known: Known = field(default_factory=dict, repr=False)

    def facts(self) -> list[FileFacts]:
        store = storage_of(self.path)
        if not store.is_folder(self.path):
            raise FileNotFoundError(f"no folder {self.path}")
        return [f for f in store.files(self.path) if fnmatch.fnmatch(f.name, self.glob)]

    def read(self, path: str) -> DataFrame:
        return read_csv(self.spark, path, self.numeric)

    def chunks(self) -> list[Chunk]:
        files = self.facts()
        versions = content_versions(self.spark, self.path, files, self.known)
        return [Chunk(stem_of(f.name), join(self.path, f.name), versions[f.name], partial(self.read, join(self.path, f.name))) for f in files]


@dataclass
class ParquetChunkSource(CsvChunkSource):
    """The same for Parquet files."""

    glob: str = "chunk_*.parquet"
    kind: str = "parquet_chunks"

    def read(self, path: str) -> DataFrame:
        return with_row_ids(self.spark.read.parquet(path))


@dataclass
class CsvBatchSource:
    """One file."""

    spark: SparkSession
    path: str | Path
    numeric: Sequence[str] = NUMERIC
    kind: str = "csv_batch"

    def chunks(self) -> list[Chunk]:
        if not storage_of(self.path).exists(self.path):
            raise FileNotFoundError(f"no file {self.path}")
        return [Chunk(stem_of(self.path), str(self.path), content_hash(self.path), read_csv(self.spark, self.path, self.numeric))]


def source_from_config(spark: SparkSession, cfg: Mapping[str, Any]) -> Source:
    numeric = tuple(cfg.get("numeric", NUMERIC))
    kind = cfg.get("kind")
    if kind == "csv_chunks":
        return CsvChunkSource(spark, cfg["path"], cfg.get("glob", "chunk_*.csv"), numeric)
    if kind == "parquet_chunks":
        return ParquetChunkSource(spark, cfg["path"], cfg.get("glob", "chunk_*.parquet"), numeric)
    if kind == "csv_batch":
        return CsvBatchSource(spark, cfg["path"], numeric)
    raise ValueError(f"unknown source kind {kind!r}; known: csv_chunks, parquet_chunks, csv_batch")


def union_frames(frames: Mapping[str, DataFrame], name: str = "chunk_id") -> DataFrame:
    """Frames as one, with the key of each in a column; columns that a frame lacks are null."""
    out: DataFrame | None = None
    for key, frame in frames.items():
        part = frame.withColumn(name, F.lit(key))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames")
    return out


def load_chunks(spark: SparkSession, path: str | Path, glob: str = "chunk_*.csv") -> DataFrame:
    """All chunks of a folder as one frame with ``chunk_id``."""
    chunks = CsvChunkSource(spark, path, glob).chunks()
    if not chunks:
        raise FileNotFoundError(f"no chunks in {path}")
    return union_frames({c.chunk_id: c.frame for c in chunks})


def write_csv(df: DataFrame, path: str | Path, order: Sequence[str] = ()) -> str:
    """One CSV file with a header, sorted; for results that people read.

    Ranges of the order are sorted and written by tasks of their own, to a folder beside ``path`` on storage that the executors share, and the
    file system joins the parts. A part with rows that doesn't arrive there is an error, never a shorter result.
    """
    store, aside = storage_of(path), f"{str(path).rstrip('/')}.parts"
    target = str(path) if ":/" in str(path) else f"file://{Path(path).resolve()}"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    (part,) = [c for c in ("_part", "__part", "___part") if c not in df.columns][:1]
    seen = Observation()
    marked = dealt.withColumn(part, F.spark_partition_id()).observe(seen, F.collect_set(part).alias("numbers")).drop(part)
    marked.write.mode("overwrite").csv(f"{target}.parts")
    names = {int(f.name[5:10]): f.name for f in store.files(aside) if f.name.startswith("part-")} if store.is_folder(aside) else {}
    wanted = sorted(seen.get["numbers"])
    if missing := [n for n in wanted if n not in names]:
        raise OSError(f"parts {missing} of {path} were not written where this process can see them; use shared storage")
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)
    store.write(join(aside, "header"), header.getvalue().encode())
    store.concatenate([join(aside, n) for n in ("header", *(names[k] for k in wanted))], path)
    store.remove(aside)
    return str(path)


def prepare_dataset(df: DataFrame, out: str | Path, targets: Sequence[str], n_candidates: int = 300) -> None:
    """Chunks, golden set and unlabelled candidates of rows that ``split_into_chunks`` has dealt."""
    rows = df.drop("position")
    rows.filter("not golden").drop("golden").write.mode("overwrite").partitionBy("chunk").parquet(join(out, "chunks"))
    write_csv(rows.filter("golden").drop("golden", "chunk"), join(out, "golden.csv"), ["row_id"])
    last = df.agg(F.max("chunk")).first()[0]
    batch = df.filter((F.col("chunk") == last) & ~F.col("golden")).orderBy("position").limit(n_candidates)
    numbered = with_row_ids(batch.coalesce(1).orderBy("position"), "_n")
    write_csv(numbered.select(F.format_string("cand-%04d", "_n").alias("candidate_id"), *(c for c in rows.columns if c not in (*targets, "golden", "chunk", "row_id"))), join(out, "candidates.csv"), ["candidate_id"])
