"""A folder of chunk files as a Spark data source, for batches and for streams.

``spark.read.format("chunk_folder")`` gives the rows of all chunks with ``chunk_id``, ``data_version`` (a hash of the file's bytes) and
``row_id`` (the row's place in its file); with ``option("content", "files")`` one row for each file. ``spark.readStream`` gives the same of
files that are new or have changed: a stream's offset holds every file's stamp, so one that is edited in place comes again, with another
version. Stamps include the time of the last change to the file's entry, which can't be set, where the file system has one.

The driver lists names and stamps and reads header lines; contents are hashed and parsed by the tasks, one file each, in pieces.
With the option ``ticks`` a stream's offset also holds the time, so that its batches go on where no file is new. The option ``upto`` leaves out later chunks before any file is opened. Paths are those that Arrow opens: mounted ones, and s3, gs, abfs or hdfs.

A column that a file lacks is null, as are the fixed tokens for missing values and numbers that can't be read; a row with too many
fields is an error. A file that has gone when its task reads it gives no rows.
"""

from __future__ import annotations

import fnmatch
import hashlib
import os
import time
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.shipping import ship

NAME = "chunk_folder"
FILES = "chunk_id string, path string, data_version string, bytes long, changed timestamp"
_BLOCK, _ROWS = 1 << 20, 10_000
_OWN = ("chunk_id", "data_version", "row_id")
_TICK = ""  # no file's name


@dataclass(frozen=True)
class File(InputPartition):
    name: str
    stamp: str

    @property
    def chunk_id(self) -> str:
        return self.name.rpartition(".")[0] or self.name


class Folder:
    """What the options name; opened anew wherever it is used."""

    def __init__(self, options: Any) -> None:
        if "path" not in options:
            raise ValueError("the option path is missing")
        self.path, self.glob, self.content = options["path"], options.get("glob", "chunk_*.csv"), options.get("content", "rows")
        self.numeric = tuple(n for n in options.get("numeric", "").split(",") if n)
        self.upto, self.ticks = options.get("upto"), options.get("ticks", "false") == "true"
        self.missing = tuple(options.get("missing", "").split(","))
        if self.content not in ("rows", "files"):
            raise ValueError(f"content must be rows or files, not {self.content!r}")

    def opened(self) -> tuple[pafs.FileSystem, str]:
        if ":/" in self.path:
            return pafs.FileSystem.from_uri(self.path)
        return pafs.LocalFileSystem(), os.path.abspath(self.path)

    def at(self, file: File) -> str:
        return f"{self.path.rstrip('/')}/{file.name}"

    def files(self) -> list[File]:
        """By name; hidden files are those that are still being written."""
        fs, base = self.opened()
        if fs.get_file_info(base).type != pafs.FileType.Directory:
            raise FileNotFoundError(f"no folder {self.path}")
        found = []
        for info in fs.get_file_info(pafs.FileSelector(base)):
            if info.type == pafs.FileType.File and not info.base_name.startswith(".") and fnmatch.fnmatch(info.base_name, self.glob):
                own = os.stat(info.path) if isinstance(fs, pafs.LocalFileSystem) else None
                found.append(File(info.base_name, f"{info.mtime_ns}-{info.size}" + (f"-{own.st_ctime_ns}-{own.st_ino}" if own else "")))
        return sorted(found, key=lambda f: f.name)

    def columns(self) -> StructType:
        """All columns of all files, in the order of the files' names."""
        fs, base = self.opened()
        fields: dict[str, pa.DataType] = {}
        for file in self.files():
            for name, kind in self._header(fs, f"{base}/{file.name}"):
                fields.setdefault(name, kind)
        own = [("chunk_id", pa.string()), ("data_version", pa.string()), ("row_id", pa.int64())]
        return from_arrow_schema(pa.schema([*own, *((n, k) for n, k in fields.items() if n not in _OWN)]))

    def _header(self, fs: pafs.FileSystem, path: str) -> list[tuple[str, pa.DataType]]:
        if path.endswith(".parquet"):
            return [(f.name, f.type) for f in pq.read_schema(path, filesystem=fs)]
        with fs.open_input_stream(path) as stream:
            names = pd.read_csv(stream, nrows=0, dtype=str).columns if fs.get_file_info(path).size else []
        return [(n, pa.float64() if n in self.numeric else pa.string()) for n in names]

    def facts(self, file: File) -> pa.RecordBatch | None:
        fs, base = self.opened()
        digest, size = hashlib.sha256(), 0
        try:
            with fs.open_input_stream(f"{base}/{file.name}") as stream:
                while block := stream.read(_BLOCK):
                    digest.update(block)
                    size += len(block)
            changed = fs.get_file_info(f"{base}/{file.name}").mtime
        except FileNotFoundError:
            return None
        version = f"sha256:{digest.hexdigest()[:16]}"
        arrays = [pa.array([x]) for x in (file.chunk_id, self.at(file), version, size)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([changed], pa.timestamp("us", "UTC"))], names=["chunk_id", "path", "data_version", "bytes", "changed"])

    def rows(self, file: File, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        facts = self.facts(file)
        if facts is None or not facts.column(3)[0].as_py():
            return
        version, at = facts.column(2)[0].as_py(), 0
        for table in self._pieces(f"{self.opened()[1]}/{file.name}"):
            n = table.num_rows
            own = {"chunk_id": pa.array([file.chunk_id] * n), "data_version": pa.array([version] * n), "row_id": pa.array(range(at, at + n), pa.int64())}
            at += n
            found = [own.get(f.name) if f.name in own else self._fitted(table, f) for f in schema]
            yield pa.RecordBatch.from_arrays(found, schema=schema)

    def _pieces(self, path: str) -> Iterator[pa.Table]:
        fs, _ = self.opened()
        with fs.open_input_file(path) as stream:
            if path.endswith(".parquet"):
                for batch in pq.ParquetFile(stream).iter_batches(_ROWS):
                    yield pa.Table.from_batches([batch])
            else:
                yield from self._parsed(stream)

    def _parsed(self, stream: pa.NativeFile) -> Iterator[pa.Table]:
        with warnings.catch_warnings(), pd.read_csv(stream, dtype=str, keep_default_na=False, na_values=list(self.missing), chunksize=_ROWS, index_col=False) as frames:
            warnings.simplefilter("error", pd.errors.ParserWarning)  # which pandas gives where it leaves out fields
            for frame in frames:
                yield pa.table({c: pa.array(frame[c], pa.string(), from_pandas=True) for c in frame.columns})

    @staticmethod
    def _fitted(table: pa.Table, field: pa.Field) -> pa.Array:
        """A column in the wanted type; numbers that can't be read are null."""
        if field.name not in table.column_names:
            return pa.nulls(table.num_rows, field.type)
        column = table.column(field.name).combine_chunks()
        if pa.types.is_string(column.type) and not pa.types.is_string(field.type):
            numbers = pd.to_numeric(column.to_pandas(), errors="coerce")
            return pa.array(numbers, from_pandas=True).cast(field.type, safe=False)
        return column.cast(field.type)


class _Files:
    """Reading of files by tasks, for batches and streams."""

    def __init__(self, options: Any, schema: StructType) -> None:
        self.folder, self.schema = Folder(options), schema

    def read(self, file: File) -> Iterator[pa.RecordBatch]:
        if self.folder.content == "files":
            facts = self.folder.facts(file)
            yield from [] if facts is None else [facts]
        else:
            yield from self.folder.rows(file, to_arrow_schema(self.schema))


class FolderReader(_Files, DataSourceReader):
    """Every file, or those up to a chunk."""

    def partitions(self) -> Sequence[InputPartition]:
        return [f for f in self.folder.files() if self.folder.upto is None or f.chunk_id <= self.folder.upto]


class FolderStream(_Files, DataSourceStreamReader):
    """Files whose stamps differ from those of the last offset."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {f.name: f.stamp for f in self.folder.files()} | ({_TICK: str(time.time_ns())} if self.folder.ticks else {})

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [File(name, stamp) for name, stamp in sorted(end.items()) if name != _TICK and start.get(name) != stamp]

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the checkpoint."""


class ChunkFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType | str:
        folder = Folder(self.options)
        return FILES if folder.content == "files" else folder.columns()

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FolderStream(self.options, schema)


def chunk_folder(spark: SparkSession, path: str, glob: str = "chunk_*.csv", content: str = "rows", numeric: Sequence[str] = (), missing: Sequence[str] = ("",), stream: bool = False, ticks: bool = False) -> DataFrame:
    """The data source, registered in this session and sent to its tasks."""
    ship(spark)
    spark.dataSource.register(ChunkFolder)
    reader = (spark.readStream if stream else spark.read).format(NAME)
    options = {"path": str(path), "glob": glob, "content": content, "numeric": ",".join(numeric), "missing": ",".join(missing), "ticks": str(ticks).lower()}
    return reader.options(**options).load()
