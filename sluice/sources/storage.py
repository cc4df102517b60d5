"""Small files on any file system that Spark can open; local paths need no session."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

_BLOCK = 1 << 20


@dataclass(frozen=True)
class FileFacts:
    """A file's name, when it was changed (in seconds), its size, and what no edit can keep, where the file system has that."""

    name: str
    changed: float
    size: int
    stamp: tuple[int, int] | None = None


def join(base: str | Path, *parts: str) -> str:
    return "/".join([str(base).rstrip("/"), *parts])


def absolute(path: str | Path) -> str:
    """A local path from the root; others as they are."""
    return str(path) if ":/" in str(path) else str(Path(path).resolve())


def name_of(path: str | Path) -> str:
    return str(path).rstrip("/").rpartition("/")[2]


def stem_of(path: str | Path) -> str:
    name = name_of(path)
    return name.rpartition(".")[0] or name


class LocalStorage:
    """Paths without a scheme, or with ``file:``."""

    @staticmethod
    def _at(path: str | Path) -> Path:
        text = str(path)
        return Path(text.removeprefix("file:").replace("//", "/", 1) if text.startswith("file:") else text)

    def exists(self, path: str | Path) -> bool:
        return self._at(path).exists()

    def files(self, folder: str | Path) -> list[FileFacts]:
        """Files by name; hidden ones are those that are still being written."""
        found = [(p.name, p.stat()) for p in self._at(folder).iterdir() if not p.name.startswith(".") and p.is_file()]
        return sorted((FileFacts(n, s.st_mtime, s.st_size, (s.st_ctime_ns, s.st_ino)) for n, s in found), key=lambda f: f.name)

    def is_folder(self, path: str | Path) -> bool:
        return self._at(path).is_dir()

    def blocks(self, path: str | Path) -> Iterator[bytes]:
        with self._at(path).open("rb") as f:
            yield from iter(lambda: f.read(_BLOCK), b"")

    def write(self, path: str | Path, data: bytes) -> None:
        """Written aside, synced, and moved to its place."""
        p = self._at(path)
        p.parent.mkdir(parents=True, exist_ok=True)
        aside = self._aside(p, data)
        os.replace(aside, p)

    @staticmethod
    def _aside(p: Path, data: bytes) -> str:
        handle, aside = tempfile.mkstemp(dir=p.parent, prefix=f".{p.name}.")
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        return aside

    def create(self, path: str | Path, data: bytes) -> bool:
        """Writes a file that isn't there yet, as a whole; False if it is."""
        p = self._at(path)
        p.parent.mkdir(parents=True, exist_ok=True)
        aside = self._aside(p, data)
        try:
            os.link(aside, p)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True

    def move(self, source: str | Path, target: str | Path) -> None:
        self._at(target).parent.mkdir(parents=True, exist_ok=True)
        os.replace(self._at(source), self._at(target))

    def concatenate(self, sources: Sequence[str], target: str | Path) -> None:
        """The files one after the other, in blocks, as a file that appears when it is whole."""
        p = self._at(target)
        p.parent.mkdir(parents=True, exist_ok=True)
        handle, aside = tempfile.mkstemp(dir=p.parent, prefix=f".{p.name}.")
        with os.fdopen(handle, "wb") as f:
            for source in sources:
                with self._at(source).open("rb") as part:
                    shutil.copyfileobj(part, f, _BLOCK)
            f.flush()
            os.fsync(f.fileno())
        os.replace(aside, p)

    def remove(self, path: str | Path) -> None:
        p = self._at(path)
        if p.is_dir():
            shutil.rmtree(p)
        elif p.exists():
            p.unlink()

    def copy_folder(self, source: str | Path, target: str | Path) -> None:
        shutil.copytree(self._at(source), self._at(target), dirs_exist_ok=True)


class HadoopStorage:
    """Paths of any other scheme, through the session's Hadoop libraries."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _open(self, path: str | Path):
        p = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return p.getFileSystem(self._conf), p

    def exists(self, path: str | Path) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def is_folder(self, path: str | Path) -> bool:
        fs, p = self._open(path)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def files(self, folder: str | Path) -> list[FileFacts]:
        fs, p = self._open(folder)
        found = [FileFacts(x.getPath().getName(), x.getModificationTime() / 1000, x.getLen()) for x in fs.listStatus(p) if x.isFile() and not x.getPath().getName().startswith(".")]
        return sorted(found, key=lambda f: f.name)

    def blocks(self, path: str | Path) -> Iterator[bytes]:
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            while len(block := bytes(stream.readNBytes(_BLOCK))):
                yield block
        finally:
            stream.close()

    def _put(self, path: str | Path, data: bytes, overwrite: bool) -> None:
        fs, p = self._open(path)
        stream = fs.create(p, overwrite)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def write(self, path: str | Path, data: bytes) -> None:
        aside = f"{path}.{os.urandom(6).hex()}.part"
        self._put(aside, data, True)
        self.move(aside, path)

    def create(self, path: str | Path, data: bytes) -> bool:
        """The file appears when it is created, before its content; readers must know an incomplete one."""
        try:
            self._put(path, data, False)
        except Exception:
            if self.exists(path):
                return False
            raise
        return True

    def move(self, source: str | Path, target: str | Path) -> None:
        """In place of what is there, by one rename, so that readers find the one or the other."""
        fs, a = self._open(source)
        _, b = self._open(target)
        fs.mkdirs(b.getParent())
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(a, b, options)

    def concatenate(self, sources: Sequence[str], target: str | Path) -> None:
        """By the file system itself where it can, else copied in blocks within the JVM."""
        fs, first = self._open(sources[0])
        rest = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Path, len(sources) - 1)
        for k, source in enumerate(sources[1:]):
            rest[k] = self._open(source)[1]
        if len(rest):
            try:
                fs.concat(first, rest)
            except Exception as e:
                if "UnsupportedOperationException" not in str(e):
                    raise
                whole = self._open(f"{sources[0]}.whole")[1]
                out = fs.create(whole, True)
                try:
                    for source in sources:
                        stream = fs.open(self._open(source)[1])
                        try:
                            stream.transferTo(out)
                        finally:
                            stream.close()
                finally:
                    out.close()
                first = whole
        self.move(first.toString(), target)

    def remove(self, path: str | Path) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def copy_folder(self, source: str | Path, target: str | Path) -> None:
        a, p = self._open(source)
        b, q = self._open(target)
        b.mkdirs(q)
        for x in a.listStatus(p):
            self._jvm.org.apache.hadoop.fs.FileUtil.copy(a, x.getPath(), b, q, False, True, self._conf)


Storage = LocalStorage | HadoopStorage


def storage_of(path: str | Path) -> Storage:
    """What opens a path; a remote one needs an active session."""
    text = str(path)
    if ":/" not in text or text.startswith("file:"):
        return LocalStorage()
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError(f"{text} needs a session")
    return HadoopStorage(spark)


def read_bytes(path: str | Path) -> bytes:
    return b"".join(storage_of(path).blocks(path))


def first_line(path: str | Path) -> str:
    held = b""
    for block in storage_of(path).blocks(path):
        held += block
        if b"\n" in held:
            break
    return held.decode("utf-8-sig", errors="replace").splitlines()[0] if held.strip() else ""


def sha256_of(path: str | Path) -> str:
    digest = hashlib.sha256()
    for block in storage_of(path).blocks(path):
        digest.update(block)
    return digest.hexdigest()
