import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from sluice import arrival_queries
from sluice.sources.chunks import CsvChunkSource, content_versions
from sluice.sources.folder_source import chunk_folder
from sluice.sources.registry import ModelRegistry
from sluice.streaming.arrival import ArrivalPoller, backfill, stream_contents
from sluice.streaming.quiet import watch_quiet


def put(folder, name, text):
    (folder / name).write_bytes(text.encode())


def edit_unseen(folder, name, text):
    """Another content of the same length and with the old time."""
    old = os.stat(folder / name)
    assert old.st_size == len(text)
    put(folder, name, text)
    os.utime(folder / name, ns=(old.st_atime_ns, old.st_mtime_ns))


def version(text):
    return f"sha256:{hashlib.sha256(text.encode()).hexdigest()[:16]}"


@pytest.fixture
def chunks(tmp_path):
    where = tmp_path / "chunks"
    where.mkdir()
    put(where, "chunk_0.csv", 'name,gap\nA,1.5\nNA,x\n"q,\nz",\n')
    put(where, "chunk_1.csv", "name,other\nB,3\n")
    put(where, "chunk_2.csv", "")
    put(where, ".chunk_3.csv", "half")
    put(where, "notes.csv", "no,chunk\n")
    return where


def test_rows_of_all_chunks(spark, chunks):
    found = chunk_folder(spark, str(chunks), numeric=["gap"], missing=["", "NA"])
    assert found.columns == ["chunk_id", "data_version", "row_id", "name", "gap", "other"] and dict(found.dtypes)["gap"] == "double"
    rows = sorted(tuple(r) for r in found.drop("data_version").collect())
    assert rows == [("chunk_0", 0, "A", 1.5, None), ("chunk_0", 1, None, None, None), ("chunk_0", 2, "q,\nz", None, None), ("chunk_1", 0, "B", None, "3")]
    assert {r.data_version for r in found.filter("chunk_id = 'chunk_1'").collect()} == {version("name,other\nB,3\n")}
    files = chunk_folder(spark, str(chunks), content="files").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.bytes) for r in files] == [("chunk_0", 28), ("chunk_1", 15), ("chunk_2", 0)]
    put(chunks, "chunk_4.csv", "a,b\n1,2,3\n1\n")
    with pytest.raises(Exception, match="length|fields"):
        chunk_folder(spark, str(chunks)).collect()


def test_many_rows_keep_their_places(spark, tmp_path):
    spark.range(25_001).select("id", F.col("id").cast("string").alias("text")).coalesce(1).write.parquet(str(tmp_path / "p"))
    (part,) = [p for p in (tmp_path / "p").iterdir() if p.name.endswith(".parquet")]
    part.rename(tmp_path / "p" / "chunk_0.parquet")
    found = chunk_folder(spark, str(tmp_path / "p"), "chunk_*.parquet")
    assert found.filter("id = row_id and text = string(id)").count() == 25_001 and dict(found.dtypes)["id"] == "bigint"


def test_options(spark, tmp_path, chunks):
    with pytest.raises(Exception, match="no folder"):
        chunk_folder(spark, str(tmp_path / "none")).collect()
    with pytest.raises(Exception, match="rows or files"):
        chunk_folder(spark, str(chunks), content="bytes").collect()
    early = spark.read.format("chunk_folder").options(path=str(chunks), upto="chunk_0").load()
    assert {r.chunk_id for r in early.collect()} == {"chunk_0"}


def test_stream_brings_edits_and_no_copies(spark, tmp_path, chunks):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def arrived():
        stream_contents(spark, str(chunks), "chunk_*.csv", progress, out).awaitTermination()
        return sorted((r.chunk_id, r.data_version) for r in spark.read.parquet(out).collect())

    first = arrived()
    assert [c for c, _ in first] == ["chunk_0", "chunk_1", "chunk_2"] and arrived() == first
    edit_unseen(chunks, "chunk_1.csv", "name,other\nC,3\n")
    put(chunks, "chunk_9.csv", "name,other\nB,3\n")  # what chunk_1 was
    assert arrived() == sorted([*first, ("chunk_1", version("name,other\nC,3\n"))])


def test_hashes_are_not_remembered_by_time_and_size(spark, chunks):
    source = CsvChunkSource(spark, chunks)
    before = {c.chunk_id: c.data_version for c in source.chunks()}
    assert set(source.known) == {"chunk_0.csv", "chunk_1.csv", "chunk_2.csv"}
    edit_unseen(chunks, "chunk_1.csv", "name,other\nD,4\n")
    (chunks / "chunk_2.csv").unlink()
    after = {c.chunk_id: c.data_version for c in source.chunks()}
    assert after["chunk_1"] == version("name,other\nD,4\n") != before["chunk_1"] and after["chunk_0"] == before["chunk_0"]
    assert set(source.known) == {"chunk_0.csv", "chunk_1.csv"}  # and nothing is kept of files that have gone
    facts = source.facts()
    known = {f.name: (f, "remembered") for f in facts}
    assert set(content_versions(spark, chunks, facts, known).values()) == {"remembered"}


def test_poller_and_backfill(spark, tmp_path, chunks):
    source = CsvChunkSource(spark, chunks)
    poller = ArrivalPoller(source, ModelRegistry(tmp_path / "registry"), debounce=0.0)
    assert [p.rpartition("/")[2] for p in poller.due()] == ["chunk_0.csv", "chunk_1.csv", "chunk_2.csv"] and poller.due() == []
    edit_unseen(chunks, "chunk_1.csv", "name,other\nE,5\n")
    put(chunks, "chunk_5.csv", "name,other\nE,5\n")
    assert [p.rpartition("/")[2] for p in poller.due()] == ["chunk_1.csv"]
    assert backfill(source, lambda c: c.chunk_id) == ["chunk_0", "chunk_1", "chunk_2", "chunk_5"]


def test_pending_files_survive_a_restart(spark, tmp_path, chunks):
    seen = []

    def watch(wait, until):
        query = watch_quiet(spark, str(chunks), str(tmp_path / "progress"), lambda b, _: seen.extend((r.chunk_id, r.data_version) for r in b.collect()), wait, "0 seconds")
        end = time.monotonic() + 60
        while not until(query) and time.monotonic() < end:
            time.sleep(0.05)
        query.stop()

    watch(20.0, lambda q: sum(p.numInputRows for p in q.recentProgress) >= 3)
    assert seen == []
    edit_unseen(chunks, "chunk_1.csv", "name,other\nF,6\n")  # before it was due: only the last content counts
    put(chunks, "chunk_7.csv", "name,other\nF,6\n")
    watch(2.0, lambda _: len(seen) >= 3)
    assert len(seen) == 3 and {v for _, v in seen} == {version('name,gap\nA,1.5\nNA,x\n"q,\nz",\n'), version("name,other\nF,6\n"), version("")}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_slow_batches_leave_files_pending(spark, monkeypatch):
    """Files are overdue by the time the first batch ends, as on a slow machine; and everything is committed when the query is stopped."""
    asked, sleep = [], time.sleep

    def hasty(*args, **options):
        first = not asked
        asked.append(args[4])
        return watch_quiet(*args[:4], 0.001 if first else args[4], *args[5:], **options)

    monkeypatch.setattr(arrival_queries, "watch_quiet", hasty)
    monkeypatch.setattr(time, "sleep", lambda s: sleep(20.0 * s))
    found = arrival_queries.quiet_chunks(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 7 and {(r.times, r.pending) for r in found} == {(1, True)} and asked == [12.0, 1.0]
