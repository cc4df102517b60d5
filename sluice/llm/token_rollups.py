"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is a row (source, lang, tokenizer_version, n_docs, n_tokens) whose numbers are added to the
totals: an insert is positive, a delete negative, a revised count is the new one less the old one. A batch of
changes is summed by key and committed under its id: it is written aside and then renamed to its place,
so it is there as a whole or not at all, and a batch that is delivered again changes nothing. The totals are
the sum of all committed batches; compaction merges batches into one table and remembers their ids.

Tokens are counted by the tokenizers of VERSIONS: two public vocabularies, words, and bytes.

Defined results: null sources and languages are keys of their own; a null or empty text is a document
without tokens; texts of any length are counted whole; repeated rows are counted as often as they occur; keys whose
documents have all been deleted are left out of the totals; without batches the totals are empty; columns of documents
other than doc_id, text, source and lang are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, packing
from .session import settle, ship, work_dir
from .textops import blocks, text_buffers, word_spans

KEYS = ["source", "lang", "tokenizer_version"]
_SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


class TokenRollups:
    """The committed batches below ``path``, a folder that driver and executors share; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        self._at = lambda *parts: jvm_path("/".join([self.path, *parts]))
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())
        for part in ("batches", "staging", "merged"):
            self._fs.mkdirs(self._at(part))

    def _names(self, part: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._at(part)))

    def _merged(self) -> tuple[str | None, set[str]]:
        """The last complete compaction and the batches in it."""
        names = self._names("merged")
        if not names:
            return None, set()
        ids = self.spark.read.schema("batch_id string").json(f"{self.path}/merged/{names[-1]}/ids").collect()
        return names[-1], {r.batch_id for r in ids}

    def committed(self) -> set[str]:
        return {x.removeprefix("batch_id=") for x in self._names("batches")} | self._merged()[1]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Adds a batch; False, without any work, if the id was committed before."""
        if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id):
            raise ValueError("a batch id has letters, digits, dots, hyphens and underscores only")
        if batch_id in self.committed():
            return False
        summed = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        aside = f"staging/{uuid.uuid4().hex}"
        summed.coalesce(1).write.parquet(f"{self.path}/{aside}")
        if not self._fs.rename(self._at(aside), self._at("batches", f"batch_id={batch_id}")):
            raise RuntimeError(f"batch {batch_id} could not be put in its place")
        return True

    def _sum(self) -> DataFrame:
        last, inside = self._merged()
        parts = [f"{self.path}/batches/{x}" for x in self._names("batches") if x.removeprefix("batch_id=") not in inside]
        if last:
            parts.append(f"{self.path}/merged/{last}/totals")
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        every = self.spark.read.schema(_SCHEMA).parquet(*parts)
        return every.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        return self._sum().filter(F.col("n_docs") > 0)

    def compact(self) -> None:
        """Merges all batches in one table; those merged are removed only after it is in its place."""
        last, _ = self._merged()
        ids = sorted(self.committed())
        name, aside = f"{int(last or 0) + 1:010d}", f"staging/{uuid.uuid4().hex}"
        self._sum().coalesce(1).write.parquet(f"{self.path}/{aside}/totals")
        self.spark.createDataFrame([(x,) for x in ids], "batch_id string").coalesce(1).write.json(f"{self.path}/{aside}/ids")
        if not self._fs.rename(self._at(aside), self._at("merged", name)):
            raise RuntimeError("the compacted table could not be put in its place")
        for x in self._names("batches"):
            if x.removeprefix("batch_id=") in ids:
                self._fs.delete(self._at("batches", x), True)
        if last:
            self._fs.delete(self._at("merged", last), True)


Counter = Callable[[pa.Array], Iterator[int]]


def count_words(column: pa.Array) -> Iterator[int]:
    offsets, data = text_buffers(column)
    for i, j in blocks(offsets):
        _, _, rows = word_spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        yield from np.bincount(rows, minlength=j - i).tolist()


def count_bytes(column: pa.Array) -> Iterator[int]:
    return iter(np.diff(text_buffers(column)[0]).tolist())


def count_word_bpe(column: pa.Array) -> Iterator[int]:
    return (len(ids) - 1 for ids in packing.document_ids(column, public_tokenizers.path("word_bpe_49k.json")))


def count_byte_bpe(column: pa.Array) -> Iterator[int]:
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return (len(ids) for ids in byte_bpe.encode_batch(column, codec))


#: The tokenizers by version.
VERSIONS: dict[str, Counter] = {"byte_bpe_multi_50k": count_byte_bpe, "bytes-1": count_bytes, "word_bpe_49k": count_word_bpe, "words-1": count_words}


def count_texts(docs: DataFrame, versions: dict[str, Counter] | None = None) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens) of every row's whole text."""
    ship(docs.sparkSession)
    counters = versions or VERSIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for version, counter in counters.items():
                counts = pa.array([*counter(batch.column(3))], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * batch.num_rows, pa.string()), counts], names=["doc_id", *KEYS, "n_tokens"])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text"))]
    return docs.select(*columns).mapInArrow(run, "doc_id long, source string, lang string, tokenizer_version string, n_tokens long")


def changes(counted: DataFrame, docs: int, sign: int) -> DataFrame:
    """A change for each row: ``docs`` documents and its tokens, both with their sign."""
    return counted.select(*KEYS, F.lit(docs).cast("long").alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens"))


def maintained_totals(docs: DataFrame, labels: DataFrame, versions: dict[str, Counter] | None = None) -> DataFrame:
    """Totals after three batches: all documents are inserted, those labelled toxic (and not of low quality)
    are revised to their first line, those labelled of low quality are deleted; every batch is delivered twice."""
    spark = docs.sparkSession
    path = work_dir(spark, "token-rollups")
    counted = settle(count_texts(docs, versions), f"{path}/counts")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    flags = labels.select(doc_id, "quality", "toxic").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("low"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    low = flags.filter("low = 1").select("doc_id")
    revised = flags.filter("toxic = 1 and coalesce(low, 0) = 0").select("doc_id")

    def revision() -> DataFrame:
        first_lines = docs.select(doc_id, "source", "lang", F.substring_index(F.col("text").cast("string"), "\n", 1).alias("text"))
        new = count_texts(first_lines.join(revised, "doc_id", "left_semi"), versions)
        return changes(new, 0, 1).unionByName(changes(counted.join(revised, "doc_id", "left_semi"), 0, -1))

    store = TokenRollups(spark, f"{path}/store")
    batches = [
        ("insert", lambda: changes(counted, 1, 1)),
        ("revise", revision),
        ("delete", lambda: changes(counted.join(low, "doc_id", "left_semi"), -1, -1)),
    ]
    for name, batch in batches[:2]:
        store.commit(name, batch())
        store.commit(name, batch())
    store.compact()
    for name, batch in batches:
        store.commit(name, batch())
    return store.totals()
