"""Repeated lines across documents, found with levelled sorted runs of line hashes; built-in functions only.

Batches of documents are taken from the largest doc_ids down. A batch's line keys, with the number of
its documents that hold each and the largest of them, form a run: a table bucketed and sorted by key. The run is
merge-anti-joined with the older runs, bucket by bucket, without another shuffle or sort: keys that none of them has
are new, and their largest holder in the batch is the corpus's last one. Runs are kept in levels; as soon as a level
has FANOUT runs they are merged into one of the next level. In the end the merged counts tell which keys are frequent;
a frequent line goes unless its document is the key's last holder.

The runs lie in a folder, levels and all, and can be opened again: ``drop_known_lines`` takes a later batch, drops
the lines that the runs know, and adds the batch's own.

Keys are two 64-bit hashes of the stripped, lower-cased line. Only hashes are shuffled until the last
join, which brings the places of the dropped lines back to the texts.

Defined results: a null or empty text is one empty line; texts of any length are read whole; a null doc_id is no
document for the counts and never a last holder; rows with the same doc_id count as one document but keep their own
lines; in the last holder all of the key's lines stay; empty tables give no rows; other columns pass through
``deduplicate`` and ``drop_known_lines``; where one is called n_lines or n_dropped, the counts' names get an underscore in front.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .joining import join_facts
from .session import fresh_names, settle, work_dir

LEAST_LENGTH, LEAST_DOCS = 20, 3
BATCHES, FANOUT = 4, 3
_SPACES = " \t\n\x0b\f\r"
_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "h1 bigint, h2 bigint, n_docs bigint, last_doc bigint"
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class LineRuns:
    """Sorted runs (h1, h2, n_docs, last_doc) of line keys in levels below a shared folder; one writer at a time.

    A run is written aside and then renamed to <path>/buckets=<n>/level=<k>/run-<id>, so it is there as a whole or not at all.
    A merged run names those that it replaces, run-<id>-of-<ids>, so these don't count even if their removal is cut off.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        found = [x for x in self._names("") if x.startswith("buckets=")]
        self.buckets = int(found[0].removeprefix("buckets=")) if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = f"buckets={self.buckets}"
        self._fs.mkdirs(self._at(self.root))

    def _at(self, *parts: str):
        return self._hadoop("/".join([self.path, *(p for p in parts if p)]))

    def _names(self, part: str) -> list[str]:
        at = self._at(part)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def levels(self) -> dict[int, list[str]]:
        """Folders of the runs by level."""
        every = {level: self._names(f"{self.root}/{level}") for level in self._names(self.root)}
        replaced = {x for names in every.values() for name in names for x in name.partition("-of-")[2].split("-")}
        found = {}
        for level, names in every.items():
            runs = [f"{self.root}/{level}/{x}" for x in names if x.split("-")[1] not in replaced]
            if runs:
                found[int(level.removeprefix("level="))] = runs
        return found

    def _table(self, statement) -> DataFrame:
        """The table that ``statement`` makes under a name; only the data stay, not the name."""
        name = f"sluice_run_{uuid.uuid4().hex}"
        statement(name)
        found = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return found

    def _read(self, folder: str) -> DataFrame:
        clause = f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self._at(folder)}'"
        return self._table(lambda name: self.spark.sql(f"CREATE TABLE {name} ({_RUN}) USING parquet {clause}"))

    def _add(self, run: DataFrame, level: int, replaces: list[str] | None = None) -> str:
        """Writes a run into a level."""
        aside = f"staging-{uuid.uuid4().hex}"
        sorted_run = run.repartition(self.buckets, "h1", "h2").sortWithinPartitions("h1", "h2").select("h1", "h2", "n_docs", "last_doc")
        writer = sorted_run.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", str(self._at(aside)))
        self._table(writer.saveAsTable)
        folder = f"{self.root}/level={level}"
        self._fs.mkdirs(self._at(folder))
        old = "".join(f"-{x.rpartition('/')[2].split('-')[1]}" for x in replaces or [])
        place = f"{folder}/run-{uuid.uuid4().hex[:12]}{'-of' if old else ''}{old}"
        if not self._fs.rename(self._at(aside), self._at(place)):
            raise RuntimeError("a run could not be put in its place")
        return place

    def compact(self) -> None:
        """Merges full levels into runs of the next one."""
        for level in range(64):
            runs = self.levels().get(level, [])
            if len(runs) >= FANOUT:
                self._add(self._merged(runs), level + 1, runs)
                for x in runs:
                    self._fs.delete(self._at(x), True)

    def _merged(self, folders: list[str]) -> DataFrame:
        """Sums over runs, read as plain files: a union of bucketed tables passes for bucketed, but its tasks read them one by one."""
        every = self.spark.read.schema(_RUN).parquet(*(str(self._at(x)) for x in folders))
        return every.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def runs(self) -> list[DataFrame]:
        return [self._read(x) for level in self.levels().values() for x in level]

    def ingest(self, lines: DataFrame, path: str) -> DataFrame:
        """Adds a batch's lines (doc_id, h1, h2) as a run; gives the run's keys that no older run has, as a table at ``path``.

        A document must not come in two batches, or it counts twice.
        """
        counts = lines.groupBy("h1", "h2").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        older = self.runs()
        before = self.spark.conf.get(_ORDERED)
        self.spark.conf.set(_ORDERED, "true")  # one file a bucket: its order is the bucket's
        try:
            fresh = self._read(self._add(counts, 0))
            for run in older:
                fresh = fresh.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
            fresh = settle(fresh, path)
        finally:
            self.spark.conf.set(_ORDERED, before)
        self.compact()
        return fresh

    def totals(self) -> DataFrame:
        return self._merged([x for level in self.levels().values() for x in level])


def line_keys(text: Column) -> Column:
    """Of each line its place and two hashes of its key; only lines whose key is long enough."""
    lowered = F.translate(text, _UPPER, _ASCII_LOWER)
    stripped = F.transform(F.split(lowered, "\n"), lambda x, i: F.struct(i.alias("place"), F.trim(x, F.lit(_SPACES)).alias("key")))
    long_enough = F.filter(stripped, lambda x: F.length(x.key) >= LEAST_LENGTH)
    return F.transform(long_enough, lambda x: F.struct(x.place.alias("place"), F.xxhash64(x.key).alias("h1"), F.xxhash64(F.lit("second"), x.key).alias("h2")))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, text_hash) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _dropped_places(docs: DataFrame, path: str, batches: int) -> DataFrame:
    """(doc_id, text_hash, dropped): places of the lines that go, for the rows that lose any."""
    spark = docs.sparkSession
    bounds = sorted(set(docs.select("doc_id").approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + F.when(F.col("doc_id") <= bound, 1).otherwise(0)
    lines = settle(docs.select("doc_id", "text_hash", batch.alias("batch"), F.inline(line_keys(F.col("text")))), f"{path}/lines", "batch")

    runs = LineRuns(spark, f"{path}/runs")
    repeats = None
    for k in range(len(bounds) + 1):
        own = lines.filter(F.col("batch") == k)
        holders = runs.ingest(own, f"{path}/fresh-{k}").select("h1", "h2", F.col("last_doc").alias("doc_id")).hint("merge")
        others = own.join(holders, ["h1", "h2", "doc_id"], "left_anti")
        repeats = others if repeats is None else repeats.unionByName(others)
    frequent = settle(runs.totals().filter(F.col("n_docs") >= LEAST_DOCS).select("h1", "h2", "n_docs", F.lit(True).alias("frequent")), f"{path}/frequent")
    gone = join_facts(repeats, frequent, ["h1", "h2"], "n_docs").filter("frequent").select("doc_id", "text_hash", "place")
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("dropped"))


def _without(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``docs`` without the lines at the places (doc_id, text_hash, dropped), and the numbers of lines before and dropped."""
    n_lines, n_dropped = fresh_names(docs.columns, "n_lines", "n_dropped")
    id_, hash_, gone = fresh_names([*docs.columns, n_lines, n_dropped], "its_id", "its_hash", "its_dropped")
    places = places.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("dropped").alias(gone))
    known = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    both = known.join(places, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    left = F.element_at(F.transform(F.array(lines), lambda x: F.array_join(F.transform(stay, lambda i: F.get(x, i)), "\n")), 1)
    count = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    result = {n_lines: count.cast("long"), n_dropped: F.coalesce(F.size(gone), F.lit(0)).cast("long"), "text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(left)}
    return both.withColumns(result).select(*(F.col(f"`{c}`") for c in [*docs.columns, n_lines, n_dropped]))


def deduplicate(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the text of its remaining lines, and n_lines (before) and n_dropped."""
    path = work_dir(docs.sparkSession, "line-dedup")
    return _without(docs, _dropped_places(_keyed(docs), path, batches))


def drop_known_lines(docs: DataFrame, runs: LineRuns) -> DataFrame:
    """A later batch of ``docs`` without the lines that older batches of ``runs`` hold; its own lines are added to the runs.

    Lines that repeat within the batch alone stay. The batch's documents must be new to the runs.
    """
    path = work_dir(docs.sparkSession, "line-batch")
    lines = settle(_keyed(docs).select("doc_id", "text_hash", F.inline(line_keys(F.col("text")))), f"{path}/lines")
    fresh = runs.ingest(lines, f"{path}/fresh").select("h1", "h2", "n_docs", F.lit(True).alias("fresh"))
    known = join_facts(lines, fresh, ["h1", "h2"], "n_docs").filter("fresh is null")
    return _without(docs, known.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("dropped")))


def oracle_sql() -> str:
    return rf"""
    WITH l AS (
      SELECT doc_id, i, line, regexp_replace(translate(line, '{_UPPER}', '{_ASCII_LOWER}'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents), unnest(a) WITH ORDINALITY AS u(line, i)),
    f AS (SELECT key, max(doc_id) AS last_doc FROM l WHERE length(key) >= {LEAST_LENGTH} GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
    m AS (SELECT l.doc_id, i, line, (f.key IS NOT NULL AND l.doc_id <> f.last_doc) AS gone FROM l LEFT JOIN f ON f.key = l.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""
