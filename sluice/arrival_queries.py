"""Queries of arriving chunks and of sketches kept by chunk, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .flow_queries import _FROZEN, folder
from .operators.drift import drift_statistics, freeze_reference, ks_long, long_form
from .operators.gates import CompositeGate, DriftGate, GateContext
from .operators.sketches import SketchStore, ks_error, merged, sketched, sketched_ks, sketched_windows
from .queries import _YEARS, orders_by_year, query, rounded, table
from .sources.folder_source import chunk_folder
from .sources.storage import join, storage_of
from .streaming.arrival import stream_contents
from .streaming.quiet import watch_quiet

__all__ = ["drift_windows", "edited_chunks", "psi_gate", "quiet_chunks", "sketched_drift", "sketched_gate"]


def order_chunks(spark: SparkSession, sf_dir: str, path: str, names: dict[str, int], newest_first: bool = False) -> None:
    """A chunk file of each named year's orders, written by Spark; each is moved to its place as a whole."""
    years = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    dealt = orders.withColumn("name", F.explode(F.map_keys(F.map_filter(years, lambda _, y: y == F.col("year"))))).drop("year")
    order = F.desc("o_orderkey") if newest_first else F.asc("o_orderkey")
    aside, store = f"{path}-parts", storage_of(path)
    dealt.repartition(max(1, len(names)), "name").sortWithinPartitions("name", order).write.mode("overwrite").partitionBy("name").csv(aside, header=True)
    for name in names:
        (part,) = [f.name for f in store.files(join(aside, f"name={name}")) if f.name.endswith(".csv")]
        store.move(join(aside, f"name={name}", part), join(path, f"chunk_{name}.csv"))
    store.remove(aside)


def _years(spark: SparkSession, sf_dir: str) -> list[int]:
    found = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).first()
    return list(range(found.a, found.b + 1))


_FILES = """y AS (SELECT min(year(o_orderdate)) AS a FROM orders),
files AS (
  SELECT year(o_orderdate)::VARCHAR AS name, o_orderkey, o_custkey, o_orderpriority, o_orderkey AS k FROM orders
  UNION ALL SELECT 'copy', o_orderkey, o_custkey, o_orderpriority, o_orderkey FROM orders, y WHERE year(o_orderdate) = a + 1
  UNION ALL SELECT 'edited', o_orderkey, o_custkey, o_orderpriority, -o_orderkey FROM orders, y WHERE year(o_orderdate) = a),
v AS (SELECT name, count(*) AS n_rows, 'sha256:' || substr(sha256('o_orderkey,o_custkey,o_orderpriority' || chr(10) ||
  string_agg(o_orderkey || ',' || o_custkey || ',' || o_orderpriority, chr(10) ORDER BY k) || chr(10)), 1, 16) AS data_version FROM files GROUP BY name)"""


@query(f"""WITH {_FILES}
SELECT 'first' AS wave, 'chunk_' || name AS chunk_id, data_version, n_rows FROM v WHERE name NOT IN ('copy', 'edited')
UNION ALL SELECT 'second', 'chunk_' || a, data_version, n_rows FROM v, y WHERE name = 'edited'
UNION ALL SELECT 'batch', 'chunk_' || CASE WHEN name = 'edited' THEN a::VARCHAR ELSE name END, data_version, n_rows FROM v, y WHERE name <> a::VARCHAR""")
def edited_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of years as a stream of new contents, in two runs: between them one is edited in place and one copied. Then all as a batch."""
    path, kept = folder(spark, "chunks"), folder(spark, "arrivals")
    years = _years(spark, sf_dir)
    order_chunks(spark, sf_dir, path, {str(y): y for y in years})
    out = join(kept, "files")

    def arrive() -> DataFrame:
        stream_contents(spark, path, "chunk_*.csv", join(kept, "progress"), out).awaitTermination()
        return spark.read.parquet(out).select("chunk_id", "data_version")

    first = [tuple(r) for r in arrive().collect()]  # a row for each file
    order_chunks(spark, sf_dir, path, {str(years[0]): years[0]}, newest_first=True)
    order_chunks(spark, sf_dir, path, {"copy": years[1]})
    before = spark.createDataFrame([(*f, "first") for f in first], "chunk_id string, data_version string, wave string")
    arrived = arrive().join(before, ["chunk_id", "data_version"], "left").select(F.coalesce("wave", F.lit("second")).alias("wave"), "chunk_id", "data_version")
    rows = chunk_folder(spark, path).groupBy(F.lit("batch").alias("wave"), "chunk_id", "data_version").agg(F.count("*").alias("n_rows"))
    # The first year's earlier version is no longer there to be counted; editing didn't change its number of rows.
    sizes = rows.groupBy(F.col("chunk_id").alias("id")).agg(F.max("n_rows").alias("n"))
    arrived = arrived.join(sizes, F.col("chunk_id") == F.col("id")).select("wave", "chunk_id", "data_version", F.col("n").alias("n_rows"))
    return arrived.unionByName(rows)


@query(f"""WITH {_FILES} SELECT data_version, 1::BIGINT AS times, n_rows, true AS pending FROM v WHERE name NOT IN ('copy', 'edited')""")
def quiet_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks handed on once they are quiet: the query is stopped while all are pending and goes on from its checkpoint; a copy isn't handed on."""
    path, kept = folder(spark, "chunks"), folder(spark, "quiet")
    years = _years(spark, sf_dir)
    order_chunks(spark, sf_dir, path, {str(y): y for y in years} | {"copy": years[1]})
    seen: list[str] = []  # a version for each file

    def watch(wait: float, only_new: bool = False) -> StreamingQuery:
        return watch_quiet(spark, path, join(kept, "progress"), lambda batch, _: seen.extend(r.data_version for r in batch.collect()), wait, "0 seconds", only_new=only_new)

    query = watch(12.0, only_new=True)
    query.processAllAvailable()  # all files in one batch: no clock decides whether it ends before they are due
    query.stop()
    pending = not seen
    query = watch(1.0)
    while len(seen) < len(years) and not query.awaitTermination(0.1):  # a query that fails raises
        pass
    query.stop()
    times = spark.createDataFrame([(v, pending) for v in seen], "data_version string, pending boolean").groupBy("data_version", "pending").agg(F.count("*").alias("times"))
    sizes = chunk_folder(spark, path).groupBy("chunk_id", "data_version").agg(F.count("*").alias("n")).groupBy("data_version").agg(F.max("n").alias("n_rows"))
    return times.join(sizes, "data_version").select("data_version", "times", "n_rows", "pending")


# ---- sketches kept by chunk ----


_GAPS = """, g AS (SELECT {by} AS part, count(*) AS n FROM {sample} GROUP BY ALL),
c AS (SELECT p.part, v, sum(s) AS s, sum(r) AS r FROM (SELECT DISTINCT {by} AS part FROM {sample}) p, LATERAL (
  SELECT {value} AS v, 1 AS s, 0 AS r FROM {sample} x WHERE {by} = p.part UNION ALL SELECT v, 0, 1 FROM ref) u GROUP BY ALL),
e AS (SELECT part, sum(s) OVER w AS cs, sum(r) OVER w AS cr FROM c WINDOW w AS (PARTITION BY part ORDER BY v)),
k AS (SELECT e.part, max(abs(cs / g.n - cr / (SELECT count(*) FROM ref))) AS ks FROM e JOIN g ON g.part = e.part GROUP BY e.part)"""


def _kept(spark: SparkSession, sf_dir: str) -> SketchStore:
    """The sketches of each year's orders: first of all but the last year, then of that one alone."""
    store, orders = SketchStore(spark, folder(spark, "sketches")), orders_by_year(spark, sf_dir)
    last = orders.agg(F.max("year")).first()[0]
    for part in (orders.filter(F.col("year") < last), orders.filter(F.col("year") == last)):
        store.add(part, ["price"], "year")
    return store


@query(f"""WITH {_YEARS}, ref AS (SELECT price AS v FROM o WHERE year < (SELECT max(year) FROM o)){_GAPS.format(sample="o", by="year", value="price")}
SELECT k.part::VARCHAR AS year, g.n, round(a.mean, 4) AS mean, round(a.sd, 4) AS std, round(k.ks, 6) AS ks, true AS within_bound
FROM k JOIN g ON g.part = k.part JOIN (SELECT year, avg(price) AS mean, stddev_pop(price) AS sd FROM o GROUP BY year) a ON a.year = k.part""")
def sketched_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year's sketch against the merged ones of all years but the last; the exact statistic beside, and whether the sketch is as near as it must be."""
    store, orders = _kept(spark, sf_dir), orders_by_year(spark, sf_dir).withColumn("year", F.col("year").cast("string"))
    last = orders.agg(F.max("year")).first()[0]
    sketches = store.sketches()
    close = sketched_ks(sketches, merged(sketches.filter(F.col("chunk_id") < last)), ["chunk_id", "mean", "m2"])
    exact = ks_long(long_form(orders, ["price"], ["year"]), long_form(orders.filter(F.col("year") < last), ["price"]), ["year"]).withColumnRenamed("ks", "exact")
    both = exact.join(close, F.col("year") == F.col("chunk_id"))
    return both.select("year", "n", rounded("mean", 4).alias("mean"), rounded(F.sqrt(F.col("m2") / F.col("n")), 4).alias("std"), rounded("exact").alias("ks"), (F.abs(F.col("ks") - F.col("exact")) <= ks_error()).alias("within_bound"))


@query(f"""WITH {_FROZEN} SELECT round(ks, 6) AS ks, true AS near, ks <= 0.5 AS verdict FROM k""")
def sketched_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later years checked against a reference that comes from the first year's stored sketch alone, beside one frozen exactly."""
    store, orders = _kept(spark, sf_dir), orders_by_year(spark, sf_dir)
    first = orders.agg(F.min("year")).first()[0]
    path = store.reference(str(first)).save(join(folder(spark, "reference"), "reference.json"))
    frame = orders.filter(F.col("year") > first)
    exact = drift_statistics(frame, freeze_reference(orders.filter(F.col("year") == first), ["price"]), ["price"])["price"]
    verdict, _, found = DriftGate(path, 0.5).decide(GateContext(frame=frame), {})
    return spark.createDataFrame([(round(exact, 6), abs(found["worst"] - exact) <= ks_error(), verdict)], "ks double, near boolean, verdict boolean")


@query(f"""WITH {_FROZEN}, ed AS (SELECT list_sort(list_distinct(quantile_cont(v, list_transform(range(1, 10), lambda i: i / 10)))) AS e FROM g),
b AS (SELECT len(list_filter(e, lambda x: x <= v)) AS b, 1 AS s, 0 AS r FROM t, ed UNION ALL SELECT len(list_filter(e, lambda x: x <= v)), 0, 1 FROM g, ed UNION ALL SELECT unnest(range(0, len(e) + 1)), 0, 0 FROM ed),
n AS (SELECT greatest(sum(s) / (SELECT count(*) FROM t), 1e-6) AS p, greatest(sum(r) / 401, 1e-6) AS q FROM b GROUP BY b),
d AS (SELECT sum((p - q) * ln(p / q)) AS psi FROM n)
SELECT u.name, round(psi, 6) AS psi, u.blocking, psi <= u.most AS verdict, psi <= u.most OR NOT u.blocking AS passed FROM d, LATERAL (VALUES ('blocks', true, 1e-9), ('warns', false, 1e-9), ('allows', true, 5.0)) u(name, blocking, most)""")
def psi_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population stability of later years against the first one's frozen grid: a check that blocks, one that only warns, and one that allows more."""
    orders = orders_by_year(spark, sf_dir)
    first = orders.agg(F.min("year")).first()[0]
    path = freeze_reference(orders.filter(F.col("year") == first), ["price"]).save(join(folder(spark, "reference"), "reference.json"))
    later, rows = orders.filter(F.col("year") > first), []
    for name, blocking, most in (("blocks", True, 1e-9), ("warns", False, 1e-9), ("allows", True, 5.0)):
        decision = CompositeGate([DriftGate(path, most, blocking=blocking, method="psi")]).evaluate(GateContext(frame=later))
        (found,) = decision.results
        rows.append((name, round(found.evidence["worst"], 6), found.blocking, found.verdict, decision.verdict))
    return spark.createDataFrame(rows, "name string, psi double, blocking boolean, verdict boolean, passed boolean")


@query(f"""WITH o AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, value FROM events), ref AS (SELECT value AS v FROM events){_GAPS.format(sample="o", by="day", value="value")}
SELECT k.part AS start, g.n, round(ks, 6) AS ks, true AS within_bound FROM k JOIN g ON g.part = k.part
WHERE k.part + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def drift_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows of the events as a stream, each written once it is closed, against the sketch of all events."""
    kept, events = folder(spark, "drift"), table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parq*")
    windows = sketched_ks(sketched_windows(stream, "ts", ["value"], "1 day", "1 hour"), sketched(events, ["value"]), ["start"])
    windows.writeStream.format("parquet").option("path", join(kept, "windows")).option("checkpointLocation", join(kept, "progress")).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(windows.schema).parquet(join(kept, "windows"))
    days = long_form(events.withColumn("day", F.date_trunc("day", F.col("ts").cast("timestamp"))), ["value"], ["day"])
    exact = ks_long(days, long_form(events, ["value"]), ["day"]).withColumnRenamed("ks", "exact")
    both = found.join(exact, F.col("start") == F.col("day"))
    return both.select(F.col("start").cast("timestamp_ntz").alias("start"), "n", rounded("exact").alias("ks"), (F.abs(F.col("ks") - F.col("exact")) <= ks_error()).alias("within_bound"))
