import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators.drift import Reference, ks_long, long_form
from sluice.operators.sketches import K, SketchStore, ks_error, merged, rank_error, reference_of, sketched, sketched_ks, sketched_windows


def exact_rank(values, x):
    return np.searchsorted(np.sort(values), x, side="right") / len(values)


@pytest.mark.parametrize("kind", ["normal", "ties", "sorted", "heavy"])
def test_rank_error(spark, kind):
    """Merged from skewed parts, the sketch's quantiles have the ranks they should have, within the stated error."""
    rng = np.random.default_rng(5)
    values = {"normal": rng.normal(size=60_000), "ties": rng.integers(0, 12, 60_000).astype(float), "sorted": np.arange(60_000.0), "heavy": np.exp(rng.normal(size=60_000) * 5)}[kind]
    groups = np.sort(rng.integers(0, 7, 60_000) ** 2 // 6)
    df = spark.createDataFrame([(float(v), int(g)) for v, g in zip(values, groups, strict=True)], "x double, g int")
    whole = merged(sketched(df, ["x"], ["g"], 400))
    reference = reference_of(whole, 100).columns["x"]
    for i, q in enumerate(reference.quantiles):
        below, upto = np.mean(values < q), exact_rank(values, q)
        assert below - 2 * rank_error(400) <= i / 100 <= upto + 2 * rank_error(400)
    assert reference.quantiles[0] == values.min() and reference.quantiles[-1] == values.max()
    assert math.isclose(reference.mean, values.mean(), rel_tol=1e-9) and math.isclose(reference.std, values.std(), rel_tol=1e-9)


def test_small_sketches_are_exact_and_missing_values_do_not_count(spark):
    rows = [(float(v), "a") for v in range(50)] + [(math.nan, "a"), (math.inf, "a"), (None, "a"), (None, "b"), (7.0, None)]
    df = spark.createDataFrame(rows, "x double, g string")
    found = {r.g: (r.n, r.low, r.high, r["mean"]) for r in sketched(df, ["x"], ["g"]).collect()}
    assert found == {"a": (50, 0.0, 49.0, 24.5), None: (1, 7.0, 7.0, 7.0)}
    assert merged(sketched(df, ["x"], ["g"]), ["g"]).count() == 2
    assert sketched(df.limit(0), ["x"]).collect() == [] and merged(sketched(df.limit(0), ["x"])).collect() == []


def test_statistics_are_near_the_exact_ones(spark):
    a = spark.range(40_000).select(F.randn(1).alias("x"), F.floor(F.rand(2) * 9).cast("double").alias("y"), (F.col("id") % 3).alias("g"), F.lit(1.0).alias("only_here"))
    b = spark.range(9_000).select((F.randn(3) + 0.3).alias("x"), F.floor(F.rand(4) * 10).cast("double").alias("y"))
    close = {(r.g, r["column"]): r.ks for r in sketched_ks(sketched(a, ["x", "y", "only_here"], ["g"]), sketched(b, ["x", "y"]), ["g"]).collect()}
    exact = {(r.g, r["column"]): r.ks for r in ks_long(long_form(a, ["x", "y"], ["g"]), long_form(b, ["x", "y"]), ["g"]).collect()}
    assert all(abs(close[k] - exact[k]) <= ks_error() for k in exact) and all(v > 0.05 for v in exact.values())
    assert all(math.isnan(v) for k, v in close.items() if k[1] == "only_here")
    same = sketched_ks(sketched(b, ["x"]), sketched(b, ["x"])).first()
    assert same.ks <= ks_error()


def test_store_reads_a_chunk_once(spark, tmp_path):
    store = SketchStore(spark, str(tmp_path / "s"))
    chunk = lambda name, shift: spark.range(500).select(F.lit(name).alias("chunk_id"), (F.col("id") + shift).cast("double").alias("x"))
    store.add(chunk("a", 0).unionByName(chunk("b", 500)), ["x"])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "chunk_id=a").glob("*.parquet")}
    store.add(chunk("c", 1000), ["x"])
    store.add(chunk("b", 2000), ["x"])  # in place of the earlier one
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "chunk_id=a").glob("*.parquet")} == files
    assert sorted((r.chunk_id, r.n, r.low) for r in store.sketches().collect()) == [("a", 500, 0.0), ("b", 500, 2000.0), ("c", 500, 1000.0)]
    early, whole = store.reference("a"), store.reference()
    assert (early.n_rows, whole.n_rows) == (500, 1500) and early.columns["x"].quantiles[-1] == 499.0 and whole.columns["x"].mean == pytest.approx((249.5 + 2249.5 + 1249.5) / 3)
    whole.save(tmp_path / "r.json")
    assert Reference.load_if_there(tmp_path / "r.json").columns["x"].quantiles == whole.columns["x"].quantiles
    assert rank_error(K) < 0.003


def test_windows_of_a_stream_close_and_late_events_stay_out(spark, tmp_path):
    """Day 1 arrives, then day 3; an event of day 1 that comes after that is too late."""
    source, out = tmp_path / "events", tmp_path / "out"
    put = lambda rows: spark.createDataFrame(rows, "ts string, x double").select(F.to_timestamp("ts").alias("ts"), "x").coalesce(1).write.mode("append").parquet(str(source))
    day1 = [(f"2024-01-01 {h:02d}:00:00", float(h)) for h in range(24)]
    put(day1)
    stream = spark.readStream.schema("ts timestamp, x double").parquet(str(source))
    reference = sketched(spark.createDataFrame(day1, "ts string, x double"), ["x"])
    windows = sketched_ks(sketched_windows(stream, "ts", ["x"], "1 day", "2 hours"), reference, ["start"])

    def run():
        windows.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.start.day, r.n, round(r.ks, 6)) for r in spark.read.schema(windows.schema).parquet(str(out)).collect())

    assert run() == []  # the day isn't over
    put([("2024-01-03 12:00:00", 100.0)])
    assert run() == [(1, 24, 0.0)]
    put([("2024-01-01 05:00:00", 5.0), ("2024-01-03 13:00:00", 101.0)])
    put([("2024-01-05 00:00:00", 1.0)])
    assert run() == [(1, 24, 0.0), (3, 2, 1.0)]
