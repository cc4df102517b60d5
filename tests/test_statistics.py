import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators import ordering
from sluice.operators.drift import Reference, drift_statistics, freeze_reference, ks_long, ks_statistic, psi_statistic
from sluice.operators.metrics import bootstrap_shares, exact_resampled_means, evaluate, evaluate_beside, normalized_score, paired_bootstrap, paired_differences, resample_weights, run_weights, split_draws, slice_metrics, slice_names, summarise, to_long, to_long_beside
from sluice.operators.ordering import global_rank, running_totals, value_keys
from sluice.operators.profile import chunk_drift_matrix, dominance_verdict, findings, linear_r2, model_trajectory, per_target_metrics, scale_disparity, size_dominance, size_profile, slice_table, target_correlations

NAN, INF = float("nan"), float("inf")


def frame(spark, values, name="value"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def ks(a, b):
    a, b = (np.sort([x for x in v if x is not None and math.isfinite(x)]) for v in (a, b))
    if not len(a) or not len(b):
        return NAN
    points = np.concatenate([a, b])
    return float(np.max(np.abs(np.searchsorted(a, points, side="right") / len(a) - np.searchsorted(b, points, side="right") / len(b))))


def psi(a, b, buckets=10, eps=1e-6):
    a, b = (np.array([x for x in v if x is not None and math.isfinite(x)]) for v in (a, b))
    edges = np.unique(np.quantile(b, [k / buckets for k in range(1, buckets)]))
    p, q = (np.maximum(np.bincount(np.searchsorted(edges, v, side="right"), minlength=len(edges) + 1) / len(v), eps) for v in (a, b))
    return float(np.sum((p - q) * np.log(p / q)))


rng = np.random.default_rng(3)
CASES = [
    (np.linspace(0, 1, 200), np.linspace(0, 1, 200)),
    (np.linspace(0, 1, 50), np.linspace(5, 6, 70)),
    (rng.normal(size=500), rng.normal(0.5, 2, 300)),
    ([*rng.integers(0, 4, 200), NAN, None, INF, -INF], [0.0] * 150 + [1.0] * 20 + [3.0] * 30),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_ks_and_psi_equal_numpy(spark, k):
    a, b = CASES[k]
    fa, fb = frame(spark, a), frame(spark, b)
    assert ks_statistic(fa, fb) == pytest.approx(ks(a, b), abs=1e-12)
    assert psi_statistic(fa, fb) == pytest.approx(psi(a, b), abs=1e-9)


def test_drift_without_values(spark):
    none = frame(spark, [NAN, None])
    assert math.isnan(ks_statistic(none, frame(spark, [1.0])))
    with pytest.raises(ValueError):
        psi_statistic(frame(spark, [1.0]), frame(spark, [1.0]), buckets=1)
    ref = freeze_reference(frame(spark, range(100), "x"), ["x"], 11)
    found = drift_statistics(frame(spark, [NAN], "x"), ref, ["x"])
    assert math.isnan(found["x"])


def test_reference_round_trip(spark, tmp_path):
    values = [*rng.normal(size=1001), NAN, None]
    ref = freeze_reference(frame(spark, values, "a"), ["a"])
    clean = np.array(values[:1001])
    assert np.allclose(ref.columns["a"].quantiles, np.quantile(clean, np.linspace(0, 1, 401)), atol=1e-12)
    assert ref.columns["a"].std == pytest.approx(clean.std())
    back = Reference.load_if_there(ref.save(tmp_path / "r.json"))
    assert back.columns["a"].quantiles == ref.columns["a"].quantiles and back.n_rows == 1003
    assert Reference.load_if_there(tmp_path / "none.json") is None


def test_global_rank_over_many_ranges(spark):
    values = [float(x) for x in rng.integers(0, 5, 3000)] + [NAN] * 10 + [None] * 10
    df = spark.createDataFrame(list(enumerate(values)), "row_id long, v double").repartition(7)
    got = global_rank(df, value_keys(F.col("v"), F.col("row_id"), True)).orderBy("rank").collect()
    want = sorted(range(len(values)), key=lambda i: (values[i] is None or math.isnan(values[i]), -values[i] if values[i] is not None and not math.isnan(values[i]) else 0, i))
    assert [r.row_id for r in got] == want and [r["rank"] for r in got] == list(range(len(values)))


def test_running_totals_by_group(spark):
    rows = [(g, i, (i * 7) % 11) for g in ("a", "b", None) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, i long, x long")
    got = {(r.g, r.i): r.t for r in running_totals(df, [F.col("i")], {"t": F.col("x")}, ["g"]).collect()}
    sums = np.cumsum([(i * 7) % 11 for i in range(700)])
    assert all(got[g, i] == sums[i] for g in ("a", "b", None) for i in range(700))
    assert running_totals(df.limit(0), [F.col("i")], {"t": F.col("x")}).count() == 0


@pytest.fixture(scope="module")
def long(spark):
    r = np.random.default_rng(5)
    rows = [(i, float(r.normal(2, 1)), float(r.normal(0.3, 0.05)), int(i % 60), bool(i < 19)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, mu double, gap double, size int, has_F boolean")
    df = df.withColumns({"p_mu": F.lit(2.0), "p_gap": F.col("gap") + 0.01})
    names = slice_names({"heavy": {"column": "size", "bins": [0, 20, 60]}, "fluor": {"column": "has_F"}, "none": {"column": "nowhere"}}, df.columns)
    return rows, to_long(df, ["mu", "gap"], {"mu": "p_mu", "gap": "p_gap"}, slices=names)


def test_metrics_and_slices(long):
    rows, frame = long
    report = evaluate(frame, "m", "golden", ["mu", "gap", "absent"][:2])
    mu, gap = (np.array([r[k] for r in rows]) for k in (1, 2))
    e = np.abs(mu - 2.0)
    assert report.per_target["mu"].mae == pytest.approx(e.mean()) and report.per_target["mu"].rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert report.per_target["mu"].r2 == pytest.approx(1 - (e**2).sum() / ((mu - mu.mean()) ** 2).sum())
    assert report.target_std["gap"] == pytest.approx(gap.std())
    assert normalized_score(report) == pytest.approx((e.mean() / mu.std() + 0.01 / gap.std()) / 2)
    assert set(report.slices) == {"heavy[0-20)", "heavy[20-60)", "fluor=false"}  # 19 rows are too few
    low = np.array([r[3] < 20 for r in rows])
    assert report.slices["heavy[0-20)"] == {"normalized_mae": pytest.approx((e[low].mean() / mu.std() + 0.01 / gap.std()) / 2), "n": int(low.sum())}
    assert slice_metrics(frame, 19).filter("slice = 'fluor=true'").count() == 1
    assert summarise(report)["per_target"]["mu"]["n"] == 200


def test_degenerate_reports(spark, long):
    flat = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], "row_id long, y double, p double")
    report = evaluate(to_long(flat, ["y"], {"y": "p"}), "m", "s", ["y", "none"])
    assert math.isnan(report.per_target["y"].r2) and report.target_std["y"] == 1.0
    assert report.per_target["none"].n == 0 and math.isnan(report.per_target["none"].mae)
    with pytest.raises(ValueError):
        normalized_score(report, [])
    with pytest.raises(KeyError):
        to_long(flat, ["missing"], {"missing": "p"})


def test_bootstrap_does_not_depend_on_the_partitioning(spark, long):
    d = rng.normal(0.25, 1, 60)
    pairs = spark.createDataFrame([("t", i, float(x)) for i, x in enumerate(d)], "target string, row_id long, d double")
    (one,), (many,) = (bootstrap_shares(x, 400, 7).collect() for x in (pairs.coalesce(1), pairs.repartition(5)))
    weights = resample_weights(np.arange(60), np.arange(400), 7)
    assert one.p == many.p == (d @ weights <= 0).mean() and one.delta == pytest.approx(d.mean())
    draws = [np.random.default_rng(b).choice(d, 60).mean() for b in range(2000)]
    assert one.p == pytest.approx(np.mean(np.array(draws) <= 0), abs=0.03)
    assert weights.mean() == pytest.approx(1, abs=0.03) and weights.var() == pytest.approx(1, abs=0.06)
    _, frame = long
    new, old = evaluate(frame, "a", "s", ["mu", "gap"], False), evaluate(frame.withColumn("pred", F.col("pred") + 1), "b", "s", ["mu", "gap"], False)
    found = paired_bootstrap(new, old, 200)
    assert found["gap"][1] == 0.0 and found["gap"][0] > 0 and found == paired_bootstrap(new, old, 200)
    assert paired_bootstrap(new, new, 50)["mu"] == (0.0, 1.0)


def test_models_beside_each_other_pair_without_a_join(spark):
    df = spark.range(50).selectExpr("id AS row_id", "double(id % 7) AS mu", "id / 9 AS a", "if(id % 11 = 0, null, id / 8) AS b")
    table = to_long_beside(df, ["mu"], {"new": {"mu": "a"}, "old": {"mu": "b"}})
    new, old = (evaluate_beside(table, m, m, "s", ["mu"], False) for m in ("new", "old"))
    apart = [evaluate(to_long(df, ["mu"], {"mu": c}), c, "s", ["mu"], False) for c in ("a", "b")]
    assert [new.per_target["mu"].mae, old.per_target["mu"].mae] == [r.per_target["mu"].mae for r in apart]
    beside = paired_differences(new, old)
    assert "Join" not in beside._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(beside.collect(), key=lambda r: r.row_id) == sorted(paired_differences(*apart).select("target", "row_id", "d").collect(), key=lambda r: r.row_id)


def test_resample_weights_are_those_of_plain_remainders():
    rows, b, p = np.array([0, 1, 59, 2**31 - 2, 2**31 - 1, 2**31, 10**12, 2**62, -1, -(2**40)]), np.arange(2000), 2**31 - 1
    x = ((rows % p)[:, None] * 1_000_003 + b * 7_919 + 3 * 104_729 + 12_345) % p
    for _ in range(3):
        x = (x * x + 48_271 * x + b) % p
    cumulative = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676, 0.99998975]
    assert (resample_weights(rows, b, 3) == np.searchsorted(cumulative, x / p, side="right")).all()


def test_multinomial_resamples_have_exact_sizes(spark):
    d = rng.normal(0.2, 1, 2500)
    pairs = spark.createDataFrame([("t", i, float(x)) for i, x in enumerate(d)] + [("one", 5, 2.0), ("same", 1, 1.0), ("same", 1, 1.0)], "target string, row_id long, d double")
    one, many = ({(r.target, r.b): (r.weight, round(r.total, 9)) for r in exact_resampled_means(x, 300, 3).collect()} for x in (pairs.coalesce(1), pairs.repartition(7)))
    assert one == many and len(one) == 900
    assert {k[0]: {v[0] for j, v in one.items() if j[0] == k[0]} for k in one} == {"t": {2500.0}, "one": {1.0}, "same": {2.0}}
    assert {v[1] for k, v in one.items() if k[0] == "one"} == {2.0}
    means = np.array([v[1] for k, v in one.items() if k[0] == "t"]) / 2500
    assert means.mean() == pytest.approx(d.mean(), abs=4 * d.std() / np.sqrt(2500 * 300)) and means.std() == pytest.approx(d.std() / 50, rel=0.15)
    found = {r.target: r.p for r in bootstrap_shares(pairs, 300, 3, "multinomial").collect()}
    assert found["t"] == np.mean(means <= 0) and found["one"] == 0.0
    with pytest.raises(ValueError):
        bootstrap_shares(pairs, 10, 0, "jackknife")
    assert exact_resampled_means(pairs.limit(0), 10).collect() == []


def test_draws_are_split_whole():
    """Any tree of blocks keeps the number of draws; single blocks get what is expected of them."""
    sizes = np.array([0, 5, 1, 0, 94, 300, 0])
    draws = split_draws(sizes, 4000, [1, 2])
    assert (draws.sum(0) == 400).all() and (draws[sizes == 0] == 0).all()
    assert draws.mean(1) == pytest.approx(sizes, abs=1.2) and draws.var(1) == pytest.approx(sizes * (1 - sizes / 400), rel=0.12)
    weights = run_weights(3, np.array([0, 7, 1000]), np.random.default_rng(1))
    assert weights.sum(1).tolist() == [0, 7, 1000] and weights.min() >= 0


def test_profiles(spark):
    r = np.random.default_rng(1)
    c, n = r.integers(1, 9, 300), r.integers(0, 3, 300)
    rows = [(i, int(c[i] + n[i]), int(c[i]), int(n[i]), float(-38.0 * c[i] - 54.0 * n[i]), float(r.normal()), f"chunk_{i // 100}") for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, size int, nC int, nN int, u0 double, mu double, chunk_id string")
    top = size_profile(df, "size").orderBy(F.desc("n")).first()
    sizes = [x[1] for x in rows]
    assert top.n == max(map(sizes.count, set(sizes))) and top.first_row == sizes.index(top["size"])
    r2 = linear_r2(df, ["u0", "mu"], ["nC", "nN"])
    assert r2["u0"] == pytest.approx(1.0) and r2["mu"] < 0.1 and dominance_verdict(r2["u0"]) == "atom counting" and dominance_verdict(0.95) == "mostly size"
    dom = {x["column"]: x.r2 for x in size_dominance(df, ["u0", "mu"], "size").collect()}
    assert dom["u0"] == pytest.approx(np.corrcoef([x[4] for x in rows], sizes)[0, 1] ** 2)
    assert target_correlations(df, ["u0", "mu"]).first().r == pytest.approx(np.corrcoef([x[4] for x in rows], [x[5] for x in rows])[0, 1])
    assert scale_disparity(df, ["u0", "mu"]).filter("column = 'mu'").first().orders == 0.0
    matrix = {x.chunk_id: x for x in chunk_drift_matrix(df, df.filter("chunk_id = 'chunk_0'"), ["u0", "mu"]).collect()}
    assert matrix["chunk_0"].mu == 0.0 and matrix["chunk_1"].mu == pytest.approx(ks([x[5] for x in rows[100:200]], [x[5] for x in rows[:100]]))
    found = findings(df, df, ["u0", "mu"], "size", ["nC", "nN"])
    assert found["n_rows"] == 300 and found["verdicts"]["u0"] == "atom counting"


def test_registry_profiles(spark, tmp_path):
    from sluice.sources.registry import ModelRegistry

    reg = ModelRegistry(tmp_path)
    metrics = {"golden": {"normalized_score": 0.5, "per_target": {"mu": {"mae": 0.1, "rmse": 0.2, "r2": 0.3, "n": 4}}, "slices": {"a": {"normalized_mae": 0.7, "n": 25}}}}
    decision = {"verdict": False, "results": [{"name": "x", "verdict": False, "blocking": True}, {"name": "y", "verdict": False, "blocking": False}, {"name": "z", "verdict": False, "blocking": True}]}
    reg.register("lifecycle-20200101T000000Z-abcdef", {"data": "d"}, metrics, decision, "rejected")
    df = reg.as_frame(spark)
    row = model_trajectory(df).first()
    assert row.score == 0.5 and row.failed == "x, z"
    assert per_target_metrics(df).first() == ("00000Z-abcdef", "mu", 0.1)
    assert slice_table(df, "lifecycle-20200101T000000Z-abcdef").first() == ("a", 0.7, 25)


def test_ranges_are_bounded_and_keep_equal_values_together(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BITS", 4)
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), F.floor(F.col("id") / 3).cast("double").alias("value"), F.lit("x").alias("column"))
    stored = ordering.by_ranges(rows, [F.col("column"), F.col("value")], together=True)
    assert stored.groupBy("column", "value").agg(F.countDistinct("_range").alias("n")).filter("n > 1").count() == 0
    sizes = [r["count"] for r in stored.groupBy("_range").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 16 + 2
    tasks = ordering.dealt_by_ranges(stored, ["column"]).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 20 and max(r["count"] for r in tasks) < 600  # four tasks would have 750 each
    found = {r.g: r.ks for r in ks_long(rows, rows.filter("value >= 250").drop("g"), ["g"]).collect()}
    assert found == {0: 0.25, 1: 0.25, 2: 0.25}
    ranks = ordering.global_rank(rows, [F.col("value"), F.col("g")]).filter(F.col("rank") != 3 * F.col("value") + F.col("g"))
    assert ranks.count() == 0
    totals = ordering.running_totals(rows, [F.col("value")], {"n": F.lit(1)}, ["g"]).filter(F.col("n") != F.col("value") + 1)
    assert totals.count() == 0
