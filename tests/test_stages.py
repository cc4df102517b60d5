import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from sluice.functions.shared import clear_work, shared_root, work_folder
from sluice.functions.tables import register_tables
from sluice.operators.matrices import correlations, pair_moments
from sluice.operators.stages import FeaturizerStage, FeaturizerStageModel, TrainerStage


def test_correlations_against_pandas(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 6))
    x[:, 1] += x[:, 0]
    x[:, 2] = 1e9 + x[:, 0]  # a large mean costs no digits
    x[:, 3] = 4.0
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 4.0
    frame = pd.DataFrame(x, columns=["a", "b", "c", "flat", "e.e", "f"])
    rows = [tuple(None if v != v and k % 2 else float(v) for k, v in enumerate(r)) for r in x]
    rows += [(math.inf, 1.0, 1e9, 4.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, `e.e` double, f double").repartition(5)
    found = {(r.a, r.b): r.r for r in correlations(df, frame.columns).collect()}
    want = pd.concat([frame, pd.DataFrame([[np.nan, 1, 1e9, 4, 1, 1]], columns=frame.columns)]).assign(c=lambda d: d.c - 1e9).corr()
    assert len(found) == 15
    for (a, b), r in found.items():
        assert (math.isnan(r) and "flat" in (a, b)) or r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_many_columns_in_a_plan_of_constant_size(spark):
    names = [f"c{k}" for k in range(200)]
    wide = spark.range(300).select(*(F.sin(F.col("id") * (k + 1)).alias(n) for k, n in enumerate(names)))
    moments = pair_moments(wide, names)
    assert len(moments._jdf.queryExecution().executedPlan().toString().splitlines()) < 30
    found = correlations(wide, names)
    x = np.sin(np.arange(300)[:, None] * (np.arange(200) + 1))
    want = np.corrcoef(x.T)
    worst = found.select("a", "b", "r").toPandas()
    i, j = worst.a.str[1:].astype(int), worst.b.str[1:].astype(int)
    assert len(worst) == 200 * 199 // 2 and np.nanmax(np.abs(worst.r - want[i, j])) < 1e-9
    assert correlations(wide.limit(0), names[:3]).collect() == []


def test_stages_round_trip(spark, tmp_path):
    chains = ["C", "CC", "CCO", "CCN", "c1ccccc1", "CC(=O)O", "CCF", "C#N"]
    rows = spark.createDataFrame([(k, chains[k % 8], float(len(chains[k % 8])), float(k % 8)) for k in range(80)], "row_id long, smiles string, y double, z double")
    stages = [FeaturizerStage(kind="structure_descriptors", bits=64, radius=1), TrainerStage(targets=["y", "z"], settings={"n_estimators": 4, "max_depth": 5})]
    model = Pipeline(stages=stages).fit(rows)
    model.write().overwrite().save(f"{tmp_path}/m")
    back = PipelineModel.load(f"{tmp_path}/m")
    want = {r.row_id: (r.pred_y, r.unc_z) for r in model.transform(rows).collect()}
    assert {r.row_id: (r.pred_y, r.unc_z) for r in back.transform(rows.drop("y", "z")).collect()} == want and len({v[0] for v in want.values()}) > 3
    featurizer = back.stages[0]
    assert isinstance(featurizer, FeaturizerStageModel) and featurizer.version == model.stages[0].version and "/unfitted" not in featurizer.version
    Pipeline(stages=stages).write().overwrite().save(f"{tmp_path}/p")
    assert Pipeline.load(f"{tmp_path}/p").getStages()[1].getOrDefault("targets") == ["y", "z"]
    with pytest.raises(ValueError):
        Pipeline(stages=[stages[0], TrainerStage(targets=["y"], estimator="magic")]).fit(rows)
    with pytest.raises(RuntimeError):
        FeaturizerStageModel().transform(rows)


def test_slices_by_table_function(spark):
    register_tables(spark)
    rows = [("t", ["a", "b"], 1.0, 0), ("t", ["a"], -3.0, 1), ("t", None, 9.0, 0), ("t", [], 9.0, 1), ("t", ["b"], None, 0), ("u", ["a"], 2.0, 1)]
    df = spark.createDataFrame(rows, "target string, slices array<string>, error double, part int")
    text = "SELECT target, slice, sum(n) AS n, sum(total) AS total FROM slice_sums(TABLE({df}) PARTITION BY {by}) GROUP BY ALL"
    for by in ("target", "(target, part)"):
        found = sorted(tuple(r) for r in spark.sql(text.replace("{by}", by), df=df).collect())
        assert found == [("t", "a", 2, 4.0), ("t", "b", 1, 1.0), ("u", "a", 1, 2.0)]


def test_work_is_cleared_by_application(spark):
    own, other = work_folder(spark, "mine"), f"{shared_root(spark)}/sluice-work/app-of-another/table"
    for path in (own, other):
        spark.range(3).write.parquet(path)
    clear_work(spark)
    assert spark.read.parquet(other).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(own)
