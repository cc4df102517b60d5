import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from sluice.operators import forests
from sluice.operators.forests import FlatForest, scores


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(400, 5)), 1)
    rows = [(k, [float(v) for v in r], float(r[0] * 2 + r[1] ** 2), float(r[2]), 7.0) for k, r in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id int, v array<double>, y double, z double, flat double").withColumn("f", array_to_vector("v"))
    path = tmp_path_factory.mktemp("forests")
    models = {}
    for t, trees, depth in (("y", 12, 7), ("z", 3, 3), ("flat", 4, 5)):
        models[t] = RandomForestRegressor(featuresCol="f", labelCol=t, numTrees=trees, maxDepth=depth, seed=5).fit(df)
        models[t].write().save(f"{path}/{t}")
    return df, models, FlatForest.read(spark, [(t, f"{path}/{t}") for t in models])


def test_equals_trees_one_by_one(spark, trained, monkeypatch):
    df, models, flat = trained
    odd = spark.createDataFrame([(1000, [math.nan] * 5, 0.0, 0.0, 0.0), (1001, [math.inf, -math.inf, 0.0, -0.0, 1e300], 0.0, 0.0, 0.0)], "row_id int, v array<double>, y double, z double, flat double")
    every = df.unionByName(odd.withColumn("f", array_to_vector("v"))).repartition(3)
    got = {r.row_id: r.s for r in every.select("row_id", scores(spark, flat, vector_to_array("f")).alias("s")).collect()}
    assert len(got) == 402
    for t, model in models.items():
        own = every
        for k, tree in enumerate(model.trees):
            own = tree.setPredictionCol(f"t{k}").transform(own)
        for r in own.select("row_id", *(f"t{k}" for k in range(len(model.trees)))).collect():
            each = np.array(r[1:])
            assert got[r.row_id][f"pred_{t}"] == pytest.approx(each.mean(), rel=1e-12) and got[r.row_id][f"unc_{t}"] == pytest.approx(each.std(), abs=1e-9)
    assert {got[k]["unc_flat"] for k in got} == {0.0} and len({got[k]["unc_y"] for k in got}) > 50
    x = np.array([r.v for r in df.orderBy("row_id").collect()])
    whole = flat.means_and_spreads(x)
    monkeypatch.setattr(forests, "CELLS", 40)  # a few rows at a time
    assert all((a == b).all() for p, q in zip(whole, flat.means_and_spreads(x), strict=True) for a, b in zip(p, q, strict=True))
    assert flat.means_and_spreads(np.zeros((0, 5)))[0][0].shape == (0,)


def test_plan_does_not_grow_with_trees(spark, trained):
    df, _, flat = trained
    plan = df.select("row_id", scores(spark, flat, vector_to_array("f")).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and len(plan.strip().splitlines()) <= 6 and len(flat.roots) == 19


def test_bounds(spark, trained, monkeypatch, tmp_path):
    df, models, flat = trained
    models["z"].write().save(f"{tmp_path}/z")
    monkeypatch.setattr(forests, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="more than are broadcast"):
        FlatForest.read(spark, [("z", f"{tmp_path}/z")])
    nodes = spark.read.parquet(f"{tmp_path}/z/data")
    nodes.filter("nodeData.id <> 1").write.parquet(f"{tmp_path}/broken/data")
    with pytest.raises(ValueError, match="lacks nodes"):
        FlatForest.read(spark, [("z", f"{tmp_path}/broken")])
    assert df.filter(F.lit(False)).select(scores(spark, flat, vector_to_array("f"))).collect() == []
