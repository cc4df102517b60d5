"""Queries of models: forests, boosted trees, saved and registered pairs; each with the same in SQL.

Features take few values and targets depend on nothing else, so trees learn them exactly and SQL can tell what they predict.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from .flow_queries import _CUSTOMERS, _SLICED, SLICES, customers, folder
from .functions.tables import register_tables
from .operators.modelling import FEATURES, BoundModel, Featurizer, Trainer, featurizer_from_config, load_stage, save_artifacts, trainer_from_config
from .operators.metrics import bootstrap_shares, exact_resampled_means, slice_names, to_long
from .operators.sampling import stratified_quotas
from .operators.stages import FeaturizerStage, TrainerStage
from .queries import query, table
from .sources.registry import ModelRegistry
from .sources.storage import join, storage_of

__all__ = ["bound_models", "boosted_scores", "exact_resamples", "forest_agreement", "pipeline_stages", "registry_recovery", "slices_by_table_function", "stratified_quota_table", "unusable_models"]

TARGETS = ["steps", "product"]
_CELLS = "c AS (SELECT o_orderkey AS row_id, (o_custkey % 5)::DOUBLE AS a, (o_orderkey % 4)::DOUBLE AS b FROM orders), t AS (SELECT row_id, a, b, 10 * a + b AS steps, a * b + a AS product FROM c)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), (F.col("o_custkey") % 5).cast("double").alias("a"), (F.col("o_orderkey") % 4).cast("double").alias("b"))
    return rows.withColumns({"steps": 10 * F.col("a") + F.col("b"), "product": F.col("a") * F.col("b") + F.col("a")})


@query("SELECT vec_id AS row_id, true AS mean_agrees, true AS spread_agrees FROM embeddings")
def forest_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass evaluator beside the forest's own prediction and a pass for each tree, row by row."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding", F.col("label").cast("double").alias("y"))
    featurizer = Featurizer("columns", columns=("embedding",)).fit(rows)
    model = Trainer(params={"n_estimators": 8, "max_depth": 6}).fit(featurizer.transform(rows), ["y"], featurizer.version)
    made = model.predict(featurizer.transform(rows), with_uncertainty=True)
    forest = model.models["y"]
    made = forest.setPredictionCol("_own").transform(made)
    for k, tree in enumerate(forest.trees):
        made = tree.setFeaturesCol(FEATURES).setPredictionCol(f"_t{k}").transform(made)
    each = F.array(*(F.col(f"_t{k}") for k in range(8)))
    square = F.aggregate(each, F.lit(0.0), lambda s, x: s + (x - F.col("_own")) * (x - F.col("_own"))) / 8
    near = lambda a, b: F.abs(a - b) <= F.lit(1e-9) * (1 + F.abs(b))
    return made.select("row_id", near(F.col("pred_y"), F.col("_own")).alias("mean_agrees"), near(F.col("unc_y"), F.sqrt(square)).alias("spread_agrees"))


@query(f"WITH {_CELLS} SELECT row_id, steps AS pred_steps, product AS pred_product, 0.0::DOUBLE AS unc_steps, 0.0::DOUBLE AS unc_product FROM t")
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees of two targets; they have no spread."""
    rows = cells(spark, sf_dir)
    featurizer = Featurizer("columns", columns=("a", "b")).fit(rows)
    model = trainer_from_config({"estimator": "GBTRegressor", "params": {"max_iter": 2, "max_depth": 6}}).fit(featurizer.transform(rows), TARGETS, featurizer.version)
    made = model.predict(featurizer.transform(rows), with_uncertainty=True)
    return made.select("row_id", *(F.round(f"{kind}_{t}", 6).alias(f"{kind}_{t}") for kind in ("pred", "unc") for t in TARGETS))


@query(f"""WITH {_CELLS}, n AS (SELECT *, steps + 1 AS later FROM t)
SELECT row_id, u.stage, u.version, u.pred, 0.0::DOUBLE AS unc FROM n, LATERAL (VALUES ('production', 'model-1', steps), ('staging', 'model-2', later)) u(stage, version, pred)""")
def bound_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models saved with their featurizers, registered, and loaded by stage: the production one, and the first in staging."""
    root, rows = folder(spark, "models"), cells(spark, sf_dir)
    registry, found = ModelRegistry(join(root, "registry")), []
    for k, target in enumerate((F.col("steps"), F.col("steps") + 1, F.col("steps") - 1), 1):
        data = rows.select("row_id", "a", "b", target.alias("y"))
        featurizer = Featurizer("columns", columns=("a", "b")).fit(data)
        model = Trainer(params={"n_estimators": 6, "max_depth": 6}).fit(featurizer.transform(data), ["y"], featurizer.version)
        at = save_artifacts(join(root, f"made-{k}"), model, featurizer)
        registry.register(f"model-{k}", {"data": f"d{k}", "featurizer": featurizer.version}, {}, {}, artifact_src=at, promote=k == 1)
    for stage in ("production", "staging"):
        bound = load_stage(registry, stage)
        made = bound.score(rows.select("row_id", "a", "b"))
        found.append(made.select("row_id", F.lit(stage).alias("stage"), F.lit(bound.version).alias("version"), F.round("pred_y", 6).alias("pred"), F.round("unc_y", 6).alias("unc")))
    return found[0].unionByName(found[1])


@query("""SELECT u.* FROM (SELECT count(*) AS n FROM orders) o, LATERAL (VALUES ('another featurizer', 'ValueError', n), ('a missing target', 'KeyError', n), ('an empty stage', 'LookupError', n), ('an unfitted featurizer', 'RuntimeError', n),
('an unknown backend', 'ValueError', n), ('an unknown estimator', 'ValueError', n), ('an unknown featurizer', 'ValueError', n), ('refitted on fewer rows', 'other version', n)) u(what, outcome, n)""")
def unusable_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is refused, and by which error: pairs that don't belong together, unfitted parts, unknown kinds."""
    rows = cells(spark, sf_dir)
    featurizer = Featurizer("columns", columns=("a", "b")).fit(rows)
    ready = featurizer.transform(rows)
    model = Trainer(params={"n_estimators": 2, "max_depth": 3}).fit(ready, ["steps"], "columns@other/unfitted")
    empty = ModelRegistry(folder(spark, "registry"))
    attempts = {
        "another featurizer": lambda: BoundModel(model, featurizer).score(rows),
        "a missing target": lambda: Trainer().fit(ready, ["nowhere"]),
        "an empty stage": lambda: load_stage(empty, "staging"),
        "an unfitted featurizer": lambda: Featurizer("columns", columns=("a",)).transform(rows),
        "an unknown backend": lambda: trainer_from_config({"backend": "magic"}),
        "an unknown estimator": lambda: trainer_from_config({"estimator": "magic"}),
        "an unknown featurizer": lambda: featurizer_from_config({"kind": "magic"}),
    }
    outcomes = {}
    for what, attempt in attempts.items():
        try:
            attempt()
            outcomes[what] = "nothing"
        except Exception as e:
            outcomes[what] = type(e).__name__
    fewer = Featurizer("columns", columns=("a", "b")).fit(rows.filter("a < 4"))
    outcomes["refitted on fewer rows"] = "same version" if fewer.version == featurizer.version else "other version"
    said = spark.createDataFrame(list(outcomes.items()), "what string, outcome string")
    return said.crossJoin(ready.agg(F.count(F.when(F.size(vector_to_array(FEATURES)) == 2, 1)).alias("n")))


@query("""WITH p AS (SELECT o_orderpriority AS target, count(*) AS n, round(avg(o_totalprice / 100000 - 1.5), 6) AS delta FROM orders GROUP BY ALL)
SELECT target, b, n::DOUBLE AS weight, delta, true AS p_near FROM p, unnest(range(0, 100)) AS r(b)""")
def exact_resamples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resamples of exactly as many rows as each target has; their share below zero is near that of Poisson sizes."""
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("target"), F.col("o_orderkey").alias("row_id"), (F.col("o_totalprice") / 100_000 - 1.5).alias("d"))
    sums = exact_resampled_means(pairs, 100).select("target", "b", "weight")
    exact, poisson = bootstrap_shares(pairs, 100, 0, "multinomial"), bootstrap_shares(pairs, 100).select("target", F.col("p").alias("other"))
    near = exact.join(poisson, "target").select("target", F.round("delta", 6).alias("delta"), (F.abs(F.col("p") - F.col("other")) <= 0.3).alias("p_near"))  # four deviations of a hundred resamples
    return sums.join(near, "target").select("target", "b", "weight", "delta", "p_near")


@query("""WITH c AS (SELECT o_custkey AS size, count(*) AS n FROM orders WHERE o_custkey > 0 GROUP BY ALL), s AS (SELECT count(*) AS k, greatest(1, 5000 // count(*)) AS share FROM c),
f AS (SELECT size, n, least(n, share) AS first FROM c, s), t AS (SELECT 5000 - sum(first) AS left_, sum(n - first) AS spare FROM f)
SELECT size, (first + CASE WHEN left_ > 0 AND spare > 0 THEN least(n - first, round_even(left_ * (n - first) / spare, 0)) ELSE 0 END)::BIGINT AS quota FROM f, t""")
def stratified_quota_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of five thousand rows over as many sizes as there are customers."""
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("size")).agg(F.count("*").alias("n"))
    return stratified_quotas(counts, 5000)


@query("""WITH r AS (SELECT row_number() OVER (ORDER BY r_regionkey) AS k, r_name, count(*) OVER () AS n FROM region), o AS (SELECT count(*) AS orders FROM orders)
SELECT 'model-' || r_name AS version, CASE WHEN k = n THEN 'production' ELSE 'archived' END AS stage, k AS sequence, orders FROM r, o""")
def registry_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of each region, promoted in turn, though a writer died after each: one left an empty event, one a torn one."""
    registry = ModelRegistry(folder(spark, "registry"), grace=0.2)
    n_orders = table(spark, sf_dir, "orders").count()
    for k, r in enumerate(table(spark, sf_dir, "region").orderBy("r_regionkey").collect()):  # a table of five rows
        registry.register(f"model-{r.r_name}", {"data": r.r_name}, {"orders": n_orders}, {}, promote=True)
        storage_of(registry.root).create(join(registry.root, "events", f"{registry.state().last + 1:08d}.json"), b'{"model": {"vers' if k % 2 else b"")
    frame = registry.as_frame(spark)
    return frame.select("version", "stage", "sequence", F.get_json_object("metrics", "$.orders").cast("long").alias("orders"))


@query(f"WITH {_CELLS} SELECT row_id, steps AS pred_steps, product AS pred_product FROM t")
def pipeline_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featurizer and trainer as stages of a pipeline that is fitted, saved, loaded and applied."""
    rows, path = cells(spark, sf_dir), folder(spark, "stages")
    stages = [FeaturizerStage(columns=["a", "b"]), TrainerStage(targets=TARGETS, settings={"n_estimators": 3, "max_depth": 6})]
    Pipeline(stages=stages).fit(rows).write().overwrite().save(path)
    made = PipelineModel.load(path).transform(rows.select("row_id", "a", "b"))
    return made.select("row_id", *(F.round(f"pred_{t}", 6).alias(f"pred_{t}") for t in TARGETS))


@query(f"WITH {_CUSTOMERS}, {_SLICED} SELECT target, slice, count(*) AS n, round(avg(abs(new - y)), 6) AS mae FROM s GROUP BY ALL")
def slices_by_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of each slice by a table function in SQL; each target's rows are dealt to parts."""
    register_tables(spark)
    rows = customers(spark, sf_dir)
    long = to_long(rows, ["balance", "nation"], {t: f"new_{t}" for t in ("balance", "nation")}, slices=slice_names(SLICES, rows.columns))
    errors = long.select("target", "slices", (F.col("pred") - F.col("y")).alias("error"), F.pmod(F.xxhash64("row_id"), F.lit(32)).alias("part"))
    found = spark.sql("SELECT target, slice, sum(n) AS n, sum(total) / sum(n) AS mae FROM slice_sums(TABLE({errors}) PARTITION BY (target, part)) GROUP BY target, slice", errors=errors)
    return found.select("target", "slice", "n", F.round("mae", 6).alias("mae"))
