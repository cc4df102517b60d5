"""Queries of reports and promotion, registry, files, chunks, lifecycle and triage, each with the same in SQL.

What a flow keeps in files, it keeps below the session's shared folder here.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.identity import config_hash, rows_hash
from .functions.shared import work_folder as folder
from .operators.decisions import Versions, merge_decisions
from .operators.drift import freeze_reference, quantile_grids
from .operators.gates import CompositeGate, DriftGate, Gate, GateContext, NoTargetRegressionGate, SignificanceGate, drift_threshold, promotion_gate, shortlist_gate, validation_gate
from .operators.metrics import POISSON, EvalReport, bootstrap_shares, evaluate, normalized_score, paired_differences, slice_names, summarise, to_long
from .operators.modelling import Featurizer, MeanBaseline
from .operators.profile import chunk_drift_matrix as drift_matrix, findings, model_trajectory, per_target_metrics, slice_table
from .operators.sampling import holdout_split, leakage, mark_holdout, split_into_chunks
from .plans.lifecycle import rows_of_last, rows_up_to, run_lifecycle, with_slice_columns
from .plans.triage import annotate_shortlist, run_triage
from .queries import _KS, _PRED, _ROWS_HASH, _SCORED, _SPLIT, _YEARS, ORACLE_SQL, QUERIES, SHORTLIST, _parts, decide, orders_by_year, price_predictions, query, rounded, scored_orders, table
from .sources.chunks import Chunk, load_chunks, prepare_dataset, read_csv, source_from_config, union_frames, write_csv
from .sources.manifest import RunManifest
from .sources.provenance import write_profile
from .sources.registry import ModelRegistry
from .sources.storage import join, read_bytes, storage_of
from .streaming.arrival import new_contents, stream_arrivals, unseen


__all__ = ["ORACLE_SQL", "QUERIES", "folder"]


# ---- reports of models ----


SLICES = {"auto": {"column": "auto"}, "nations": {"column": "nk", "bins": [0, 10, 25]}}
TARGETS = ["balance", "nation"]
RESAMPLES = 100


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with two numbers and a newer and an older prediction of each."""
    w = F.col("c_custkey") % 3 - 1
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("nk"), (F.col("c_mktsegment") == "AUTOMOBILE").alias("auto"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation"), w.alias("w")
    )
    return rows.withColumns({"new_balance": F.col("balance") * 0.8 + 900, "old_balance": F.col("balance") * 0.75 + 1000, "new_nation": F.col("nation") + 0.5 * F.col("w"), "old_nation": F.col("nation") + 0.6 * F.col("w")})


_CUSTOMERS = """c AS (SELECT c_custkey AS row_id, c_nationkey AS nk, c_mktsegment = 'AUTOMOBILE' AS auto, c_acctbal AS balance, c_nationkey::DOUBLE AS nation, c_custkey % 3 - 1 AS w FROM customer),
p AS (SELECT row_id, nk, auto, u.target, u.y, u.new, u.old FROM c,
  LATERAL (VALUES ('balance', balance, balance * 0.8 + 900, balance * 0.75 + 1000), ('nation', nation, nation + 0.5 * w, nation + 0.6 * w)) u(target, y, new, old)),
means AS (SELECT target, avg(y) AS mean, stddev_pop(y) AS sd FROM p GROUP BY target),
m AS (SELECT p.target, count(*) AS n, avg(abs(new - y)) AS new, avg(abs(old - y)) AS old, avg(abs(mean - y)) AS base, sqrt(avg((new - y) ^ 2)) AS rmse, any_value(sd) AS sd FROM p JOIN means ON means.target = p.target GROUP BY p.target)"""
_SLICED = """s AS (
  SELECT p.target, y, new, old, sd, CASE WHEN auto THEN 'auto=true' ELSE 'auto=false' END AS slice FROM p JOIN means ON means.target = p.target
  UNION ALL SELECT p.target, y, new, old, sd, CASE WHEN nk < 10 THEN 'nations[0-10)' ELSE 'nations[10-25)' END FROM p JOIN means ON means.target = p.target WHERE nk >= 0 AND nk < 25),
st AS (SELECT slice, target, avg(abs(new - y)) / any_value(sd) AS new, avg(abs(old - y)) / any_value(sd) AS old, count(*) AS n FROM s GROUP BY slice, target),
sl AS (SELECT slice, avg(new) AS new, avg(old) AS old, max(n) AS n FROM st GROUP BY slice HAVING max(n) >= 20)"""


def customer_report(spark: SparkSession, sf_dir: str, which: str) -> EvalReport:
    rows = customers(spark, sf_dir)
    if which == "baseline":
        long = to_long(MeanBaseline(TARGETS).fit(rows).predict(rows), TARGETS, {t: f"pred_{t}" for t in TARGETS})
    else:
        long = to_long(rows, TARGETS, {t: f"{which}_{t}" for t in TARGETS}, slices=slice_names(SLICES, rows.columns))
    return evaluate(long, which, "customers", TARGETS, with_slices=which != "baseline")


@query(f"""WITH {_CUSTOMERS} SELECT target, n, round(new, 6) AS mae, round(rmse, 6) AS rmse, round(1 - rmse ^ 2 / sd ^ 2, 6) AS r2, round(sd, 6) AS std FROM m""")
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets projected to long form and evaluated in one report."""
    found = customer_report(spark, sf_dir, "new")
    rows = [(t, m.n, round(m.mae, 6), round(m.rmse, 6), round(m.r2, 6), round(found.target_std[t], 6)) for t, m in found.per_target.items()]
    return spark.createDataFrame(rows, "target string, n long, mae double, rmse double, r2 double, std double")


def price_reports(spark: SparkSession, sf_dir: str) -> tuple[EvalReport, EvalReport]:
    long = price_predictions(spark, sf_dir).withColumns({"row_id": F.lit(0), "slices": F.array().cast("array<string>")})
    targets = ["price", "discount", "tax"]
    return evaluate(long, "new", "lines", targets, False), evaluate(long.withColumn("pred", F.col("old")), "old", "lines", targets, False)


@query(f"""WITH {_PRED}, m AS (SELECT target, avg(abs(pred - y)) / stddev_pop(y) AS new, avg(abs(old - y)) / stddev_pop(y) AS old FROM p GROUP BY target)
SELECT round(avg(new), 6) AS candidate, round(avg(old), 6) AS incumbent FROM m""")
def normalized_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the margin is decided on."""
    new, old = price_reports(spark, sf_dir)
    return spark.createDataFrame([(round(normalized_score(new), 6), round(normalized_score(old), 6))], "candidate double, incumbent double")


@query(f"""WITH {_PRED} SELECT target, round((avg(abs(pred - y)) - avg(abs(old - y))) / avg(abs(old - y)), 6) AS change,
(avg(abs(pred - y)) - avg(abs(old - y))) / avg(abs(old - y)) > 0.05 AS regressed FROM p GROUP BY target""")
def target_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = price_reports(spark, sf_dir)
    _, _, evidence = NoTargetRegressionGate(0.05).decide(GateContext(candidate=new, incumbent=old), {})
    return spark.createDataFrame([(t, round(x, 6), t in evidence["regressed"]) for t, x in evidence["relative_change"].items()], "target string, change double, regressed boolean")


@query(f"""WITH {_CUSTOMERS} SELECT p.target, row_id, round((abs(old - y) - abs(new - y)) / sd, 6) AS d FROM p JOIN means ON means.target = p.target""")
def paired_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of two models joined by row and target."""
    pairs = paired_differences(customer_report(spark, sf_dir, "new"), customer_report(spark, sf_dir, "old"))
    return pairs.select("target", "row_id", rounded("d").alias("d"))


_MIX = "(x * x + 48271 * x + b) % 2147483647"


def _bootstrap_sql(pairs: str, n_resamples: int, name: str) -> str:
    """CTEs up to ``name`` (target, delta, p) of pairs (target, row_id, d)."""
    thresholds = ", ".join(map(str, POISSON))
    return f"""{name}_x0 AS (SELECT target, d, b, (row_id % 2147483647 * 1000003 + b * 7919 + 12345) % 2147483647 AS x FROM {pairs}, unnest(range(0, {n_resamples})) AS r(b)),
{name}_x1 AS (SELECT target, d, b, {_MIX} AS x FROM {name}_x0), {name}_x2 AS (SELECT target, d, b, {_MIX} AS x FROM {name}_x1), {name}_x3 AS (SELECT target, d, b, {_MIX} AS x FROM {name}_x2),
{name}_t AS (SELECT target, b, sum(d * len(list_filter([{thresholds}], lambda t: t <= x / 2147483647.0::DOUBLE))) AS total FROM {name}_x3 GROUP BY target, b),
{name}_p AS (SELECT target, avg(CASE WHEN total <= 0 THEN 1.0 ELSE 0.0 END) AS p FROM {name}_t GROUP BY target),
{name} AS (SELECT q.target, q.delta, {name}_p.p FROM (SELECT target, avg(d) AS delta FROM {pairs} GROUP BY target) q JOIN {name}_p ON {name}_p.target = q.target)"""


@query(f"""WITH s AS (SELECT 'balance' AS target, s_suppkey AS row_id, s_acctbal / 1000 - 4 AS d FROM supplier), {_bootstrap_sql("s", 200, "boot")}
SELECT target, round(delta, 6) AS delta, round(p, 6) AS p FROM boot""")
def paired_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resampling of suppliers by hash, distributed."""
    pairs = table(spark, sf_dir, "supplier").select(F.lit("balance").alias("target"), F.col("s_suppkey").alias("row_id"), (F.col("s_acctbal") / 1000 - 4).alias("d"))
    return bootstrap_shares(pairs, 200).select("target", rounded("delta").alias("delta"), rounded("p").alias("p"))


_PAIRS = "pairs AS (SELECT p.target, row_id, (abs(old - y) - abs(new - y)) / sd AS d FROM p JOIN means ON means.target = p.target)"


@query(f"""WITH {_CUSTOMERS}, {_PAIRS}, {_bootstrap_sql("pairs", RESAMPLES, "boot")}
SELECT target, round(delta, 6) AS delta, round(p, 6) AS p, round((SELECT avg(p) FROM boot), 6) AS pooled, (SELECT avg(p) FROM boot) <= 0.05 AS significant FROM boot""")
def significance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each target's share of resamples, and the mean of these that decides."""
    ctx = GateContext(candidate=customer_report(spark, sf_dir, "new"), incumbent=customer_report(spark, sf_dir, "old"))
    verdict, _, evidence = SignificanceGate(0.05, RESAMPLES).decide(ctx, {})
    rows = [(t, round(x["delta"], 6), round(x["p"], 6), round(evidence["p_value"], 6), verdict) for t, x in evidence["per_target"].items()]
    return spark.createDataFrame(rows, "target string, delta double, p double, pooled double, significant boolean")


@query(f"""WITH {_CUSTOMERS}, {_SLICED}, {_PAIRS}, {_bootstrap_sql("pairs", RESAMPLES, "boot")},
a AS (SELECT avg(new / sd) AS new, avg(old / sd) AS old, avg(base / sd) AS base, max((new - old) / old) AS worst FROM m),
v AS (SELECT (old - new) / old >= 0.01 AS margin, (base - new) / base >= 0.2 AS cold, worst <= 0.05 AS targets, (SELECT avg(p) FROM boot) <= 0.05 AS significant, (SELECT max((new - old) / old) FROM sl) <= 0.1 AS slices FROM a)
SELECT u.* FROM v, LATERAL (VALUES
  ('against:sanity', true), ('against:featurizer_binding', true), ('against:cold_start', true), ('against:min_margin', margin), ('against:significance', significant), ('against:no_target_regression', targets), ('against:slices', slices),
  ('alone:sanity', true), ('alone:featurizer_binding', false), ('alone:cold_start', cold), ('alone:min_margin', true), ('alone:significance', true), ('alone:no_target_regression', true), ('alone:slices', true)) u("check", verdict)""")
def promotion_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All promotion checks, once against an incumbent and once without one and with a stale featurizer, merged."""
    new, versions = customer_report(spark, sf_dir, "new"), Versions(featurizer="f1")
    gate = promotion_gate(n_resamples=RESAMPLES)
    against = gate.evaluate(GateContext(candidate=new, incumbent=customer_report(spark, sf_dir, "old"), versions=versions, expected_featurizer="f1"))
    alone = gate.evaluate(GateContext(candidate=new, baseline=customer_report(spark, sf_dir, "baseline"), versions=versions, expected_featurizer="f2"))
    merged = merge_decisions({"against": against, "alone": alone})
    return spark.createDataFrame([(r.name, r.verdict) for r in merged.results], "check string, verdict boolean")


# ---- the registry and its tables ----


def two_models(spark: SparkSession, sf_dir: str) -> ModelRegistry:
    """An older and a newer model with their metrics; the newer one failed a check."""
    registry = ModelRegistry(folder(spark, "registry"))
    for version, which, verdict in (("model-20240101-aaaaaa", "old", True), ("model-20240102-bbbbbb", "new", False)):
        checks = {"verdict": verdict, "results": [{"name": "sanity", "verdict": True, "blocking": True}, {"name": "slices", "verdict": verdict, "blocking": True}]}
        registry.register(version, {"data": which}, {"golden": summarise(customer_report(spark, sf_dir, which))}, checks, "staging" if verdict else "rejected", promote=verdict)
    return registry


@query(f"""WITH {_CUSTOMERS}, a AS (SELECT round(avg(new / sd), 6) AS new, round(avg(old / sd), 6) AS old FROM m)
SELECT u.* FROM a, LATERAL (VALUES ('model-20240101-aaaaaa', 'production', old, ''), ('model-20240102-bbbbbb', 'rejected', new, 'slices')) u(version, stage, score, failed)""")
def registry_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_trajectory(two_models(spark, sf_dir).as_frame(spark)).select("version", "stage", rounded("score").alias("score"), "failed")


@query(f"""WITH {_CUSTOMERS} SELECT u.version, target, round(u.mae, 6) AS mae FROM m, LATERAL (VALUES ('240101-aaaaaa', old), ('240102-bbbbbb', new)) u(version, mae)""")
def registry_target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_target_metrics(two_models(spark, sf_dir).as_frame(spark)).withColumn("mae", rounded("mae"))


@query(f"WITH {_CUSTOMERS}, {_SLICED} SELECT slice, round(new, 6) AS normalized_mae, n FROM sl")
def registry_slice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_table(two_models(spark, sf_dir).as_frame(spark), "model-20240102-bbbbbb").withColumn("normalized_mae", rounded("normalized_mae"))


@query("""WITH r AS (SELECT row_number() OVER (ORDER BY r_regionkey) AS k, 'model-' || r_name AS version, r_name AS data, count(*) OVER () AS n FROM region)
SELECT version, CASE WHEN k = n - 1 THEN 'production' ELSE 'archived' END AS stage, data, k AS sequence, k = 2 AS found, k = n - 1 AS live FROM r""")
def registry_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of each region registered and promoted in turn, and one step back."""
    registry = ModelRegistry(folder(spark, "registry"))
    names = [r.r_name for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect()]  # a table of five rows
    for name in names:
        registry.register(f"model-{name}", {"data": name}, {}, {})
        registry.promote(f"model-{name}")
    registry.rollback()
    live, found = registry.production().version, registry.find_by_data_version(names[1]).version
    frame = registry.as_frame(spark)
    return frame.select("version", "stage", F.col("versions")["data"].alias("data"), "sequence", (F.col("version") == found).alias("found"), (F.col("version") == live).alias("live"))


@query("""SELECT 'lifecycle' AS pipeline, 'promoted' AS status, r_name AS data, r_regionkey::BIGINT AS rows, 'validated' AS event,
'sha256:' || substr(sha256('{"k":' || r_regionkey || ',"name":"' || r_name || '"}'), 1, 16) AS config FROM region""")
def run_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests written as files and read back."""
    path = folder(spark, "manifests")
    for r in table(spark, sf_dir, "region").collect():  # a table of five rows
        manifest = RunManifest.start(f"run-{r.r_name}", "lifecycle", Versions(data=r.r_name, config=config_hash({"name": r.r_name, "k": r.r_regionkey})), rows=r.r_regionkey)
        manifest.event("validated", n=1)
        manifest.finish("promoted").write(join(path, f"{r.r_regionkey}.json"))
    rows = [json.loads(read_bytes(join(path, f.name))) for f in storage_of(path).files(path)]
    return spark.createDataFrame([(m["pipeline"], m["status"], m["versions"]["data"], m["inputs"]["rows"], m["events"][0]["kind"], m["versions"]["config"]) for m in rows], "pipeline string, status string, data string, rows long, event string, config string")


# ---- checks from configuration ----


@query("""WITH d AS (SELECT documents.doc_id, text, quality, toxic FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id),
f AS (SELECT count(*) AS n, count(*) - count(DISTINCT text) AS dups, count(*) FILTER (quality IS NULL OR toxic IS NULL) AS bad FROM d)
SELECT u.* FROM f, LATERAL (VALUES ('schema', true, NULL::DOUBLE), ('min_rows', n >= 50, NULL), ('duplicates', dups / n <= 0.05, round(dups / n, 6)), ('target_nan', bad / n <= 0.3, round(bad / n, 6))) u("check", verdict, fraction)""")
def validation_from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    frame = docs.join(table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "row_id"), "row_id", "left")
    cfg = {"checks": {"target_nan": {"max_fraction": 0.3}, "duplicates": {"max_fraction": 0.05, "subset": ["text"]}, "min_rows": 50, "schema": {"required_columns": ["row_id", "text"]}}}
    found = validation_gate(cfg, ["quality", "toxic"]).evaluate(GateContext(frame=frame))
    rows = [(r.name, r.verdict, round(r.evidence["fraction"], 6) if "fraction" in r.evidence else None) for r in found.results]
    return spark.createDataFrame(rows, "check string, verdict boolean, fraction double")


@query(f"""WITH {_SCORED}, r AS (SELECT *, row_number() OVER (ORDER BY score, row_id) - 1 AS rank FROM orders_scored)
SELECT row_id, rank, rank < 300 AND unc > 100000 AS selected, CASE WHEN unc <= 100000 THEN 'acquisition[price]' WHEN rank >= 300 THEN 'top_300[price]' ELSE '' END AS dropped_by FROM r""")
def shortlist_from_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest scores, as a top-k check takes them unless it is told otherwise."""
    gate = shortlist_gate([{"kind": "uncertainty", "target": "price", "max_uncertainty": 100_000, "invert": True}, {"kind": "top_k", "target": "price", "k": 300}])
    ctx = GateContext(frame=scored_orders(spark, sf_dir), scores={"price": "score"}, uncertainty={"price": "unc"}, versions=Versions(featurizer="f"), expected_featurizer="f")
    return annotate_shortlist(gate.evaluate(ctx)).select("row_id", "rank", "selected", "dropped_by")


_STRUCTURES = "CASE p_partkey % 5 WHEN 0 THEN repeat('C', p_size) WHEN 1 THEN 'C(((' WHEN 2 THEN NULL WHEN 3 THEN 'c1ccccc1' ELSE repeat('C', p_size) || 'F' END"


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains by size, rings and junk."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.expr(_STRUCTURES).alias("smiles"))


@query("""SELECT p_partkey AS row_id, p_partkey % 5 IN (0, 3, 4) AS kept, (SELECT avg((p_partkey % 5 IN (0, 3, 4))::INT) FROM part) >= 0.5 AS verdict FROM part""")
def parseable_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = {"checks": {"parseable_smiles": {"min_fraction": 0.5}}}
    found = validation_gate(cfg).evaluate(GateContext(frame=structures(spark, sf_dir)))
    return found.frame.select("row_id", F.col(found.masks[0][1]).alias("kept"), F.lit(found.verdict).alias("verdict"))


@query("""SELECT p_partkey AS row_id, CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 3 THEN 6 ELSE p_size + 1 END AS n_heavy_atoms, p_partkey % 5 = 4 AS has_F,
CASE WHEN p_partkey % 5 = 3 THEN 1 ELSE 0 END AS n_rings FROM part WHERE p_partkey % 5 IN (0, 3, 4)""")
def structure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that slices are cut on."""
    spec = {"size": {"column": "n_heavy_atoms", "bins": [0, 10]}, "F": {"column": "has_F"}, "rings": {"column": "n_rings", "bins": [0, 1]}}
    rows = structures(spark, sf_dir).filter(F.col("row_id") % 5 != 1).filter("smiles is not null")
    return with_slice_columns(rows, spec).select("row_id", F.col("n_heavy_atoms").cast("int"), "has_F", F.col("n_rings").cast("int"))


# ---- drift ----


_FROZEN = f"""{_YEARS}, g AS (SELECT unnest(quantile_cont(price, list_transform(range(0, 401), lambda k: k / 400))) AS v FROM o, y0 WHERE year = y),
t AS (SELECT price AS v FROM o, y0 WHERE year > y),
c AS (SELECT v, sum(s) AS s, sum(r) AS r FROM (SELECT v, 1 AS s, 0 AS r FROM t UNION ALL SELECT v, 0, 1 FROM g) GROUP BY v),
e AS (SELECT sum(s) OVER (ORDER BY v) AS cs, sum(r) OVER (ORDER BY v) AS cr FROM c),
k AS (SELECT max(abs(cs / (SELECT count(*) FROM t) - cr / 401)) AS ks FROM e)"""


@query(f"""WITH {_FROZEN} SELECT u.method, u.verdict, u.blocking, u.worst_column, u.maximum, u.worst FROM k, LATERAL (VALUES
('ks', ks <= 0.03, false, 'price', 0.03::DOUBLE, round(ks, 6)), ('none', true, false, NULL, NULL, NULL)) u(method, verdict, blocking, worst_column, maximum, worst)""")
def drift_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later years against the first one's frozen grid, kept as a file; and a check whose reference isn't there yet."""
    orders = orders_by_year(spark, sf_dir)
    first = orders.agg(F.min("year")).first()[0]
    path = freeze_reference(orders.filter(F.col("year") == first), ["price"]).save(join(folder(spark, "reference"), "reference.json"))
    later = orders.filter(F.col("year") > first)
    gate = DriftGate(path, drift_threshold({"max_statistic": {"ks": 0.03}}, "ks"))
    verdict, _, found = gate.decide(GateContext(frame=later), {})
    unknown, _, nothing = DriftGate(path + ".absent").decide(GateContext(frame=later), {})
    rows = [("ks", verdict, gate.blocking, found["worst_column"], found["maximum"], round(found["worst"], 6)), ("none", unknown, False, nothing.get("worst_column"), None, None)]
    return spark.createDataFrame(rows, "method string, verdict boolean, blocking boolean, worst_column string, maximum double, worst double")


@query(f"""WITH k AS ({_KS}) SELECT year, max(ks) FILTER ("column" = 'bucket') AS bucket, max(ks) FILTER ("column" = 'price') AS price FROM k GROUP BY year""")
def chunk_drift_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each chunk, one column for each target."""
    orders = orders_by_year(spark, sf_dir)
    first = orders.join(F.broadcast(orders.agg(F.min("year").alias("year"))), "year")
    return drift_matrix(orders, first, ["bucket", "price"], "year").select("year", rounded("bucket").alias("bucket"), rounded("price").alias("price"))


@query(f"""WITH k AS ({_KS}), z AS (SELECT o_orderkey % 50 AS size, count(*) AS n FROM orders GROUP BY ALL),
d AS (SELECT stddev_pop(o_totalprice) AS a, stddev_pop((o_custkey % 97)::DOUBLE) AS b FROM orders)
SELECT u.name, round(u.value, 6) AS value FROM (SELECT count(*) AS n FROM orders) o, (SELECT max(n) AS n FROM z) z, d, (SELECT max(ks) AS ks FROM k) k,
LATERAL (VALUES ('n_rows', o.n::DOUBLE), ('n_largest', z.n::DOUBLE), ('scale_orders', round_even(log10(greatest(a, b) / least(a, b)), 2)), ('max_ks', ks), ('r2_price', (SELECT regr_r2(o_totalprice, o_orderkey % 50) FROM orders)), ('r2_bucket', (SELECT regr_r2((o_custkey % 97)::DOUBLE, o_orderkey % 50) FROM orders))) u(name, value)""")
def headline_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline numbers of a table, one row each."""
    rows = orders_by_year(spark, sf_dir).select(F.col("o_orderkey").alias("row_id"), F.col("year").cast("string").alias("chunk_id"), "price", "bucket", F.pmod("o_orderkey", F.lit(50)).alias("size"))
    found = findings(rows, rows, ["price", "bucket"], "size", ["size"])
    numbers = {"n_rows": found["n_rows"], "n_largest": found["fraction_largest"] * found["n_rows"], "scale_orders": found["scale_orders"], "max_ks": found["max_ks"]}
    numbers |= {f"r2_{c}": r2 for c, r2 in found["r2_from_counts"].items()}
    return spark.createDataFrame([(k, round(float(v), 6)) for k, v in numbers.items()], "name string, value double")


@query("""SELECT event_type, u.k::INT - 1 AS k, round(u.v, 6) AS quantile FROM (SELECT event_type, quantile_cont(value, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM events GROUP BY event_type), unnest(q) WITH ORDINALITY AS u(v, k)""")
def quantiles_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of groups in one job."""
    grids = quantile_grids(table(spark, sf_dir, "events"), ["value"], 5, ["event_type"])
    return grids.select("event_type", F.posexplode("quantiles").alias("k", "v")).select("event_type", "k", rounded("v").alias("quantile"))


# ---- samples and training sets ----


_HELD = """WITH o AS (SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY sha256('seed' || year || '#' || o_orderkey), o_orderkey) AS k, count(*) OVER (PARTITION BY year) AS n FROM o)
SELECT o_orderkey, year, k <= CASE WHEN n < 2 THEN 0 ELSE least(n - 1, greatest(1, round_even(n * 0.2, 0)::BIGINT)) END AS held FROM n"""


@query(_HELD)
def holdout_by_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of every chunk in one job; the same seed and content give the same rows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return mark_holdout(orders, 0.2, F.concat(F.lit("seed"), F.col("year").cast("string")), "year", "o_orderkey")


@query("""WITH n AS (SELECT s_suppkey, row_number() OVER (ORDER BY sha256('seed#' || s_suppkey), s_suppkey) AS k, count(*) OVER () AS n FROM supplier)
SELECT s_suppkey, k <= CASE WHEN n < 2 THEN 0 ELSE least(n - 1, greatest(1, round_even(n * 0.25, 0)::BIGINT)) END AS held FROM n""")
def holdout_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, held = holdout_split(table(spark, sf_dir, "supplier").select("s_suppkey"), 0.25, "seed", "s_suppkey")
    return kept.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("chunk_id"))


@query("SELECT o_orderkey, year(o_orderdate)::VARCHAR AS chunk_id FROM orders WHERE year(o_orderdate) <= 1997")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks up to a given one."""
    return rows_up_to(yearly(spark, sf_dir), "1997")


@query("SELECT o_orderkey, year(o_orderdate)::VARCHAR AS chunk_id FROM orders WHERE year(o_orderdate) IN (SELECT DISTINCT year(o_orderdate) AS y FROM orders ORDER BY y DESC LIMIT 2)")
def last_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last two chunks."""
    return rows_of_last(yearly(spark, sf_dir), 2).select("o_orderkey", "chunk_id")


@query("""SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND text IN (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
UNION ALL SELECT item_id, 'benchmark' FROM benchmark WHERE text IN (SELECT text FROM documents)""")
def leaking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden rows that training rows repeat: documents without labels that have the text of one with, and benchmark items that are documents."""
    docs, bench, labels = (table(spark, sf_dir, n) for n in ("documents", "benchmark", "labels"))
    labelled, others = docs.join(labels, "doc_id", "left_semi"), docs.join(labels, "doc_id", "left_anti")
    a = leakage(labelled, others.select("doc_id", "lang", "text"), ["text"])
    b = leakage(docs, bench.select(F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("lang"), "text"), ["text"])
    return a.select("doc_id", "lang").unionByName(b.select("doc_id", "lang"))


@query("""SELECT k::INT - 1 AS k, round(avg(v), 6) AS mean, round(CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END, 6) AS std, (SELECT count(*) FROM embeddings) AS n
FROM (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings) GROUP BY k""")
def featurizer_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and deviations by place of an array column, as a featurizer learns them."""
    state = Featurizer("columns", columns=("embedding",)).fit(table(spark, sf_dir, "embeddings")).state
    return spark.createDataFrame([(k, round(m, 6), round(s, 6), state.n_train_rows) for k, (m, s) in enumerate(zip(state.mean, state.std, strict=True))], "k int, mean double, std double, n long")


# ---- chunks and files ----


@query(f"""WITH {_SPLIT}, b AS (SELECT row_id, size, row_number() OVER (ORDER BY position) - 1 AS k FROM g WHERE chunk = (SELECT max(chunk) FROM g) AND NOT d <= round_even(size_of_chunk * 0.15, 0))
SELECT 'candidates' AS kind, format('cand-{{:04d}}', k) AS name, size FROM b WHERE k < 40
UNION ALL SELECT 'golden', row_id::VARCHAR, size FROM g WHERE d <= round_even(size_of_chunk * 0.15, 0)
UNION ALL SELECT 'chunk ' || chunk, row_id::VARCHAR, size FROM g WHERE NOT d <= round_even(size_of_chunk * 0.15, 0)""")
def prepared_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks, golden set and numbered candidates without labels, as files."""
    path = folder(spark, "prepared")
    prepare_dataset(split_into_chunks(_parts(spark, sf_dir), "size", 600, 6, 0.15, "0"), path, [], 40)
    read = lambda n: read_csv(spark, join(path, n), ["size"])
    candidates = read("candidates.csv").select(F.lit("candidates").alias("kind"), F.col("candidate_id").alias("name"), F.col("size").cast("int").alias("size"))
    golden = spark.read.csv(join(path, "golden.csv"), header=True).select(F.lit("golden").alias("kind"), F.col("row_id").alias("name"), F.col("size").cast("int").alias("size"))
    chunks = spark.read.parquet(join(path, "chunks")).select(F.concat(F.lit("chunk "), F.col("chunk").cast("string")).alias("kind"), F.col("row_id").cast("string").alias("name"), F.col("size").cast("int").alias("size"))
    return candidates.unionByName(golden).unionByName(chunks)


@query(f"""WITH {_SCORED}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, row_id) - 1 AS rank FROM orders_scored),
s AS (SELECT row_id, rank FROM r WHERE score >= 50000 AND score <= 350000 AND unc <= 120000 AND rank < 5000)
SELECT row_id, rank, row_number() OVER (ORDER BY rank) - 1 AS place FROM s""")
def shortlist_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shortlist written as one file in the order of ranks; ``place`` is the line."""
    rows = annotate_shortlist(decide(scored_orders(spark, sf_dir), SHORTLIST)).filter("selected").withColumnRenamed("row_id", "key").select("key", "rank")
    path = write_csv(rows, join(folder(spark, "shortlist"), "shortlist.csv"), ["rank"])
    return read_csv(spark, path).select(F.col("key").cast("long").alias("row_id"), F.col("rank").cast("long").alias("rank"), F.col("row_id").alias("place"))


def region_files(spark: SparkSession, sf_dir: str) -> str:
    """A chunk file of each region's nations; the first region's comes twice."""
    path = folder(spark, "chunks")
    rows = table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()  # a table of 25 rows
    regions = sorted({r.n_regionkey for r in rows})
    for k, region in [*enumerate(regions), (len(regions), regions[0])]:
        lines = ["name,gap", *(f"{'NA' if r.n_nationkey % 7 == 0 else r.n_name},{r.n_nationkey / 4}" for r in rows if r.n_regionkey == region)]
        storage_of(path).write(join(path, f"chunk_{k}.csv"), ("\n".join(lines) + "\n").encode())
    return path


_FILES = """l AS (SELECT n_regionkey AS region, n_nationkey AS k, CASE WHEN n_nationkey % 7 = 0 THEN 'NA' ELSE n_name END AS name, n_nationkey / 4 AS gap FROM nation),
f0 AS (SELECT region, dense_rank() OVER (ORDER BY region) - 1 AS file, k, name, gap FROM l), f AS (SELECT * FROM f0 UNION ALL SELECT region, (SELECT count(DISTINCT region) FROM l), k, name, gap FROM f0 WHERE file = 0),
v AS (SELECT file, 'sha256:' || substr(sha256('name,gap' || chr(10) || string_agg(name || ',' || gap, chr(10) ORDER BY k) || chr(10)), 1, 16) AS version FROM f GROUP BY file)"""


@query(f"""WITH {_FILES} SELECT 'chunk_' || file AS chunk_id, row_number() OVER (PARTITION BY file ORDER BY k) - 1 AS row_id, CASE WHEN name = 'NA' THEN NULL ELSE name END AS name, gap::DOUBLE AS gap FROM f""")
def chunks_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of a folder as one frame, with row ids and missing values."""
    return load_chunks(spark, region_files(spark, sf_dir)).select("chunk_id", "row_id", "name", "gap")


@query(f"WITH {_FILES} SELECT 'source' AS found_by, 'chunk_' || file AS chunk, version FROM v UNION ALL SELECT 'stream', 'chunk_' || file, version FROM v UNION ALL SELECT 'new', 'chunk_' || file, version FROM v WHERE version <> (SELECT version FROM v WHERE file = 0)")
def arriving_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by content: as a source lists them, as a stream brings them, and those that no model knows."""
    path = region_files(spark, sf_dir)
    chunks = source_from_config(spark, {"kind": "csv_chunks", "path": path}).chunks()
    rows = [("source", c.chunk_id, c.data_version) for c in chunks]
    stem = lambda p: p.rpartition("/")[2].removesuffix(".csv")
    stream_arrivals(spark, path, "chunk_*.csv", folder(spark, "progress"), lambda p, v: rows.append(("stream", stem(p), v))).awaitTermination()
    registry = ModelRegistry(folder(spark, "registry"))
    registry.register("m", {"data": chunks[0].data_version}, {}, {})
    rows += [("new", stem(r.path), r.data_version) for r in new_contents(spark, path, "chunk_*.csv", registry.as_frame(spark)).collect()]
    return spark.createDataFrame(rows, "found_by string, chunk string, version string")


@query("""SELECT 'orders' AS chunk_id, o_orderkey AS id, o_totalprice AS value, NULL::VARCHAR AS note FROM orders UNION ALL SELECT 'suppliers', s_suppkey, s_acctbal, s_name FROM supplier""")
def unioned_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with different columns as one frame; what a chunk lacks is null."""
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("value"), F.col("s_name").alias("note"))
    return union_frames({"orders": a, "suppliers": b}).select("chunk_id", "id", "value", "note")


@query(f"""WITH v AS (SELECT source, {_ROWS_HASH} AS v FROM documents GROUP BY source),
known AS (SELECT v FROM v WHERE source < 'src2') SELECT source FROM v WHERE v NOT IN (SELECT v FROM known)""")
def new_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose content no registered model was trained on."""
    versions = table(spark, sf_dir, "documents").groupBy("source").agg(rows_hash(F.col("text")).alias("data_version"))
    registry = versions.filter("source < 'src2'").select(F.create_map(F.lit("data"), F.col("data_version")).alias("versions"))
    return unseen(versions, registry).select("source")


# ---- whole flows ----


_CHAINS = ["C", "CC", "CCC", "CCO", "CCN", "CCCC", "CC(=O)O", "c1ccccc1", "CCF", "CC#N"]


def flow_files(spark: SparkSession, sf_dir: str, path: str) -> dict:
    """Chunks, a golden set and a batch of structures by nation, and the configuration of a lifecycle over them."""
    keys = [r.n_nationkey for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]  # a table of 25 rows

    def put(name: str, header: str, line) -> None:
        storage_of(path).write(join(path, name), "\n".join([header, *(line(k, _CHAINS[k % len(_CHAINS)]) for k in keys), ""]).encode())

    for n in range(2):
        put(f"chunks/chunk_{n}.csv", "mol_id,smiles,mu", lambda k, s, n=n: f"m{n}{k},{s},{len(s) * 0.5 + (k + n) % 3 * 0.01}")
    put("golden.csv", "mol_id,smiles,mu", lambda k, s: f"g{k},{s},{len(s) * 0.5}")
    put("batch.csv", "candidate_id,smiles", lambda k, s: f"c{k},{s}")
    return {
        "source": {"kind": "csv_chunks", "path": join(path, "chunks")},
        "validation": {"checks": {"schema": {"required_columns": ["smiles", "mu"]}, "min_rows": 5, "parseable_smiles": {"min_fraction": 0.5}}},
        "featurizer": {"kind": "structure_descriptors", "params": {"morgan_bits": 64, "morgan_radius": 1}},
        "model": {"estimator": "RandomForestRegressor", "params": {"n_estimators": 5, "max_depth": 6}},
        "evaluation": {"targets": ["mu"], "sets": {"golden": {"path": join(path, "golden.csv")}, "rolling": {"n": 2, "holdout_fraction": 0.2}}},
        "gate": {"n_resamples": 100},
        "registry": {"root": join(path, "registry")},
    }


@query("""SELECT u.* FROM (SELECT count(*) AS n FROM nation) c, LATERAL (VALUES (1, 'lifecycle', 'promoted', 0), (2, 'lifecycle', 'skipped', 0), (3, 'lifecycle', 'data_rejected', 0), (4, 'triage', 'completed', least(4, c.n))) u(step, flow, status, n_shortlisted)""")
def lifecycle_and_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model trained and promoted, the same content again, a chunk that fails its checks, and a batch shortlisted by the model."""
    path = folder(spark, "flow")
    cfg = flow_files(spark, sf_dir, path)
    chunks = source_from_config(spark, cfg["source"]).chunks()
    runs = [run_lifecycle(spark, cfg, chunks[0], join(path, "runs")), run_lifecycle(spark, cfg, chunks[0], join(path, "runs"))]
    strict = {**cfg, "validation": {"checks": {"min_rows": 10**6}}}
    runs.append(run_lifecycle(spark, strict, chunks[1], join(path, "runs")))
    triage = {
        "source": {"kind": "csv_batch", "path": join(path, "batch.csv")},
        "validation": {"checks": {"schema": {"required_columns": ["candidate_id", "smiles"]}}},
        "registry": {"root": join(path, "registry")},
        "gate": [{"kind": "property_threshold", "target": "mu", "minimum": -100.0}, {"kind": "top_k", "target": "mu", "k": 4}],
    }
    shortlisted = run_triage(spark, triage, runs_root=join(path, "runs"))
    rows = [(k, "lifecycle", r.status, 0) for k, r in enumerate(runs, 1)] + [(4, "triage", shortlisted.status, shortlisted.n_shortlisted)]
    return spark.createDataFrame(rows, "step int, flow string, status string, n_shortlisted long")


@query("""SELECT u.line, u.text FROM (SELECT count(*) AS n FROM orders) o, (SELECT count(*) AS n FROM documents) d, LATERAL (VALUES
(0, '# Tables'), (1, ''), (2, '| finding | value |'), (3, '|---|---|'), (4, '| n_rows | ' || o.n || ' |'), (5, '| by_table: documents | ' || d.n || ' |'), (6, '| by_table: orders | ' || o.n || ' |')) u(line, text)""")
def text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings as a table for people, read back line by line."""
    n = {t: table(spark, sf_dir, t).count() for t in ("documents", "orders")}
    path = write_profile({"n_rows": n["orders"], "by_table": n}, join(folder(spark, "profile"), "profile.md"), "Tables")
    return spark.createDataFrame([*enumerate(read_bytes(path).decode().splitlines())], "line int, text string")


@dataclass
class ShareOf(Gate):
    """A check from outside the library: rows of one value, of which there must be a share."""

    column: str
    value: str
    least: float
    name: str = "share"

    def mask(self, ctx):
        return F.col(self.column) == self.value

    def aggregates(self, ctx, mask):
        return {"share": F.avg(F.col(mask).cast("int"))}

    def decide(self, ctx, numbers):
        return numbers["share"] >= self.least, f"a share of {numbers['share']:.3f}", {"share": numbers["share"]}


@query("""WITH k AS (SELECT o_orderkey AS row_id, o_orderstatus = 'F' AS kept FROM orders), v AS (SELECT avg(kept::INT) AS x FROM k)
SELECT row_id, kept, round(x, 6) AS share, x >= 0.3 AS verdict FROM k, v""")
def own_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own check beside the library's."""
    frame = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus")
    found = CompositeGate([ShareOf("o_orderstatus", "F", 0.3)]).evaluate(GateContext(frame=frame))
    share = round(found.results[0].evidence["share"], 6)
    return found.frame.select("row_id", F.col(found.masks[0][1]).alias("kept"), F.lit(share).alias("share"), F.lit(found.verdict).alias("verdict"))


@query("""SELECT 'nations' AS chunk_id, n_nationkey AS id FROM nation UNION ALL SELECT 'regions', r_regionkey FROM region""")
def own_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own source of chunks."""

    class Tables:
        kind = "tables"

        def chunks(self) -> list[Chunk]:
            a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
            b = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"))
            return [Chunk("nations", "", "v1", a), Chunk("regions", "", "v2", b)]

    return union_frames({c.chunk_id: c.frame for c in Tables().chunks()}).select("chunk_id", "id")
