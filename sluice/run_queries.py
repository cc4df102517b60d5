"""Queries of whole runs over rows of the tables: candidates triaged into files, models that follow each other, backfilled chunks.

Structure stands back here: features are two small numbers and forests learn their cells exactly, so SQL can tell every prediction,
every rank and every score that a run decides by.
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F

from .flow_queries import folder
from .operators.modelling import Featurizer, Trainer, save_artifacts
from .plans.lifecycle import Earlier, run_lifecycle, write_report
from .plans.triage import run_triage
from .queries import query, table
from .sources.chunks import CsvChunkSource, source_from_config, with_row_ids, write_csv
from .sources.registry import ModelRegistry
from .sources.storage import join, read_bytes
from .streaming.arrival import backfill

__all__ = ["backfilled_models", "successive_models", "triage_files", "triage_report"]

COLUMNS = ["A", "B"]


def _model(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A forest of the customers' cells in production."""
    rows = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).cast("double").alias("A"), (F.col("c_custkey") % 4).cast("double").alias("B")).withColumn("mu", 10 * F.col("A") + F.col("B"))
    featurizer = Featurizer("columns", columns=tuple(COLUMNS)).fit(rows)
    model = Trainer(params={"n_estimators": 5, "max_depth": 6}).fit(featurizer.transform(rows), ["mu"], featurizer.version)
    made = save_artifacts(join(root, "made"), model, featurizer)
    ModelRegistry(join(root, "registry")).register("model-1", {"data": "d", "featurizer": featurizer.version}, {}, {}, artifact_src=made, promote=True)


def _batch(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Candidates, of which some repeat another's name."""
    rows = table(spark, sf_dir, "customer").select(
        F.format_string("c%09d", "c_custkey").alias("candidate_id"), (F.col("c_custkey") % 1000).cast("string").alias("name"), (F.col("c_nationkey") % 5).alias("A"), (F.col("c_custkey") % 4).alias("B")
    )
    return write_csv(rows, join(root, "batch.csv"), ["candidate_id"])


def _triage(root: str, batch: str) -> dict:
    return {
        "source": {"kind": "csv_batch", "path": batch},
        "validation": {"on_failure": "quarantine", "checks": {"schema": {"required_columns": ["candidate_id", *COLUMNS]}, "duplicates": {"max_fraction": 1.0, "subset": ["name"]}}},
        "registry": {"root": join(root, "registry")},
        "gate": [{"kind": "property_threshold", "target": "mu", "minimum": 12.0}, {"kind": "uncertainty", "target": "mu", "max_uncertainty": 0.5}, {"kind": "top_k", "target": "mu", "k": 200, "largest": True}],
        "output": {"shortlist": join(root, "out", "{run_id}", "best.csv"), "rejected": join(root, "out", "{run_id}", "rest.csv")},
    }


_TRIAGE = """c AS (SELECT format('c{:09d}', c_custkey) AS candidate_id, c_custkey AS k, c_custkey % 1000 AS name, 10 * (c_nationkey % 5) + c_custkey % 4 AS mu FROM customer),
d AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY k) = 1 AS kept FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY mu DESC, k) - 1 AS rank FROM d WHERE kept)"""


@query(f"""WITH {_TRIAGE}
SELECT 'best.csv' AS file, candidate_id, mu::DOUBLE AS pred, 0.0::DOUBLE AS unc, rank, NULL AS dropped_by, row_number() OVER (ORDER BY rank) - 1 AS line, 'model-1' AS model FROM r WHERE mu >= 12 AND rank < 200
UNION ALL SELECT 'rest.csv', candidate_id, mu, 0.0, rank, CASE WHEN mu < 12 THEN 'threshold[mu]' ELSE 'top_200[mu]' END, row_number() OVER (ORDER BY rank) - 1, 'model-1' FROM r WHERE mu < 12 OR rank >= 200
UNION ALL SELECT 'quarantined.csv', candidate_id, NULL, NULL, NULL, 'duplicates', row_number() OVER (ORDER BY k) - 1, NULL FROM d WHERE NOT kept""")
def triage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in one of the files of a triage run, line by line, with its scores, its rank and the check that dropped it."""
    root = folder(spark, "triage")
    _model(spark, sf_dir, root)
    result = run_triage(spark, _triage(root, _batch(spark, sf_dir, root)), runs_root=join(root, "runs"))
    places = [result.shortlist_path, result.shortlist_path.replace("best.csv", "rest.csv"), join(root, "runs", result.run_id, "quarantined.csv")]
    found = None
    for place in places:
        rows = spark.read.csv(place, header=True)
        has = lambda c, kind, rows=rows: (F.col(c) if c in rows.columns else F.lit(None)).cast(kind)
        same_run = has("run_id", "string") == result.run_id
        own = with_row_ids(rows, "line").select(
            F.lit(PurePosixPath(place).name).alias("file"), "candidate_id", F.round(has("pred_mu", "double"), 6).alias("pred"), F.round(has("unc_mu", "double"), 6).alias("unc"),
            has("rank", "long").alias("rank"), has("dropped_by", "string").alias("dropped_by"), "line", F.when(same_run, has("model_version", "string")).alias("model"),
        )
        found = own if found is None else found.unionByName(own)
    return found


@query(f"""WITH {_TRIAGE}, n AS (SELECT count(*) FILTER (kept) AS accepted FROM d), s AS (SELECT count(*) AS n FROM r WHERE mu >= 12 AND rank < 200)
SELECT u.line, u.text, n.accepted, s.n AS shortlisted FROM n, s, LATERAL (VALUES (0, 'run: triage'), (1, 'status: completed'), (2, ''), (3, 'accepted: 4 passed'), (4, 'passed  featurizer_binding'), (5, 'passed  threshold[mu]'), (6, 'passed  uncertainty[mu]'), (7, 'passed  top_200[mu]')) u(line, text)""")
def triage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text report of a triage run, without the reasons' numbers."""
    root = folder(spark, "triage")
    _model(spark, sf_dir, root)
    result = run_triage(spark, _triage(root, _batch(spark, sf_dir, root)), runs_root=join(root, "runs"))
    text = read_bytes(write_report(result, join(root, "report.txt"))).decode().replace(result.run_id, "triage")
    lines = ["  ".join(line.strip().split("  ")[:2]) for line in text.splitlines()]
    rows = [(k, line, result.n_candidates, result.n_shortlisted) for k, line in enumerate(lines)]
    return spark.createDataFrame(rows, "line int, text string, accepted long, shortlisted long")


# ---- models that follow each other ----

#: What the targets of each chunk are: first the mean of the cells of a row, then the cells themselves, then nothing.
_LESSONS = ("10 * A + 1.5", "10 * A + B", "0.0")


def _chunks(spark: SparkSession, sf_dir: str, root: str) -> dict:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).cast("double").alias("A"), (F.floor(F.col("o_orderkey") / 4) % 4).cast("double").alias("B"))
    digits = F.col("o_orderkey").cast("string")
    mol_id = F.concat(F.lit("m"), F.lpad(digits, F.greatest(F.length(digits), F.lit(12)), F.lit("0"))).alias("mol_id")  # compiled, unlike format_string
    row = lambda k, mu: orders.filter(F.col("o_orderkey") % 4 == k).select(mol_id, "A", "B", F.expr(mu).alias("mu"))
    for k, mu in enumerate(_LESSONS):
        write_csv(row(k, mu), join(root, "chunks", f"chunk_{k}.csv"), ["mol_id"])
    write_csv(row(3, "10 * A + B"), join(root, "golden.csv"), ["mol_id"])
    return {
        "source": {"kind": "csv_chunks", "path": join(root, "chunks")},
        "validation": {"checks": {"schema": {"required_columns": [*COLUMNS, "mu"]}, "min_rows": 5, "target_nan": {"max_fraction": 0.0}}},
        "featurizer": {"kind": "columns", "params": {"columns": COLUMNS}},
        "model": {"estimator": "RandomForestRegressor", "params": {"n_estimators": 1, "max_depth": 8, "bootstrap": False}},
        "evaluation": {"targets": ["mu"], "sets": {"golden": {"path": join(root, "golden.csv")}}},
        "gate": {"n_resamples": 50},
        "registry": {"root": join(root, "registry")},
    }


_SUCCESSIVE = """o AS (SELECT o_orderkey % 4 AS part, o_custkey % 5 AS A, o_orderkey // 4 % 4 AS B FROM orders),
l AS (SELECT part, A, B, CASE part WHEN 0 THEN 10 * A + 1.5 WHEN 1 THEN 10 * A + B ELSE 0 END::DOUBLE AS mu FROM o WHERE part < 3),
k AS (SELECT unnest([0, 1, 2]) AS k),
cell AS (SELECT k, A, B, avg(mu) AS pred FROM l JOIN k ON part <= k GROUP BY ALL),
g AS (SELECT A, B, 10 * A + B AS y FROM o WHERE part = 3),
e AS (SELECT k, avg(abs(pred - y)) / (SELECT stddev_pop(y) FROM g) AS score FROM g JOIN cell ON cell.A = g.A AND cell.B = g.B GROUP BY k)"""


@query(f"""WITH {_SUCCESSIVE}, s AS (SELECT e.k, e.score, (SELECT score FROM e p WHERE p.k = CASE WHEN e.k = 2 THEN 1 ELSE e.k - 1 END) AS incumbent FROM e)
SELECT 'chunk_' || k AS chunk, CASE k WHEN 0 THEN 'promoted' WHEN 1 THEN 'promoted' ELSE 'rejected' END AS status, CASE k WHEN 0 THEN 'archived' WHEN 1 THEN 'production' ELSE 'rejected' END AS stage,
round(score, 6) AS score, round(incumbent, 6) AS incumbent, CASE WHEN k = 2 THEN 'min_margin, significance, no_target_regression' ELSE '' END AS failed FROM s""")
def successive_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three chunks in turn: a model that starts, one that is better than the incumbent, and one that isn't; scores on the golden set."""
    root = folder(spark, "lifecycle")
    cfg = _chunks(spark, sf_dir, root)
    rows, registry = [], ModelRegistry(cfg["registry"]["root"])
    earlier = Earlier(source_from_config(spark, cfg["source"]))
    for chunk in earlier.source.chunks():
        result = run_lifecycle(spark, cfg, chunk, join(root, "runs"), earlier)
        before = result.metrics.get("golden_incumbent", {}).get("normalized_score")
        failed = ", ".join(r.name.removeprefix("golden:") for r in result.decision.failed)
        rows.append((chunk.chunk_id, result.status, result.model_version, round(result.metrics["golden"]["normalized_score"], 6), None if before is None else round(before, 6), failed))
    stages = {r.version: r.stage for r in registry.records()}
    out = [(c, s, stages[v], score, before, failed) for c, s, v, score, before, failed in rows]
    return spark.createDataFrame(out, "chunk string, status string, stage string, score double, incumbent double, failed string")


@query(f"""WITH {_SUCCESSIVE}, n AS (SELECT k, count(*) AS n FROM l JOIN k ON part <= k GROUP BY k)
SELECT 'chunk_' || k AS chunk, u.round, CASE WHEN u.round = 2 THEN 'skipped' WHEN k = 2 THEN 'rejected' ELSE 'promoted' END AS status, n.n AS trained_on FROM n, LATERAL (VALUES (1), (2)) u(round)""")
def backfilled_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of a folder replayed in order, twice; contents that a model was trained on are skipped the second time."""
    root = folder(spark, "backfill")
    cfg = _chunks(spark, sf_dir, root)
    source, rows = CsvChunkSource(spark, cfg["source"]["path"]), []
    earlier = Earlier(source)
    run = lambda chunk: (chunk.chunk_id, run_lifecycle(spark, cfg, chunk, join(root, "runs"), earlier))
    trained: dict[str, int] = {}
    for k in (1, 2):
        for chunk, result in backfill(source, run):
            if k == 1:
                manifest = spark.read.json(result.manifest_path, multiLine=True)
                trained[chunk] = manifest.select("inputs.n_train_rows").first()[0]
            rows.append((chunk, k, result.status, trained[chunk]))
    return spark.createDataFrame(rows, "chunk string, round int, status string, trained_on long")
