import csv
import json
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice import run_queries
from sluice.operators.modelling import Featurizer, MeanBaseline, Trainer, featurizer_from_config, load_bound, load_stage, save_artifacts, trainer_from_config
from sluice.plans.cli import main
from sluice.plans.lifecycle import Earlier, assemble, open_attempt, run_lifecycle, screen, write_report
from sluice.plans.triage import run_triage
from sluice.sources import chunks as chunk_files
from sluice.sources.chunks import CsvBatchSource, CsvChunkSource, load_chunks, prepare_dataset, read_csv, source_from_config, with_row_ids, write_csv
from sluice.sources.registry import ModelRegistry
from sluice.streaming.arrival import ArrivalPoller, backfill, new_contents, stream_arrivals, windowed_statistics

STRUCTURES = ["C", "CC", "CCC", "CCO", "CCN", "CCCC", "C1CC1", "CC(=O)O", "c1ccccc1", "CCF", "CC#N", "C=C", "CCCO", "OCCO", "C1CCCC1", "CC(C)C", "NCCO", "CCCN", "COC", "CNC", "C=O", "CC=O", "CCCCC", "c1ccncc1"]


def write(path, n, seed, noise=0.05, header=("mol_id", "smiles", "mu", "gap")):
    rng = np.random.default_rng(seed)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for i in range(n):
            s = STRUCTURES[i % len(STRUCTURES)]
            w.writerow([f"m{seed}_{i}", s, round(len(s) * 0.5 + rng.normal() * noise, 4), round(0.4 - len(s) * 0.01 + rng.normal() * noise * 0.01, 5)][: len(header)])


@pytest.fixture
def space(tmp_path):
    (tmp_path / "chunks").mkdir()
    for k in range(2):
        write(tmp_path / "chunks" / f"chunk_{k:02d}.csv", 60, k)
    write(tmp_path / "golden.csv", 40, 99)
    write(tmp_path / "batch.csv", 30, 7, header=("candidate_id", "smiles"))
    cfg = {
        "source": {"kind": "csv_chunks", "path": str(tmp_path / "chunks"), "glob": "chunk_*.csv"},
        "validation": {"on_failure": "quarantine", "checks": {"schema": {"required_columns": ["smiles", "mu", "gap"]}, "min_rows": 5, "parseable_smiles": {"min_fraction": 0.5}, "target_nan": {"max_fraction": 0.5}}},
        "featurizer": {"kind": "structure_descriptors", "params": {"morgan_bits": 64, "morgan_radius": 1}},
        "model": {"estimator": "RandomForestRegressor", "params": {"n_estimators": 5, "max_depth": 6}},
        "evaluation": {"targets": ["mu", "gap"], "sets": {"golden": {"path": str(tmp_path / "golden.csv")}, "rolling": {"n": 2, "holdout_fraction": 0.2}}, "slices": {"heavy_atoms": {"column": "n_heavy_atoms", "bins": [0, 4, 99]}, "fluor": {"column": "has_F"}}},
        "gate": {"n_resamples": 100},
        "registry": {"root": str(tmp_path / "registry")},
    }
    return tmp_path, cfg


def test_lifecycle_then_triage(spark, space):
    tmp, cfg = space
    chunks = source_from_config(spark, cfg["source"]).chunks()
    first = run_lifecycle(spark, cfg, chunks[0], tmp / "runs")
    assert first.status == "promoted" and set(first.metrics) == {"golden", "rolling"}
    assert "heavy_atoms[0-4)" in first.metrics["golden"]["slices"] and "fluor=true" not in first.metrics["golden"]["slices"]
    assert json.loads(Path(first.manifest_path).read_text())["status"] == "promoted"
    assert Path(write_report(first, tmp / "report.txt")).read_text().startswith(f"run: {first.run_id}\nstatus: promoted")

    again = run_lifecycle(spark, cfg, chunks[0], tmp / "runs")
    assert again.status == "skipped" and again.model_version == first.model_version

    second = run_lifecycle(spark, cfg, None, tmp / "runs")
    registry = ModelRegistry(tmp / "registry")
    assert second.status in ("promoted", "rejected") and len(registry.records()) == 2
    assert "golden_incumbent" in second.metrics and len(second.decision.results) == 14

    triage = {
        "source": {"kind": "csv_batch", "path": str(tmp / "batch.csv")},
        "validation": {"checks": {"schema": {"required_columns": ["candidate_id", "smiles"]}, "parseable_smiles": {"min_fraction": 0.0}, "duplicates": {"max_fraction": 1.0}}},
        "registry": {"root": str(tmp / "registry")},
        "featurizer": {"kind": "from_promoted_model"},
        "gate": [{"kind": "property_threshold", "target": "mu", "minimum": 1.0}, {"kind": "uncertainty", "target": "mu", "max_uncertainty": 5.0}, {"kind": "top_k", "target": "gap", "k": 8, "largest": False}],
        "output": {k: str(tmp / "out" / "{run_id}" / f) for k, f in (("shortlist", "s.csv"), ("rejected", "r.csv"), ("manifest", "m.json"))},
    }
    out = run_triage(spark, triage, runs_root=tmp / "runs")
    shortlist, rejected = (list(csv.DictReader(open(p))) for p in (out.shortlist_path, out.shortlist_path.replace("s.csv", "r.csv")))
    assert out.status == "completed" and out.n_candidates == len(STRUCTURES) == len(shortlist) + len(rejected) and len(shortlist) == out.n_shortlisted
    ranks = [int(r["rank"]) for r in shortlist]
    assert ranks == sorted(ranks) and all(r["dropped_by"] for r in rejected) and "pred_mu" in shortlist[0] and "unc_gap" in shortlist[0]
    assert {int(r["rank"]) for r in shortlist + rejected} == set(range(len(STRUCTURES)))
    with pytest.raises(ValueError):
        run_triage(spark, triage | {"featurizer": {"kind": "structure_descriptors"}}, runs_root=tmp / "runs")
    nothing = run_triage(spark, triage | {"validation": {"checks": {"min_rows": 1000}}}, runs_root=tmp / "runs")
    assert nothing.status == "failed" and Path(nothing.manifest_path).exists()


def test_bad_chunks_are_not_registered(spark, space):
    tmp, cfg = space
    cfg["validation"]["checks"]["min_rows"] = 1000
    out = run_lifecycle(spark, cfg, None, tmp / "runs")
    assert out.status == "data_rejected" and not ModelRegistry(tmp / "registry").records()
    assert len(list(csv.DictReader(open(Path(out.manifest_path).parent / "quarantined.csv")))) == 60


def test_held_back_promotion(spark, space):
    tmp, cfg = space
    cfg["registry"]["auto_promote"] = False
    out = run_lifecycle(spark, cfg, None, tmp / "runs")
    assert out.status == "staged" and ModelRegistry(tmp / "registry").production() is None
    assert load_stage(ModelRegistry(tmp / "registry"), "staging").version == out.model_version
    with pytest.raises(LookupError):
        load_stage(ModelRegistry(tmp / "registry"))


def test_featurizer_versions_and_binding(spark, space):
    tmp, _ = space
    df = read_csv(spark, tmp / "golden.csv")
    f = featurizer_from_config({"kind": "rdkit_descriptors", "params": {"morgan_bits": 64}})
    assert f.version.endswith("/unfitted") and not f.fitted
    with pytest.raises(RuntimeError):
        f.transform(df)
    f.fit(df)
    g = Featurizer(bits=64).fit(df.repartition(3))
    assert f.version == g.version != Featurizer(bits=32).fit(df).version and f.version != Featurizer(bits=64).fit(df.limit(10)).version
    assert f.transform(df).first()["_features"].size == f.n_features == 12 + len(f.state.active_bits)
    model = Trainer(params={"n_estimators": 4}).fit(f.transform(df), ["mu"], f.version)
    bound = load_bound(save_artifacts(tmp / "a", model, f))
    assert bound.featurizer.version == f.version
    got = bound.score(df).orderBy("row_id").collect()
    direct = {r.row_id: r.pred_mu for r in model.predict(f.transform(df)).collect()}
    assert all(r.pred_mu == pytest.approx(direct[r.row_id]) and r.unc_mu >= 0 for r in got) and len({round(r.unc_mu, 9) for r in got}) > 1
    Featurizer(bits=32).fit(df).save(tmp / "a" / "featurizer.json")
    with pytest.raises(ValueError):
        load_bound(tmp / "a")
    for bad in ({"kind": "from_promoted_model"}, {"kind": "magic"}):
        with pytest.raises(ValueError):
            featurizer_from_config(bad)
    for bad in ({"backend": "magic"}, {"estimator": "magic"}):
        with pytest.raises(ValueError):
            trainer_from_config(bad)
    boosted = Trainer("GBTRegressor", {"max_iter": 2}).fit(f.transform(df), ["mu"], f.version)
    assert {r.unc_mu for r in boosted.predict(f.transform(df), True).collect()} == {0.0}
    with pytest.raises(KeyError):
        Trainer().fit(f.transform(df), ["nowhere"])
    base = MeanBaseline(["mu"]).fit(df)
    assert base.predict(df, True).first().pred_mu == pytest.approx(base.means["mu"]) and base.stds["mu"] > 0


def test_a_backfill_reads_each_chunk_once(spark, monkeypatch):
    read, plain = [], chunk_files.read_csv
    monkeypatch.setattr(chunk_files, "read_csv", lambda session, path, *more: read.append(Path(path).stem) or plain(session, path, *more))
    rows = run_queries.backfilled_models(spark, "/root/testdata/sf0.001").collect()
    assert sorted(read) == ["chunk_0", "chunk_1", "chunk_2"]
    assert [r.status for r in rows] == ["promoted", "promoted", "rejected", *["skipped"] * 3]
    first, second = [r.trained_on for r in rows[:3]], [r.trained_on for r in rows[3:]]
    assert first == second and first[0] < first[1] < first[2]


def test_rows_of_earlier_runs_are_those_that_a_run_of_its_own_makes(spark, space):
    tmp, cfg = space
    write(tmp / "chunks" / "chunk_01.csv", 50, 5, header=("mol_id", "smiles", "mu"))  # a column fewer

    def assembled(k, folder, earlier=None):
        a = open_attempt(spark, cfg, source_from_config(spark, cfg["source"]).chunks()[k], tmp / folder, earlier)
        if ended := screen(a):
            return ended.status
        assemble(a)
        return sorted(a.rows.select("chunk_id", "row_id", "mol_id", "smiles", "mu", "gap", "held").collect(), key=lambda r: r[:2]), Path(a.folder)

    shared = Earlier(source_from_config(spark, cfg["source"]))
    one, place = assembled(0, "a", shared)
    cfg["validation"]["checks"]["schema"]["required_columns"] = ["smiles", "mu"]  # asked for something else: chunk 0 is looked at again
    write(tmp / "chunks" / "chunk_02.csv", 40, 6)
    two, _ = assembled(1, "a", shared)
    three, last = assembled(2, "a", shared)
    assert {r.chunk_id for r in spark.read.parquet(str(last / "rows")).collect()} == {"chunk_02"}
    assert one == assembled(0, "b")[0] and two == assembled(1, "b")[0] and three == assembled(2, "b")[0] and len(three) == 150
    write(tmp / "chunks" / "chunk_00.csv", 30, 8)  # edited in place
    shutil.rmtree(last)  # a run whose rows are gone
    again, _ = assembled(2, "a", shared)
    assert again == assembled(2, "b")[0] and len(again) == 120


def test_named_columns_are_fitted_in_one_job(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 4), (None, 6), (nan, None), (3.0, 8)], "a double, b int")
    f = Featurizer("columns", columns=("a", "b")).fit(df)
    assert (f.state.mean, f.state.std, f.state.n_train_rows) == ((2.0, 6.0), (1.0, pytest.approx(1.63299316186)), 4)
    array = Featurizer("columns", columns=("x",), state=f.state)
    of = lambda g, rows: [list(r[0]) for r in g.transform(rows).select("_features").collect()]
    assert of(f, df) == of(array, df.select(F.array(F.col("a"), F.col("b").cast("double")).alias("x")))


def test_sources(spark, space):
    tmp, cfg = space
    assert [c.chunk_id for c in CsvChunkSource(spark, tmp / "chunks").chunks()] == ["chunk_00", "chunk_01"]
    assert load_chunks(spark, tmp / "chunks").groupBy("chunk_id").count().count() == 2
    for bad in (CsvChunkSource(spark, tmp / "none"), CsvBatchSource(spark, tmp / "none.csv")):
        with pytest.raises(FileNotFoundError):
            bad.chunks()
    with pytest.raises(ValueError):
        source_from_config(spark, {"kind": "magic"})
    (tmp / "na.csv").write_text("smiles,mu\nNA,1\n,NaN\nnan,NA\nC,\nCC,2\n")
    rows = read_csv(spark, tmp / "na.csv").orderBy("row_id").collect()
    assert [r.smiles for r in rows] == [None, None, None, "C", "CC"] and [r.row_id for r in rows] == list(range(5))
    assert rows[0].mu == 1.0 and rows[3].mu is None and (rows[1].mu is None or np.isnan(rows[1].mu))
    ids = with_row_ids(spark.range(0, 1000, 1, 7)).collect()
    assert all(r.id == r.row_id for r in ids)


def test_prepared_dataset(spark, tmp_path):
    from sluice.operators.sampling import split_into_chunks

    raw = spark.createDataFrame([(i, 1 + i % 5, float(i), "C") for i in range(120)], "row_id long, size int, mu double, smiles string")
    prepare_dataset(split_into_chunks(raw, "size", 60, 3), tmp_path, ["mu"], 5)
    batch = list(csv.DictReader(open(tmp_path / "candidates.csv")))
    assert [r["candidate_id"] for r in batch] == [f"cand-{i:04d}" for i in range(5)] and "mu" not in batch[0]
    assert spark.read.parquet(str(tmp_path / "chunks")).count() + len(list(csv.DictReader(open(tmp_path / "golden.csv")))) == 60


def test_arrival(spark, space):
    tmp, cfg = space
    source, registry = CsvChunkSource(spark, tmp / "chunks"), ModelRegistry(tmp / "registry")
    poller = ArrivalPoller(source, registry, debounce=5)
    now = (tmp / "chunks" / "chunk_00.csv").stat().st_mtime
    assert poller.due(now + 1) == []
    assert [Path(p).stem for p in poller.due(now + 60)] == ["chunk_00", "chunk_01"] and poller.due(now + 61) == []
    shutil.copy(tmp / "chunks" / "chunk_00.csv", tmp / "chunks" / "chunk_02.csv")  # the same data under a new name
    write(tmp / "chunks" / "chunk_01.csv", 50, 5)  # edited in place
    assert [Path(p).stem for p in poller.due(now + 1e6)] == ["chunk_01"]
    assert backfill(source, lambda c: c.chunk_id) == ["chunk_00", "chunk_01", "chunk_02"]
    assert list(ArrivalPoller(source, registry, 0).watch(lambda c: c.chunk_id, rounds=1)) == ["chunk_00", "chunk_01"]
    tried = []

    def fails_once(c):
        tried.append(c.chunk_id)
        if len(tried) == 1:
            raise RuntimeError("lost")
        return c.chunk_id

    assert list(ArrivalPoller(source, registry, 0).watch(fails_once, rounds=2, interval=0)) == ["chunk_01", "chunk_00"] and tried == ["chunk_00", "chunk_01", "chunk_00"]
    registry.register("m", {"data": source.chunks()[0].data_version}, {}, {})
    left = new_contents(spark, str(tmp / "chunks"), "chunk_*.csv", registry.as_frame(spark)).collect()
    assert [Path(r.path).stem for r in left] == ["chunk_01"]
    seen = []
    stream_arrivals(spark, str(tmp / "chunks"), "chunk_*.csv", str(tmp / "ck"), lambda p, v: seen.append((Path(p).stem, v))).awaitTermination(120)
    assert sorted(s for s, _ in seen) == ["chunk_00", "chunk_01", "chunk_02"] and len({v for _, v in seen}) == 2


def test_sinks_fail_rather_than_lose_rows(spark, tmp_path, monkeypatch):
    from sluice.sources import storage

    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert Path(write_csv(df, tmp_path / "x.csv", ["k"])).read_text() == "k,v\n1,a\n2,b\n" and not list(tmp_path.glob("*.parts"))
    assert Path(write_csv(df.limit(0), tmp_path / "y.csv")).read_text() == "k,v\n"
    monkeypatch.setattr(storage.LocalStorage, "is_folder", lambda self, p: False)  # as if executors wrote to their own disks
    with pytest.raises(OSError):
        write_csv(df, tmp_path / "z.csv")
    assert not (tmp_path / "z.csv").exists()


def test_windowed_statistics(spark):
    events = spark.createDataFrame([(f"2024-01-01 00:0{i}:00", float(i)) for i in range(6)], "ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    got = windowed_statistics(events, "ts", "value", "3 minutes").orderBy("start").collect()
    assert [(r.n, r["mean"]) for r in got] == [(3, 1.0), (3, 4.0)]


def test_command_line(tmp_path, capsys):
    reg = ModelRegistry(tmp_path)
    reg.register("a", {"data": "d"}, {}, {})
    assert main(["registry", "list", "--root", str(tmp_path)]) == 0 and "a\tstaging" in capsys.readouterr().out
    assert main(["registry", "show", "a", "--root", str(tmp_path)]) == 0
    assert main(["registry", "show", "zz", "--root", str(tmp_path)]) == 2 and main(["registry", "rollback", "--root", str(tmp_path)]) == 2


def test_lines_of_files_that_several_tasks_read(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = run_queries.triage_files(spark, "/root/testdata/sf0.01").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for file, n in (("best.csv", 200), ("rest.csv", 800), ("quarantined.csv", 500)):
        own = sorted((r for r in rows if r.file == file), key=lambda r: r.line)
        assert [r.line for r in own] == list(range(n)), file
        assert own == sorted(own, key=lambda r: r.candidate_id if r.rank is None else r.rank)
