import json
import multiprocessing as mp
import threading
import time
from pathlib import Path

import pytest

from sluice.functions.identity import canonical_json, config_hash, content_hash
from sluice.operators.decisions import Versions
from sluice.sources.manifest import RunManifest
from sluice.sources import registry as module
from sluice.sources.registry import ModelRecord, ModelRegistry
from sluice.sources.storage import HadoopStorage, LocalStorage


def add(reg, v, stage="staging", data="d", **more):
    return reg.register(v, {"data": data, "featurizer": "f"}, {}, {}, stage, **more)


def test_stages_and_rollback(tmp_path):
    reg = ModelRegistry(tmp_path)
    for v in ("a", "b", "c"):
        add(reg, v, data=f"d{v}")
        reg.promote(v)
    assert reg.production().version == "c" and [r.stage for r in reg.records()] == ["archived", "archived", "production"]
    assert reg.rollback().version == "b" and reg.rollback().version == "c"  # the present one is archived each time
    assert reg.find_by_data_version("da").version == "a" and reg.find_by_data_version("da", ["staging"]) is None
    add(reg, "bad", "rejected")
    with pytest.raises(ValueError):
        reg.promote("bad")
    with pytest.raises(KeyError):
        reg.promote("none")
    with pytest.raises(ValueError):
        add(reg, "a")
    with pytest.raises(ValueError):
        ModelRegistry(tmp_path / "new").rollback()
    assert add(reg, "d", promote=True).stage == "production" and reg.get("c").stage == "archived"


def test_artifacts_are_copied(tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "x.txt").write_text("1")
    reg = ModelRegistry(tmp_path / "reg")
    r = add(reg, "a", artifact_src=tmp_path / "src")
    assert (Path(reg.model_folder("a")) / "artifacts" / "x.txt").read_text() == "1" and r.artifact_dir.endswith("artifacts")
    assert json.loads((Path(reg.model_folder("a")) / "manifest.json").read_text())["version"] == "a"


def _register(root, k, barrier):
    barrier.wait()
    reg = ModelRegistry(root)
    for i in range(5):
        add(reg, f"m-{k}-{i}")


def test_concurrent_writers_lose_nothing(tmp_path):
    ctx = mp.get_context("spawn")
    barrier = ctx.Barrier(4)
    runs = [ctx.Process(target=_register, args=(str(tmp_path), k, barrier)) for k in range(4)]
    for p in runs:
        p.start()
    for p in runs:
        p.join(120)
    assert all(p.exitcode == 0 for p in runs) and len({r.version for r in ModelRegistry(tmp_path).records()}) == 20
    assert sorted(r.sequence for r in ModelRegistry(tmp_path).records()) == list(range(1, 21))


def test_state_is_a_fold_over_complete_events(tmp_path):
    reg = ModelRegistry(tmp_path)
    add(reg, "a", promote=True)
    add(reg, "b", promote=True)
    names = sorted(p.name for p in (tmp_path / "events").iterdir())
    assert names == ["00000001.json", "00000002.json"]
    (tmp_path / "events" / "00000003.json").write_text("")  # created but not written yet
    assert reg.production().version == "b" and reg.get("a").stage == "archived" and reg.state().n_events == 2
    (tmp_path / "events" / "00000003.json").unlink()
    assert reg.rollback().version == "a" and [r.sequence for r in reg.records()] == [1, 2]


@pytest.mark.parametrize("kind", ["local", "hadoop"])
@pytest.mark.parametrize("left", [b"", b'{"model": {"version": "z", "sta'], ids=["empty", "torn"])
def test_a_writer_that_died(spark, tmp_path, monkeypatch, kind, left):
    """Its file is passed over, given up after a while, and stays void even if it is completed later."""
    monkeypatch.setattr(module, "GRACE", 1.0)
    if kind == "hadoop":
        store = HadoopStorage(spark)
        monkeypatch.setattr(module, "storage_of", lambda p: store)
        monkeypatch.setattr(module, "read_bytes", lambda p: b"".join(store.blocks(p)))
        root = f"file://{tmp_path}"
    else:
        root = str(tmp_path)
    reg = ModelRegistry(root)
    add(reg, "a", promote=True)
    (tmp_path / "events" / "00000002.json").write_bytes(left)
    assert reg.production().version == "a" and [r.version for r in reg.records()] == ["a"]
    began = time.monotonic()
    add(reg, "b", promote=True)
    assert time.monotonic() - began < 30
    last = json.loads((tmp_path / "events" / "00000003.json").read_text())
    assert last["void"] == [2] and reg.production().version == "b" and reg.state().last == 3
    for crc in (tmp_path / "events").glob(".*.crc"):
        crc.unlink()
    (tmp_path / "events" / "00000002.json").write_text(json.dumps({"promote": "a"}))  # the dead come back
    assert reg.production().version == "b" and [r.stage for r in reg.records()] == ["archived", "production"]
    assert reg.rollback().version == "a" and "void" not in json.loads((tmp_path / "events" / "00000004.json").read_text())


def test_a_young_file_is_waited_for(tmp_path, monkeypatch):
    """A writer at work gets the time to end; the next one then decides on its event."""
    monkeypatch.setattr(module, "GRACE", 5.0)
    reg = ModelRegistry(tmp_path)
    add(reg, "a")
    at_work = tmp_path / "events" / "00000002.json"
    at_work.write_text("")
    event = {"model": ModelRecord("slow", "staging", "t").__dict__}
    timer = threading.Timer(0.7, lambda: at_work.write_text(json.dumps(event)))
    timer.start()
    add(reg, "b")
    timer.join()
    assert [r.version for r in reg.records()] == ["a", "slow", "b"] and reg.state().last == 3


def test_a_slow_writer_finds_out(tmp_path, monkeypatch):
    """One that was given up while it wrote decides again under another number."""
    monkeypatch.setattr(module, "GRACE", 0.4)
    reg, other, real = ModelRegistry(tmp_path), ModelRegistry(tmp_path), LocalStorage.create
    add(reg, "a")
    slow = []

    def create(self, path, data):
        if b'"slow"' in data and not slow:
            slow.append(path)
            Path(path).write_bytes(b"")
            time.sleep(0.6)
            add(other, "quick")
            Path(path).write_bytes(data)
            return True
        return real(self, path, data)

    monkeypatch.setattr(LocalStorage, "create", create)
    add(reg, "slow")
    assert slow and [r.version for r in reg.records()] == ["a", "quick", "slow"] and reg.state().last == 4


def test_moves_replace_by_one_rename(spark, tmp_path):
    store = HadoopStorage(spark)
    store.write(f"file://{tmp_path}/a", b"1")
    store.write(f"file://{tmp_path}/a", b"2")
    assert (tmp_path / "a").read_bytes() == b"2" and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["a"]


def test_a_writer_that_was_second_decides_again(tmp_path, monkeypatch):
    reg, other = ModelRegistry(tmp_path), ModelRegistry(tmp_path)
    add(reg, "a", promote=True)
    add(reg, "b", promote=True)
    real, raced = ModelRegistry.log, []

    def log(self):
        found = real(self)
        if self is reg and not raced:
            raced.append(other.rollback())
        return found

    monkeypatch.setattr(ModelRegistry, "log", log)
    assert reg.rollback().version == "b" and raced[0].version == "a" and other.state().n_events == 4


def test_registry_on_a_file_system_that_only_spark_opens(spark, tmp_path):
    store = HadoopStorage(spark)
    root = f"file://{tmp_path}/remote"  # the Hadoop client on a local disk
    assert store.create(f"{root}/x/1.json", b"{}") and not store.create(f"{root}/x/1.json", b"{}")
    store.write(f"{root}/x/2.json", b"ab\ncd")
    assert [f.name for f in store.files(f"{root}/x") if f.name.endswith("json")] == ["1.json", "2.json"] and b"".join(store.blocks(f"{root}/x/2.json")) == b"ab\ncd"
    store.copy_folder(f"{root}/x", f"{root}/y")
    store.move(f"{root}/y/2.json", f"{root}/z/3.json")
    assert store.exists(f"{root}/z/3.json") and not store.exists(f"{root}/y/2.json") and store.is_folder(f"{root}/y")
    store.remove(f"{root}/y")
    assert not store.exists(f"{root}/y")
    saved, module.storage_of = module.storage_of, lambda p: store
    try:
        module.read_bytes, bytes_before = (lambda p: b"".join(store.blocks(p))), module.read_bytes
        reg = ModelRegistry(f"{root}/registry")
        add(reg, "a", promote=True)
        add(reg, "b", artifact_src=f"{root}/x")
        assert reg.promote("b").stage == "production" and [r.stage for r in reg.records()] == ["archived", "production"] and store.exists(f"{root}/registry/models/b/artifacts/1.json")
    finally:
        module.storage_of, module.read_bytes = saved, bytes_before


def test_identities_and_manifest(tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("x\n1\n")
    b.write_text("x\n1\n")
    assert content_hash(a) == content_hash(b) and content_hash(a).startswith("sha256:") and len(content_hash(a)) == 23
    b.write_text("x\n2\n")
    assert content_hash(a) != content_hash(b)
    assert config_hash({"b": 1, "a": 2}) == config_hash({"a": 2, "b": 1}) and canonical_json({"a": [1]}) == '{"a":[1]}'
    m = RunManifest.start("r", "lifecycle", Versions(data="d"), chunk="c")
    m.event("validated", n=1)
    out = json.loads(Path(m.finish("promoted", x=1).write(tmp_path / "m" / "manifest.json")).read_text())
    assert out["status"] == "promoted" and out["events"][0]["kind"] == "validated" and out["versions"]["data"] == "d" and out["finished_at"]
