from pathlib import Path
import io
import json
import tarfile

import pytest

from sluice.sources.provenance import keep_raw, write_profile


def broken():
    raise OSError("unreachable")


def archive(text):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        info = tarfile.TarInfo("data/raw.csv")
        info.size = len(text)
        t.addfile(info, io.BytesIO(text))
    return out.getvalue()


def test_the_first_readable_source_is_kept(tmp_path):
    record = keep_raw([("first", broken), ("mirror", lambda: archive(b"id,smiles\n1,C\n2,CC\n"))], tmp_path / "raw.csv", ["smiles"])
    assert record["source"] == "mirror" and record["rows"] == 2 and (tmp_path / "raw.csv").read_text().startswith("id,smiles")
    assert json.loads((tmp_path / "raw.source.json").read_text())["sha256"] == record["sha256"]


def test_nothing_is_written_for_a_wrong_header(tmp_path):
    with pytest.raises(ValueError):
        keep_raw([("a", lambda: b"id\n1\n")], tmp_path / "raw.csv", ["smiles"])
    with pytest.raises(OSError):
        keep_raw([("a", broken)], tmp_path / "raw.csv", ["smiles"])
    assert not (tmp_path / "raw.csv").exists()


def test_profile(tmp_path):
    text = Path(write_profile({"n_rows": 3, "r2": {"mu": 0.123456}, "none": None}, tmp_path / "p.md")).read_text()
    assert "| r2: mu | 0.1235 |" in text and "| n_rows | 3 |" in text
