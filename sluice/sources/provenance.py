"""Raw files: the header is checked before anything is kept, and where the bytes came from is written down."""

from __future__ import annotations

import csv
import io
import tarfile
from collections.abc import Callable, Sequence
from pathlib import Path
from typing import Any

from ..functions.identity import content_hash, utc_now
from .manifest import write_json
from .storage import stem_of, storage_of


def member_of(payload: bytes, suffix: str = ".csv") -> bytes:
    """The payload, or the only member with the suffix if it is a tar.gz archive."""
    if payload[:2] != b"\x1f\x8b":
        return payload
    with tarfile.open(fileobj=io.BytesIO(payload), mode="r:gz") as archive:
        names = [m for m in archive.getmembers() if m.isfile() and m.name.endswith(suffix)]
        if len(names) != 1:
            raise ValueError(f"the archive has {len(names)} files ending in {suffix}")
        return archive.extractfile(names[0]).read()


def keep_raw(sources: Sequence[tuple[str, Callable[[], bytes]]], path: str | Path, required: Sequence[str]) -> dict[str, Any]:
    """Stores the first source that can be read and has the required columns; returns its provenance record.

    ``sources`` are (name, reader) in order of preference. A source that raises is passed over; one with a
    wrong header is an error, and nothing is written then.
    """
    errors = []
    for name, read in sources:
        try:
            payload = member_of(read())
        except (OSError, ValueError, tarfile.TarError) as e:
            errors.append(f"{name}: {e}")
            continue
        lines = payload.decode().splitlines()
        header = next(csv.reader(lines[:1]), [])
        if missing := [c for c in required if c not in header]:
            raise ValueError(f"{name} lacks the columns {missing}")
        storage_of(path).write(path, payload)
        record = {"source": name, "bytes": len(payload), "rows": len(lines) - 1, "header": ",".join(header), "sha256": content_hash(path), "stored_at": utc_now()}
        folder, _, _ = str(path).rpartition("/")
        write_json(f"{folder}/{stem_of(path)}.source.json" if folder else f"{stem_of(path)}.source.json", record)
        return record
    raise OSError("no source could be read: " + "; ".join(errors))


def write_profile(found: dict[str, Any], path: str | Path, title: str = "Profile") -> str:
    """Findings as a Markdown table; nested results become rows of their own."""
    lines = [f"# {title}", "", "| finding | value |", "|---|---|"]
    for k, v in found.items():
        for name, value in ((f"{k}: {x}", y) for x, y in v.items()) if isinstance(v, dict) else ((k, v),):
            lines.append(f"| {name} | {value:.4g} |" if isinstance(value, float) else f"| {name} | {value} |")
    storage_of(path).write(path, ("\n".join(lines) + "\n").encode())
    return str(path)
