"""What a run read, decided and wrote."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..functions.identity import utc_now
from ..operators.decisions import Versions
from .storage import storage_of


def write_json(path: str | Path, payload: Any) -> str:
    """Written as a whole or not at all, on any file system."""
    storage_of(path).write(path, json.dumps(payload, indent=2, sort_keys=True, default=str).encode())
    return str(path)


@dataclass
class RunManifest:
    run_id: str
    pipeline: str
    started_at: str
    versions: Versions
    inputs: dict[str, Any] = field(default_factory=dict)
    outputs: dict[str, Any] = field(default_factory=dict)
    gate_decision: dict[str, Any] = field(default_factory=dict)
    status: str = "running"
    finished_at: str | None = None
    events: list[dict[str, Any]] = field(default_factory=list)

    @classmethod
    def start(cls, run_id: str, pipeline: str, versions: Versions, **inputs: Any) -> RunManifest:
        return cls(run_id, pipeline, utc_now(), versions, inputs)

    def event(self, kind: str, **payload: Any) -> None:
        self.events.append({"kind": kind, "at": utc_now(), **payload})

    def finish(self, status: str, **outputs: Any) -> RunManifest:
        self.status, self.finished_at = status, utc_now()
        self.outputs |= outputs
        return self

    def as_dict(self) -> dict[str, Any]:
        return {**self.__dict__, "versions": self.versions.as_dict()}

    def write(self, path: str | Path) -> str:
        return write_json(path, self.as_dict())
