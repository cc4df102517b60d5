"""Content, configuration and code identities, and seeded orders that any SQL engine can repeat."""

from __future__ import annotations

import hashlib
import json
import subprocess
from datetime import datetime, timezone
from pathlib import Path
from typing import Any
from uuid import uuid4

from pyspark.sql import Column, functions as F


def content_hash(path: str | Path) -> str:
    """``sha256:`` and 16 hex digits of a file's bytes; the name plays no part."""
    from ..sources.storage import sha256_of

    return f"sha256:{sha256_of(path)[:16]}"


def content_hash_column(content: Column) -> Column:
    """The same for the bytes of Spark's binaryFile source."""
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(content, 256), 1, 16))


def canonical_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)


def short_hash(value: Any, digits: int = 16) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()[:digits]


def config_hash(config: dict[str, Any]) -> str:
    return f"sha256:{short_hash(config)}"


def code_version() -> str:
    """The commit this code is at, or ``unknown`` outside a repository."""
    try:
        said = subprocess.run(["git", "rev-parse", "--short", "HEAD"], cwd=Path(__file__).parent, capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.SubprocessError):
        return "unknown"
    return said.stdout.strip() if said.returncode == 0 and said.stdout.strip() else "unknown"


def utc_now() -> str:
    return datetime.now(timezone.utc).replace(microsecond=0).isoformat()


def new_run_id(prefix: str) -> str:
    return f"{prefix}-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid4().hex[:6]}"


def seeded(seed: str, row_id: Column | str) -> Column:
    """A hash of seed and row id; ordering by it gives the same sample on any engine."""
    row = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.sha2(F.concat(F.lit(f"{seed}#"), row.cast("string")), 256)


def rows_hash(content: Column) -> Column:
    """An aggregate: a hash of a group's rows whatever their order, combined before any shuffle.

    Each row's SHA-256 gives two numbers of 48 bits; the identity is a hash of their sums and the count.
    """
    digest = F.sha2(content.cast("binary"), 256)
    part = lambda k: F.coalesce(F.sum(F.conv(F.substring(digest, k, 12), 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("string")
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(F.concat_ws("#", F.count("*").cast("string"), part(1), part(13)).cast("binary"), 256), 1, 16))
