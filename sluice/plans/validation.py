"""Validation of one frame under a policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..operators.decisions import GateDecision
from ..operators.gates import GateContext, validation_gate

POLICIES = ("reject_chunk", "quarantine", "warn")


@dataclass
class ValidationOutcome:
    """Accepted and quarantined rows, and what was decided. Quarantined rows say which check dropped them."""

    decision: GateDecision
    accepted: DataFrame
    quarantined: DataFrame
    status: str
    n_accepted: int
    n_quarantined: int

    @property
    def usable(self) -> bool:
        return self.status != "rejected"

    def as_dict(self) -> dict[str, Any]:
        return {"status": self.status, "n_accepted": self.n_accepted, "n_quarantined": self.n_quarantined, "decision": self.decision.as_dict()}


def apply_policy(frame: DataFrame, decision: GateDecision, on_failure: str = "quarantine") -> ValidationOutcome:
    """``warn`` accepts all rows; ``quarantine`` drops masked rows; ``reject_chunk`` drops all rows for any failure.

    A blocking failure without a mask, such as a missing column, rejects all rows unless the policy is to warn.
    """
    if on_failure not in POLICIES:
        raise ValueError(f"unknown policy {on_failure!r}; known: {', '.join(POLICIES)}")
    n, kept = decision.n_rows or 0, decision.n_selected or 0
    if on_failure == "warn":
        return ValidationOutcome(decision, frame, frame.limit(0), "accepted", n, 0)
    structural = any(r.mask is None for r in decision.failed)
    if structural or (on_failure == "reject_chunk" and (decision.failed or kept < n)):
        return ValidationOutcome(decision, frame.limit(0), frame, "rejected", 0, n)
    columns = frame.columns
    accepted = decision.rows().select(*columns)
    dropped = decision.frame.withColumn("dropped_by", decision.dropped_by()).filter(~decision.selected()).select(*columns, "dropped_by") if decision.masks else frame.limit(0).withColumn("dropped_by", F.lit(""))
    return ValidationOutcome(decision, accepted, dropped, "accepted_with_quarantine" if kept < n else "accepted", kept, n - kept)


def validate(frame: DataFrame, cfg: Mapping[str, Any], targets: Sequence[str] = (), row_id: str = "row_id") -> ValidationOutcome:
    decision = validation_gate(cfg, targets).evaluate(GateContext(frame=frame, row_id=row_id))
    return apply_policy(frame, decision, cfg.get("on_failure", "quarantine"))
