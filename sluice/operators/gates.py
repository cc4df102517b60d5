"""Checks ("gates") and the composite that evaluates them together.

A gate names its masks and aggregates as column expressions. The composite adds all masks to the frame,
computes all aggregates in one job over it, and lets every gate decide on those numbers; no gate is
skipped because another failed. A gate that raises has failed and blocks, whatever it was declared as.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.missing import above, as_key, at_least, at_most, is_missing
from .decisions import GateDecision, GateResult, Versions
from .drift import Reference, drift_statistics
from .metrics import EvalReport, normalized_score, paired_bootstrap
from .ordering import global_rank, value_keys


@dataclass
class GateContext:
    """What gates may look at: rows with a ``row_id``, or reports of models on an evaluation set."""

    frame: DataFrame | None = None
    row_id: str = "row_id"
    candidate: EvalReport | None = None
    incumbent: EvalReport | None = None
    baseline: EvalReport | None = None
    scores: Mapping[str, str] = field(default_factory=dict)  # target: column
    uncertainty: Mapping[str, str] = field(default_factory=dict)
    versions: Versions | None = None
    expected_featurizer: str | None = None
    extras: dict[str, Any] = field(default_factory=dict)


class Structural(Exception):
    """The check can't be made on this input: it fails without a mask."""


class Gate:
    """Base of all checks. Subclasses override what they need; ``decide`` is the only must."""

    name: str
    blocking: bool = True

    def mask(self, ctx: GateContext) -> Column | None:
        """The rows that pass, if the check is about rows; raise Structural where it can't be made."""
        return None

    def annotate(self, frame: DataFrame, ctx: GateContext) -> tuple[DataFrame, str | None]:
        """Adds what ``mask`` needs beyond plain expressions; returns the name of a rank column, if any."""
        return frame, None

    def aggregates(self, ctx: GateContext, mask: str | None) -> dict[str, Column]:
        return {}

    def decide(self, ctx: GateContext, numbers: Mapping[str, Any]) -> tuple[bool, str, dict[str, Any]]:
        raise NotImplementedError


def _kept(mask: str) -> Column:
    return F.coalesce(F.sum(F.col(mask).cast("long")), F.lit(0))


@dataclass
class CompositeGate:
    """Several checks as one."""

    gates: Sequence[Gate]
    name: str = "composite"

    def evaluate(self, ctx: GateContext) -> GateDecision:
        results: dict[int, GateResult] = {}
        frame, masks, ranks = ctx.frame, {}, {}
        for k, gate in enumerate(self.gates):
            if frame is None:
                continue
            try:
                annotated, rank = gate.annotate(frame, ctx)
                mask = gate.mask(ctx)
                if mask is not None:
                    annotated = annotated.withColumn(f"_mask_{k}", mask)
                    masks[k] = f"_mask_{k}"
                annotated.schema  # analysis errors belong to this gate
                frame, ranks[k] = annotated, rank
            except Exception as e:  # noqa: BLE001
                masks.pop(k, None)
                results[k] = self._failed(gate, e)
        numbers = self._numbers(ctx, frame, masks, results)
        for k, gate in enumerate(self.gates):
            if k in results:
                continue
            try:
                verdict, reason, evidence = gate.decide(ctx, numbers.get(k, {}))
                results[k] = GateResult(gate.name, bool(verdict), reason, evidence, masks.get(k), ranks.get(k), gate.blocking)
            except Exception as e:  # noqa: BLE001
                results[k] = self._failed(gate, e)
        ordered = [results[k] for k in range(len(self.gates))]
        verdict = all(r.verdict for r in ordered if r.blocking)
        total = numbers.get(-1, {})
        n_rows, n_selected = total.get("n"), None
        with_masks = [r.mask for r in ordered if r.mask]
        if with_masks:
            n_selected = total["kept"]
            verdict = verdict and n_selected > 0
        return GateDecision(verdict, ordered, frame, n_rows, n_selected if with_masks else n_rows)

    @staticmethod
    def _failed(gate: Gate, e: Exception) -> GateResult:
        if isinstance(e, Structural):
            return GateResult(gate.name, False, str(e), e.args[1] if len(e.args) > 1 else {}, blocking=gate.blocking)
        return GateResult(gate.name, False, f"{type(e).__name__}: {e}"[:500], {"error": type(e).__name__}, blocking=True)

    def _numbers(self, ctx: GateContext, frame: DataFrame | None, masks: dict[int, str], results: dict[int, GateResult]) -> dict[int, dict[str, Any]]:
        """All gates' aggregates, in one job; one by one if that job fails, so that only the guilty gate does."""
        if frame is None:
            return {}
        selected = F.lit(True)
        for m in masks.values():
            selected = selected & F.col(m)
        wanted: dict[int, dict[str, Column]] = {-1: {"n": F.count("*"), "kept": F.coalesce(F.sum(selected.cast("long")), F.lit(0))}}
        for k, gate in enumerate(self.gates):
            if k not in results:
                try:
                    wanted[k] = gate.aggregates(ctx, masks.get(k))
                except Exception as e:  # noqa: BLE001
                    results[k] = self._failed(gate, e)

        def run(parts: dict[int, dict[str, Column]]) -> dict[int, dict[str, Any]]:
            row = frame.agg(*(c.alias(f"{k}|{n}") for k, cs in parts.items() for n, c in cs.items())).first()
            return {k: {n: row[f"{k}|{n}"] for n in cs} for k, cs in parts.items()}

        try:
            return run(wanted)
        except Exception:  # noqa: BLE001
            found: dict[int, dict[str, Any]] = {}
            for k, cs in wanted.items():
                try:
                    found |= run({k: cs}) if cs else {k: {}}
                except Exception as e:  # noqa: BLE001
                    if k >= 0:
                        results[k] = self._failed(self.gates[k], e)
                        masks.pop(k, None)
            if -1 not in found:
                clean = F.lit(True)
                for m in masks.values():
                    clean = clean & F.col(m)
                found |= run({-1: {"n": F.count("*"), "kept": F.coalesce(F.sum(clean.cast("long")), F.lit(0))}})
            return found


# ---- checks of a batch ----


@dataclass
class SchemaGate(Gate):
    """All required columns are there."""

    required_columns: Sequence[str]
    name: str = "schema"

    def decide(self, ctx, numbers):
        if ctx.frame is None:
            return False, "no frame supplied", {}
        missing = [c for c in self.required_columns if c not in ctx.frame.columns]
        return not missing, f"missing columns: {missing}" if missing else "all required columns are present", {"missing": missing}


@dataclass
class MinRowsGate(Gate):
    """Enough rows."""

    min_rows: int
    name: str = "min_rows"

    def aggregates(self, ctx, mask):
        return {"n": F.count("*")}

    def decide(self, ctx, numbers):
        n = numbers["n"] if numbers else 0
        return n >= self.min_rows, f"{n} rows, at least {self.min_rows} wanted", {"n_rows": n, "minimum": self.min_rows}


@dataclass
class PredicateGate(Gate):
    """Rows satisfy a predicate; enough of them must. An empty frame has the fraction 0."""

    predicate: Callable[[DataFrame], Column]
    min_fraction: float
    columns: Sequence[str] = ()
    name: str = "predicate"

    def mask(self, ctx):
        if absent := [c for c in self.columns if c not in ctx.frame.columns]:
            raise Structural(f"missing columns: {absent}", {"missing": absent})
        return F.coalesce(self.predicate(ctx.frame).cast("boolean"), F.lit(False))

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        n, kept = numbers["n"], numbers["kept"]
        fraction = kept / n if n else 0.0
        return fraction >= self.min_fraction, f"{kept} of {n} rows pass ({fraction:.4f}, at least {self.min_fraction} wanted)", {"fraction": fraction, "n_failed": n - kept}


class ParseableSmilesGate(PredicateGate):
    """Structures can be parsed."""

    def __init__(self, min_fraction: float = 0.99, column: str = "smiles", name: str = "parseable_smiles") -> None:
        from ..functions.smiles import parses

        super().__init__(lambda df: parses(F.col(column).cast("string")), min_fraction, [column], name)

    def annotate(self, frame, ctx):
        from ..functions.smiles import spread

        return spread(frame, ctx.row_id) if set(self.columns) <= set(frame.columns) else frame, None


@dataclass
class DuplicateGate(Gate):
    """The first row of each key stays; missing keys are equal to each other."""

    max_fraction: float
    subset: Sequence[str] = ("smiles",)
    name: str = "duplicates"

    def annotate(self, frame, ctx):
        if absent := [c for c in self.subset if c not in frame.columns]:
            raise Structural(f"missing columns: {absent}", {"missing": absent})
        # A count by key rather than a ranking window: it is combined before the shuffle, so a key with a
        # third of all rows is no burden; the join back is one that adaptive execution can split.
        keys = [as_key(frame, c).alias(f"_key_{k}") for k, c in enumerate(self.subset)]
        first = frame.groupBy(*keys).agg(F.min(ctx.row_id).alias("_first"))
        same = [as_key(frame, c).eqNullSafe(first[f"_key_{k}"]) for k, c in enumerate(self.subset)]
        joined = frame.join(first, same, "left").drop(*(f"_key_{k}" for k in range(len(self.subset))))
        return joined.withColumn("_is_first", F.col(ctx.row_id) == F.col("_first")).drop("_first"), None

    def mask(self, ctx):
        return F.coalesce(F.col("_is_first"), F.lit(True))

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        n, kept = numbers["n"], numbers["kept"]
        fraction = (n - kept) / n if n else 0.0
        return fraction <= self.max_fraction, f"{n - kept} of {n} rows repeat a key ({fraction:.4f}, at most {self.max_fraction} wanted)", {"fraction": fraction, "n_duplicates": n - kept}


@dataclass
class TargetMissingGate(Gate):
    """No target is missing in a row; few rows may lack one."""

    targets: Sequence[str]
    max_fraction: float
    name: str = "target_nan"

    def mask(self, ctx):
        there = [t for t in self.targets if t in ctx.frame.columns]
        if not there:
            raise Structural("no target column is present", {"targets": list(self.targets)})
        bad = F.lit(False)
        for t in there:
            bad = bad | is_missing(ctx.frame, t)
        return ~bad

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        n, kept = numbers["n"], numbers["kept"]
        fraction = (n - kept) / n if n else 0.0
        return fraction <= self.max_fraction, f"{n - kept} of {n} rows lack a target ({fraction:.4f}, at most {self.max_fraction} wanted)", {"fraction": fraction, "n_bad": n - kept}


DRIFT_METHODS = ("ks", "psi")
DRIFT_DEFAULTS: Mapping[str, float] = {"ks": 0.25, "psi": 0.25}


@dataclass
class DriftGate(Gate):
    """How far the columns' distributions are from a frozen reference; a warning unless declared blocking."""

    reference: str
    max_statistic: float = 0.25
    columns: Sequence[str] = ()
    blocking: bool = False
    method: str = "ks"
    buckets: int = 10
    name: str = "drift"

    def __post_init__(self) -> None:
        if self.method not in DRIFT_METHODS:
            raise ValueError(f"unknown drift method {self.method!r}; known: {', '.join(DRIFT_METHODS)}")

    def decide(self, ctx, numbers):
        if ctx.frame is None:
            return False, "no frame supplied", {}
        reference = Reference.load_if_there(self.reference)
        about = {"method": self.method}
        if reference is None:
            return True, f"no reference at {self.reference} yet", about | {"evaluated": False, "reference": str(self.reference)}
        names = [c for c in (self.columns or reference.columns) if c in ctx.frame.columns and c in reference.columns]
        if not names:
            return True, "no column is in the reference", about | {"evaluated": False}
        found = drift_statistics(ctx.frame, reference, names, self.method, self.buckets)
        worst = max(names, key=lambda c: found[c] if math.isfinite(found[c]) else -1.0)
        evidence = about | {"statistics": found, "worst_column": worst, "worst": found[worst], "maximum": self.max_statistic, "evaluated": True}
        shifted = found[worst] > self.max_statistic
        return not shifted, f"{self.method.upper()} {found[worst]:.3f} on {worst}, at most {self.max_statistic:.3f} wanted", evidence


def drift_threshold(spec: Mapping[str, Any], method: str) -> float:
    """The threshold of the chosen method; one number for both methods is refused, as their scales differ."""
    if method not in DRIFT_METHODS:
        raise ValueError(f"unknown drift method {method!r}; known: {', '.join(DRIFT_METHODS)}")
    by_method = spec.get("max_statistic", DRIFT_DEFAULTS)
    if not isinstance(by_method, Mapping):
        raise ValueError(f"max_statistic must map methods to thresholds, not {by_method!r}")
    if method not in by_method:
        raise ValueError(f"max_statistic has no threshold for {method!r}, only for {sorted(by_method)}")
    return float(by_method[method])


# ---- checks of records ----


@dataclass
class PropertyThresholdGate(Gate):
    """A score lies in a window; both ends belong to it, and either may be open."""

    target: str
    minimum: float | None = None
    maximum: float | None = None
    name: str = ""

    def __post_init__(self) -> None:
        self.name = self.name or f"threshold[{self.target}]"

    def mask(self, ctx):
        if self.target not in ctx.scores:
            raise Structural(f"no scores for {self.target}")
        value, inside = F.col(ctx.scores[self.target]), F.lit(True)
        if self.minimum is not None:
            inside = inside & at_least(value, self.minimum)
        if self.maximum is not None:
            inside = inside & at_most(value, self.maximum)
        return inside

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        if not numbers:
            raise Structural("no scores supplied")
        return numbers["kept"] > 0, f"{numbers['kept']} of {numbers['n']} records in [{self.minimum}, {self.maximum}]", {"kept": numbers["kept"], "total": numbers["n"]}


@dataclass
class UncertaintyGate(Gate):
    """A score is sure enough or, inverted, so unsure that a measurement would teach something."""

    target: str
    max_uncertainty: float
    invert: bool = False
    name: str = ""

    def __post_init__(self) -> None:
        self.name = self.name or f"{'acquisition' if self.invert else 'uncertainty'}[{self.target}]"

    def mask(self, ctx):
        if self.target not in ctx.uncertainty:
            raise Structural(f"no uncertainty for {self.target}")
        value = F.col(ctx.uncertainty[self.target])
        return above(value, self.max_uncertainty) if self.invert else at_most(value, self.max_uncertainty)

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        if not numbers:
            raise Structural("no uncertainty supplied")
        side = "above" if self.invert else "up to"
        return numbers["kept"] > 0, f"{numbers['kept']} of {numbers['n']} records {side} {self.max_uncertainty}", {"kept": numbers["kept"], "total": numbers["n"]}


@dataclass
class TopKGate(Gate):
    """The k smallest (or largest) of the whole batch; every record gets its rank, numbers before NaN and null."""

    target: str
    k: int
    largest: bool = False
    name: str = ""

    def __post_init__(self) -> None:
        self.name = self.name or f"top_{self.k}[{self.target}]"
        self._rank = f"_rank_{self.target}"

    def annotate(self, frame, ctx):
        if self.target not in ctx.scores:
            raise Structural(f"no scores for {self.target}")
        keys = value_keys(F.col(ctx.scores[self.target]), F.col(ctx.row_id), self.largest)
        return global_rank(frame, keys, self._rank), self._rank

    def mask(self, ctx):
        return F.col(self._rank) < self.k

    def aggregates(self, ctx, mask):
        return {"n": F.count("*"), "kept": _kept(mask)}

    def decide(self, ctx, numbers):
        if not numbers:
            raise Structural("no scores supplied")
        return numbers["kept"] > 0, f"the {numbers['kept']} {'largest' if self.largest else 'smallest'} of {numbers['n']}", {"kept": numbers["kept"], "total": numbers["n"]}


# ---- checks of models ----


def _relative(old: float, new: float) -> float:
    """Improvement as a share of the old value; a bad old value gives NaN."""
    return (old - new) / old if old else math.nan


@dataclass
class SanityGate(Gate):
    """Errors are finite numbers over at least one record."""

    name: str = "sanity"

    def decide(self, ctx, numbers):
        if ctx.candidate is None:
            return False, "no candidate report", {}
        bad = [t for t, m in ctx.candidate.per_target.items() if m.n == 0 or not (math.isfinite(m.mae) and math.isfinite(m.rmse))]
        return not bad, f"no finite errors for {bad}" if bad else "all errors are finite", {"bad_targets": bad}


@dataclass
class FeaturizerBindingGate(Gate):
    """The features come from the featurizer that the model was trained with; unknown means no."""

    name: str = "featurizer_binding"

    def decide(self, ctx, numbers):
        if ctx.versions is None or not ctx.expected_featurizer:
            return False, "the binding is unknown", {}
        own = ctx.versions.featurizer
        return own == ctx.expected_featurizer, f"featurizer {own}, expected {ctx.expected_featurizer}", {"actual": own, "expected": ctx.expected_featurizer}


@dataclass
class ColdStartGate(Gate):
    """Without an incumbent, the candidate must beat the mean predictor clearly."""

    min_improvement: float = 0.20
    name: str = "cold_start"

    def decide(self, ctx, numbers):
        if ctx.incumbent is not None:
            return True, "there is an incumbent", {"applicable": False}
        if ctx.candidate is None or ctx.baseline is None:
            return False, "no baseline to compare with", {}
        old, new = normalized_score(ctx.baseline), normalized_score(ctx.candidate)
        gain = _relative(old, new)
        return gain >= self.min_improvement, f"{gain:+.2%} against the baseline, {self.min_improvement:.0%} wanted", {"baseline": old, "candidate": new, "improvement": gain}


@dataclass
class MinimumMarginGate(Gate):
    """The candidate is better than the incumbent by a margin."""

    min_relative_improvement: float = 0.01
    name: str = "min_margin"

    def decide(self, ctx, numbers):
        if ctx.incumbent is None:
            return True, "no incumbent", {"applicable": False}
        if ctx.candidate is None:
            return False, "no candidate report", {}
        old, new = normalized_score(ctx.incumbent), normalized_score(ctx.candidate)
        gain = _relative(old, new) if old else 0.0  # nothing is better than an error of zero
        return gain >= self.min_relative_improvement, f"{gain:+.2%} against the incumbent, {self.min_relative_improvement:.0%} wanted", {"incumbent": old, "candidate": new, "improvement": gain}


@dataclass
class SignificanceGate(Gate):
    """Paired resampling of per-record errors: the mean of the targets' p-values is small."""

    alpha: float = 0.05
    n_resamples: int = 2000
    seed: int = 0
    resampling: str = "poisson"
    name: str = "significance"

    def decide(self, ctx, numbers):
        if ctx.incumbent is None:
            return True, "no incumbent", {"applicable": False}
        if ctx.candidate is None:
            return False, "no candidate report", {}
        absent = [t for t in ctx.candidate.per_target if t not in ctx.incumbent.per_target]
        if absent:
            return False, f"the incumbent has no errors for {absent}", {"missing": absent}
        found = paired_bootstrap(ctx.candidate, ctx.incumbent, self.n_resamples, self.seed, self.resampling)
        p = sum(x[1] for x in found.values()) / len(found)
        return p <= self.alpha, f"p = {p:.4f}, at most {self.alpha} wanted", {"p_value": p, "per_target": {t: {"delta": d, "p": q} for t, (d, q) in found.items()}, "n_resamples": self.n_resamples}


@dataclass
class NoTargetRegressionGate(Gate):
    """No single target gets worse than a bound."""

    max_relative_regression: float = 0.05
    name: str = "no_target_regression"

    def decide(self, ctx, numbers):
        if ctx.incumbent is None:
            return True, "no incumbent", {"applicable": False}
        if ctx.candidate is None:
            return False, "no candidate report", {}
        changes = {t: -_relative(ctx.incumbent.per_target[t].mae, m.mae) for t, m in ctx.candidate.per_target.items() if t in ctx.incumbent.per_target and ctx.incumbent.per_target[t].mae}
        worse = {t: x for t, x in changes.items() if x > self.max_relative_regression}
        return not worse, f"worse: {worse}" if worse else "no target is much worse", {"relative_change": changes, "regressed": sorted(worse)}


@dataclass
class SliceGate(Gate):
    """No slice of the evaluation set gets worse than a bound; only slices of both reports count."""

    max_relative_regression: float = 0.10
    metric: str = "normalized_mae"
    name: str = "slices"

    def decide(self, ctx, numbers):
        if ctx.incumbent is None:
            return True, "no incumbent", {"applicable": False}
        if ctx.candidate is None:
            return False, "no candidate report", {}
        old = {s: x[self.metric] for s, x in ctx.incumbent.slices.items()}
        changes = {s: -_relative(old[s], x[self.metric]) for s, x in ctx.candidate.slices.items() if old.get(s)}
        worse = {s: x for s, x in changes.items() if x > self.max_relative_regression}
        return not worse, f"worse: {worse}" if worse else "no slice is much worse", {"relative_change": changes, "regressed": sorted(worse)}


# ---- from configuration ----


def validation_gate(cfg: Mapping[str, Any], targets: Sequence[str] = ()) -> CompositeGate:
    """The configured checks of a batch, always in the same order; a bad configuration raises here."""
    checks = cfg.get("checks", {})

    def drift(spec):
        method = str(spec.get("method", "ks"))
        return DriftGate(spec["reference"], drift_threshold(spec, method), tuple(spec.get("columns", ())), bool(spec.get("blocking", False)), method, int(spec.get("buckets", 10)))

    makers: dict[str, Callable[[Any], Gate]] = {
        "schema": lambda s: SchemaGate(list(s["required_columns"])),
        "min_rows": lambda s: MinRowsGate(int(s)),
        "parseable_smiles": lambda s: ParseableSmilesGate(float(s.get("min_fraction", 0.99)), s.get("column", "smiles")),
        "duplicates": lambda s: DuplicateGate(float(s.get("max_fraction", 0.02)), tuple(s.get("subset", ("smiles",)))),
        "target_nan": lambda s: TargetMissingGate(list(targets), float(s.get("max_fraction", 0.01))),
        "drift": drift,
    }
    return CompositeGate([make(checks[k]) for k, make in makers.items() if k in checks], "validation")


def promotion_gate(**overrides: Any) -> CompositeGate:
    """The seven checks of a candidate model; unknown keys are ignored."""
    get = overrides.get
    return CompositeGate(
        [
            SanityGate(),
            FeaturizerBindingGate(),
            ColdStartGate(get("cold_start_min_improvement", 0.20)),
            MinimumMarginGate(get("min_margin", 0.01)),
            SignificanceGate(get("alpha", 0.05), get("n_resamples", 2000), resampling=get("resampling", "poisson")),
            NoTargetRegressionGate(get("max_target_regression", 0.05)),
            SliceGate(get("max_slice_regression", 0.10)),
        ],
        "promotion",
    )


def shortlist_gate(specs: Sequence[Mapping[str, Any]]) -> CompositeGate:
    """Checks of scored records; the featurizer's binding always comes first."""
    kinds: dict[str, type[Gate]] = {"property_threshold": PropertyThresholdGate, "uncertainty": UncertaintyGate, "top_k": TopKGate}
    gates: list[Gate] = [FeaturizerBindingGate()]
    for spec in specs:
        if spec.get("kind") not in kinds:
            raise ValueError(f"unknown gate kind {spec.get('kind')!r}; known: {', '.join(kinds)}")
        gates.append(kinds[spec["kind"]](**{k: v for k, v in spec.items() if k != "kind"}))
    return CompositeGate(gates, "shortlist")
