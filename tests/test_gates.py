import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.operators.decisions import GateResult, Versions, merge_decisions
from sluice.operators.gates import (
    CompositeGate, DriftGate, DuplicateGate, Gate, GateContext, MinRowsGate, ParseableSmilesGate, PredicateGate, PropertyThresholdGate, SchemaGate,
    TargetMissingGate, TopKGate, UncertaintyGate, drift_threshold, promotion_gate, shortlist_gate, validation_gate,
)
from sluice.operators.metrics import EvalReport, TargetMetrics
from sluice.plans.triage import annotate_shortlist
from sluice.plans.validation import apply_policy, validate

TARGETS = ("mu", "alpha", "homo")
NAN = float("nan")


def report(spark, scale=1.0, version="m", targets=TARGETS, n=80, scales=None, mae=None, slices=None):
    rng = np.random.default_rng(0)
    rows, per, std = [], {}, {}
    for k, t in enumerate(targets):
        errors = np.abs(rng.normal(size=n)) * (scales or {}).get(t, scale) * (1 + 0.1 * k)
        rows += [(i, t, float(e)) for i, e in enumerate(errors)]
        m = float(errors.mean()) if mae is None else mae
        per[t] = TargetMetrics(t, m, float(np.sqrt((errors**2).mean())) if mae is None else mae, 0.5, n)
        std[t] = 1 + 0.1 * k
    return EvalReport(version, "golden", per, std, slices or {}, spark.createDataFrame(rows, "row_id long, target string, abs_err double"))


def promote(spark, candidate, incumbent=None, baseline=None, featurizer="f@1/2", expected="f@1/2", **overrides):
    ctx = GateContext(candidate=candidate, incumbent=incumbent, baseline=baseline, versions=Versions(featurizer=featurizer), expected_featurizer=expected)
    return promotion_gate(n_resamples=200, **overrides).evaluate(ctx)


def failed(decision):
    return {r.name for r in decision.failed}


def test_promotion_decisions(spark):
    base, inc = report(spark, 1.0, "base"), report(spark, 1.0, "inc")
    assert promote(spark, report(spark, 0.8), inc).verdict
    assert {"min_margin", "significance", "no_target_regression"} <= failed(promote(spark, report(spark, 1.3), inc))
    assert "min_margin" in failed(promote(spark, report(spark, 1.0), inc))
    assert "min_margin" in failed(promote(spark, report(spark, 0.998), inc))
    worse_one = report(spark, scales={"mu": 0.5, "alpha": 0.5, "homo": 1.2})
    assert failed(promote(spark, worse_one, inc)) >= {"no_target_regression"}
    assert promote(spark, report(spark, 0.5), baseline=base).verdict
    assert failed(promote(spark, report(spark, 0.5))) == {"cold_start"}
    assert failed(promote(spark, report(spark, 0.9), baseline=base)) == {"cold_start"}
    assert "sanity" in failed(promote(spark, report(spark, 0.5, mae=NAN), inc))
    assert failed(promote(spark, report(spark, 0.8), inc, expected="f@1/3")) == {"featurizer_binding"}
    assert failed(promote(spark, report(spark, 0.8), inc, expected=None)) == {"featurizer_binding"}


def test_all_seven_checks_report_and_misaligned_errors_fail(spark):
    inc = report(spark, 1.0)
    assert len(promote(spark, report(spark, 1.3), inc).results) == 7
    short = report(spark, 0.5, n=70)
    decision = promote(spark, short, inc)
    bad = next(r for r in decision.results if r.name == "significance")
    assert not bad.verdict and "pair" in bad.reason
    less = report(spark, 1.0, targets=("mu", "alpha"))
    assert "significance" in failed(promote(spark, report(spark, 0.5), less))


def test_slices_in_both_reports_only(spark):
    old = report(spark, 1.0, slices={"a": {"normalized_mae": 1.0, "n": 30}, "b": {"normalized_mae": 1.0, "n": 30}})
    new = report(spark, 0.8, slices={"a": {"normalized_mae": 1.2, "n": 30}, "c": {"normalized_mae": 9.0, "n": 30}})
    assert failed(promote(spark, new, old)) == {"slices"}
    assert promote(spark, new, old, max_slice_regression=0.5, unknown_key=1).verdict


def test_merge_prefixes_and_drops_masks(spark):
    a = promote(spark, report(spark, 0.8), report(spark, 1.0))
    b = promote(spark, report(spark, 1.3), report(spark, 1.0))
    both = merge_decisions({"golden": a, "rolling": b})
    assert not both.verdict and both.results[0].name == "golden:sanity" and not both.masks
    assert "rolling:min_margin" in both.summary() and both.as_dict()["verdict"] is False


@pytest.fixture
def scores(spark):
    rows = [(0, 1.0, 0.1), (1, NAN, 0.1), (2, None, 0.1), (3, 3.0, NAN), (4, 2.0, 0.5), (5, 2.0, None), (6, float("inf"), 0.0), (7, float("-inf"), 0.0)]
    return spark.createDataFrame(rows, "row_id long, pred_gap double, unc_gap double")


def evaluate(frame, *gates, **more):
    return CompositeGate(gates).evaluate(GateContext(frame=frame, scores={"gap": "pred_gap"}, uncertainty={"gap": "unc_gap"}, **more))


def ids(frame):
    return sorted(r.row_id for r in frame.collect())


def test_nan_and_null_satisfy_no_bound(scores):
    assert ids(evaluate(scores, PropertyThresholdGate("gap", minimum=2.0)).rows()) == [3, 4, 5, 6]
    assert ids(evaluate(scores, PropertyThresholdGate("gap", maximum=2.0)).rows()) == [0, 4, 5, 7]
    sure = ids(evaluate(scores, UncertaintyGate("gap", 0.1)).rows())
    unsure = ids(evaluate(scores, UncertaintyGate("gap", 0.1, invert=True)).rows())
    assert sure == [0, 1, 2, 6, 7] and unsure == [4]


def test_rank_puts_missing_last_both_ways_and_is_a_permutation(scores):
    for largest, want in ((True, [6, 3, 4, 5, 0, 7, 1, 2]), (False, [7, 0, 4, 5, 3, 6, 1, 2])):
        d = evaluate(scores, TopKGate("gap", 3, largest))
        got = [r.row_id for r in d.frame.orderBy(d.ranking).collect()]
        assert got == want and ids(d.rows()) == sorted(want[:3])
        assert sorted(r[0] for r in d.frame.select(d.ranking).collect()) == list(range(8))


def test_masks_are_independent_and_the_first_check_is_blamed(scores):
    d = evaluate(scores, PropertyThresholdGate("gap", maximum=2.0), TopKGate("gap", 3, largest=True))
    assert d.n_selected == 1 and ids(d.rows()) == [4]  # ranked among all rows, not among survivors
    out = {r.row_id: r.dropped_by for r in annotate_shortlist(d).collect()}
    assert out[4] == "" and out[6] == "threshold[gap]" and out[5] == "top_3[gap]"


def test_nothing_selected_is_a_failed_decision(scores):
    d = evaluate(scores, PropertyThresholdGate("gap", minimum=100.0, maximum=200.0))
    assert not d.verdict and d.n_selected == 0 and d.failed[0].name == "threshold[gap]"
    both = evaluate(scores, PropertyThresholdGate("gap", minimum=3.0), PropertyThresholdGate("gap", maximum=1.0))
    assert not both.verdict and all(r.verdict for r in both.results)


class Raises(Gate):
    name, blocking = "raises", False

    def decide(self, ctx, numbers):
        raise RuntimeError("no")


class BadColumn(Gate):
    name = "bad_column"

    def mask(self, ctx):
        return F.col("nowhere") > 0

    def decide(self, ctx, numbers):
        return True, "", {}


class BadAtRunTime(Gate):
    name = "bad_at_run_time"

    def aggregates(self, ctx, mask):
        return {"x": F.sum(F.raise_error(F.lit("boom")).cast("long"))}

    def decide(self, ctx, numbers):
        return True, "", {}


def test_a_gate_that_raises_fails_alone_and_blocks(scores):
    d = evaluate(scores, Raises(), BadColumn(), BadAtRunTime(), MinRowsGate(3), PropertyThresholdGate("gap", 0.0))
    verdicts = {r.name: r.verdict for r in d.results}
    assert verdicts == {"raises": False, "bad_column": False, "bad_at_run_time": False, "min_rows": True, "threshold[gap]": True}
    assert len(d.failed) == 3 and not d.verdict


def test_shortlist_factory(scores):
    specs = [{"kind": "property_threshold", "target": "gap", "minimum": 0.0}, {"kind": "top_k", "target": "gap", "k": 2, "largest": False}]
    gate = shortlist_gate(specs)
    assert [g.name for g in gate.gates] == ["featurizer_binding", "threshold[gap]", "top_2[gap]"]
    with pytest.raises(ValueError):
        shortlist_gate([{"kind": "magic"}])


@pytest.fixture
def molecules(spark):
    rows = [(0, "CCO", 1.0), (1, "CCO", 2.0), (2, "not_a_molecule", 3.0), (3, None, 4.0), (4, None, 5.0), (5, "C1CC1", NAN), (6, "C(((", 1.0), (7, "c1ccccc1", None)]
    return spark.createDataFrame(rows, "row_id long, smiles string, mu double")


def test_validation_masks(molecules):
    def kept(gate):
        d = CompositeGate([gate]).evaluate(GateContext(frame=molecules))
        return ids(d.rows()), d.results[0]

    assert kept(ParseableSmilesGate(0.9))[0] == [0, 1, 5, 7]
    rows, result = kept(DuplicateGate(0.3))
    assert rows == [0, 2, 3, 5, 6, 7] and result.verdict and result.evidence["n_duplicates"] == 2
    rows, result = kept(TargetMissingGate(["mu"], 0.1))
    assert rows == [0, 1, 2, 3, 4, 6] and not result.verdict and result.mask


def test_missing_columns_are_structural(molecules):
    d = CompositeGate([SchemaGate(["smiles", "gap"]), TargetMissingGate(["gap"], 0.5), ParseableSmilesGate(0.1, "structure")]).evaluate(GateContext(frame=molecules))
    assert [r.verdict for r in d.results] == [False, False, False] and not d.masks


CHECKS = {"schema": {"required_columns": ["smiles"]}, "min_rows": 2, "parseable_smiles": {"min_fraction": 0.4}, "duplicates": {"max_fraction": 0.5}, "target_nan": {"max_fraction": 0.5}}


def test_policies(molecules):
    out = validate(molecules, {"checks": CHECKS}, ["mu"])
    assert out.status == "accepted_with_quarantine" and ids(out.accepted) == [0] and out.n_quarantined == 7
    why = {r.row_id: r.dropped_by for r in out.quarantined.collect()}
    assert why == {1: "duplicates", 2: "parseable_smiles", 3: "parseable_smiles", 4: "parseable_smiles", 5: "target_nan", 6: "parseable_smiles", 7: "target_nan"}
    assert validate(molecules, {"checks": CHECKS, "on_failure": "reject_chunk"}, ["mu"]).status == "rejected"
    warned = validate(molecules, {"checks": CHECKS | {"min_rows": 100}, "on_failure": "warn"}, ["mu"])
    assert warned.status == "accepted" and warned.accepted.count() == 8
    few = validate(molecules, {"checks": CHECKS | {"min_rows": 100}}, ["mu"])
    assert few.status == "rejected" and not few.usable
    strict = validate(molecules, {"checks": CHECKS | {"parseable_smiles": {"min_fraction": 0.99}}}, ["mu"])
    assert not strict.decision.verdict and strict.status == "accepted_with_quarantine"
    with pytest.raises(ValueError):
        apply_policy(molecules, strict.decision, "ignore")


def test_empty_frames(spark, molecules):
    empty = molecules.limit(0)
    d = validation_gate({"checks": CHECKS}, ["mu"]).evaluate(GateContext(frame=empty))
    verdicts = {r.name: r.verdict for r in d.results}
    assert verdicts == {"schema": True, "min_rows": False, "parseable_smiles": False, "duplicates": True, "target_nan": True}
    assert not evaluate(spark.createDataFrame([], "row_id long, pred_gap double, unc_gap double"), TopKGate("gap", 3, largest=True)).verdict


def test_factory_order_and_drift_configuration(tmp_path):
    names = [g.name for g in validation_gate({"checks": {"target_nan": {}, "drift": {"reference": "x"}, "schema": {"required_columns": []}}}, ["mu"]).gates]
    assert names == ["schema", "target_nan", "drift"]
    with pytest.raises(ValueError):
        DriftGate("x", method="chi2")
    for spec, method in (({"max_statistic": 0.3}, "ks"), ({"max_statistic": {"ks": 0.3}}, "psi"), ({}, "chi2")):
        with pytest.raises(ValueError):
            drift_threshold(spec, method)
    assert drift_threshold({}, "psi") == 0.25


def test_drift_gate_warns_unless_blocking(spark, tmp_path):
    from sluice.operators.drift import freeze_reference

    rng = np.random.default_rng(0)
    frame = lambda shift: spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(7.5 + shift, 1, 400))], "row_id long, alpha double")
    path = freeze_reference(frame(0), ["alpha", "absent"], 101).save(tmp_path / "ref.json")
    for method in ("ks", "psi"):
        run = lambda f, **k: CompositeGate([DriftGate(str(path), method=method, **k)]).evaluate(GateContext(frame=f))  # noqa: E731, B023
        same, far = run(frame(0)), run(frame(3))
        assert same.verdict and not same.warnings and far.verdict and far.warnings[0].evidence["worst_column"] == "alpha"
        assert not run(frame(3), blocking=True).verdict
    none = CompositeGate([DriftGate(str(tmp_path / "none.json"))]).evaluate(GateContext(frame=frame(0)))
    assert none.verdict and none.results[0].evidence["evaluated"] is False


def test_predicates_over_null_are_false(spark):
    df = spark.createDataFrame([(0, "a"), (1, None)], "row_id long, s string")
    d = CompositeGate([PredicateGate(lambda f: F.length("s") > 0, 0.5, ["s"])]).evaluate(GateContext(frame=df))
    assert ids(d.rows()) == [0] and math.isclose(d.results[0].evidence["fraction"], 0.5)


def test_results_know_what_blocks():
    r = GateResult("a", False, "", blocking=False)
    assert r.mask is None and not r.blocking
