import math
from fractions import Fraction

import numpy as np
import pytest

from sluice.llm import whitening
from sluice.llm.whitening import Whitening, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, deviation string, component string, x int, n string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "d", "c", 2, "n") for r in rows], SCHEMA).repartition(parts)


def brute(rows, components=8):
    """{vec_id: (deviation, whitened)}, eigenvalues and total variance, of valid rows with distinct ids."""
    x = {k: [math.floor(1024 * c) + 100_000 for c in v] for k, v in rows}
    n, sums = len(x), [sum(c) for c in zip(*x.values(), strict=True)]
    apart = {k: [n * a - s for a, s in zip(v, sums, strict=True)] for k, v in x.items()}
    exact = np.array([[float(Fraction(a, n)) for a in v] for v in apart.values()])
    values, vectors = np.linalg.eigh(exact.T @ exact / n)
    order = np.argsort(values)[::-1][:components]
    total = float(Fraction(sum(a * a for v in apart.values() for a in v), n**3))
    white = exact @ vectors[:, order] / np.sqrt(values[order])
    return {k: (sum(a * a for a in v), w) for (k, v), w in zip(apart.items(), white, strict=True)}, values[order], total


def embeddings(n, d, seed=3):
    rng = np.random.default_rng(seed)
    return [(k, [float(c) for c in v]) for k, v in enumerate((rng.normal(size=(n, d)) * np.linspace(0.1, 2, d) + 3).astype(np.float32))]


@pytest.mark.parametrize(("n", "d"), [(300, 12), (40, 3), (500, 64)])
def test_against_numpy(spark, n, d):
    rows = embeddings(n, d)
    expected, values, total = brute(rows)
    found = whiten(table(spark, rows)).collect()
    k = min(8, d)
    assert sorted((r.vec_id, r.component) for r in found) == [(i, c + 1) for i in range(n) for c in range(k)]
    signs = {}
    for r in found:
        deviation, white = expected[r.vec_id]
        assert r.n == n and r.deviation == deviation == int(r.exact_deviation)
        assert r.identity_error < 1e-9 and math.isclose(r.explained, values[r.component - 1] / total, rel_tol=1e-9)
        sign = signs.setdefault(r.component, 1 if (r.whitened > 0) == (white[r.component - 1] > 0) else -1)
        assert abs(sign * r.whitened - white[r.component - 1]) < 1e-8


def test_odd_rows(spark):
    """Null, empty and non-finite vectors, those of another length and huge entries go; repeated and missing ids stay."""
    good = embeddings(60, 4)
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [math.nan] * 4), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0]), (106, [1e200] * 4)]
    more = [(0, good[0][1]), (None, good[1][1]), (None, good[1][1])]
    found = whiten(table(spark, good + odd + more)).collect()
    assert {r.n for r in found} == {63} and len(found) == 63 * 4
    assert sorted(r.vec_id for r in found if r.vec_id is not None) == sorted(k for k in [*range(60), 0] for _ in range(4))
    same = [r.whitened for r in found if r.vec_id == 0 and r.component == 1]
    assert len(same) == 2 and same[0] == same[1]
    alone, _, _ = brute([(k, v) for k, (_, v) in enumerate(good + more)])
    assert {r.vec_id: r.deviation for r in found if r.vec_id is not None} == {k: alone[k][0] for k in range(60)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(k, [1.0, 2.0, 3.0]) for k in range(9)]], ids=["empty", "none valid", "one", "equal"])
def test_no_variance(spark, rows):
    df = whiten(table(spark, rows))
    assert df.collect() == [] and df.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_components_without_variance(spark):
    rows = [(k, [float(v[0]), 2 * float(v[0]), float(v[1]), 5.0]) for k, (_, v) in enumerate(embeddings(50, 2))]
    rows = [(k, [round(64 * c) / 64 for c in v[:1]] + [2 * round(64 * v[0]) / 64] + [round(64 * v[2]) / 64, 5.0]) for k, v in rows]
    found = whiten(table(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2} and abs(sum(r.explained for r in found) / 50 - 1) < 1e-9


def test_exact_beyond_64_bits():
    """Counts and sums of 10^13 rows: Python's whole numbers take over, and a deviation may leave the long but not the decimal."""
    n = 10**13
    fit = Whitening(n, [n * 100_000 + 7, n * 99_000], np.zeros(0), np.zeros((2, 0)), 0.0)
    x = np.array([[100_300, 98_000], [100_000, 99_000]])
    apart = fit.centred(x)
    assert apart.tolist() == [[300 * n - 7, -1000 * n], [-7, 0]]
    assert whitening._decimals(apart * apart).to_pylist() == [(300 * n - 7) ** 2 + (1000 * n) ** 2, 49]
    small = Whitening(10, [1_000_007, 990_000], np.zeros(0), np.zeros((2, 0)), 0.0).centred(x)
    assert small.dtype == np.int64 and small.tolist() == [[2993, -10_000], [-7, 0]]
