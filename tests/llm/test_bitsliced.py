import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import bitsliced
from sluice.llm.bitsliced import Block, digits, top_k

SCHEMA = "vec_id long, embedding array<double>, label int, block int, numbers string, rank int, score string"


def brute(rows, k=5, scale=256):
    valid = []
    for place, (vec_id, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            n = [math.floor(scale * x) for x in v]
            if max(map(abs, n)) < bitsliced.LARGEST:
                valid.append((place, vec_id, n))
    out = []
    for place, vec_id, q in valid:
        if vec_id is None or vec_id % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(q, n, strict=True)), other is None, other) for p, other, n in valid if p != place and len(n) == len(q)]
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(vec_id, r + 1, other, -score) for r, (score, _, other) in enumerate(scored[:k])]
    return sorted(out, key=str)


def found(spark, rows, parts=3, **options):
    wide = [(*r, 1, 2, "n", 3, "s") for r in rows]
    df = top_k(spark.createDataFrame(wide, SCHEMA).repartition(parts), F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def vectors(n, d, seed=1, scale=1.0):
    return [[float(x) for x in v] for v in np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32) * scale / math.sqrt(d)]


def cases():
    yield "random", [(k, v) for k, v in enumerate(vectors(900, 16))]
    yield "ties", [(400 - k, [float(k % 3), 0.5, float(k % 2)]) for k in range(400)]
    yield "copies", [(k, [0.25, -0.5, 0.125]) for k in range(300)] + [(k + 300, v) for k, v in enumerate(vectors(40, 3))]
    yield "one component, one bit", [(k, [1.0 if k % 7 else 0.0]) for k in range(120)]
    yield "zeros", [(k, [0.0, 0.0]) for k in range(60)]
    yield "large numbers", [(k, v) for k, v in enumerate(vectors(200, 5, scale=9000.0))] + [(900, [65536.0] * 5), (950, [-65535.0] * 5), (1000, [1e300] * 5)]
    odd = [(0, None), (50, []), (100, [math.nan, 1.0]), (150, [None, 1.0]), (200, [math.inf, 0.0]), (None, [1.0, 1.0]), (None, [0.5, 0.5]), (250, [3.0]), (300, [1.0, 2.0]), (300, [1.0, 2.0]), (300, [1.0, 2.5]), (7, [-0.001, 0.999])]
    yield "odd rows", odd
    yield "lengths", [(k, v[: 2 + k % 3]) for k, v in enumerate(vectors(150, 4))]
    yield "one row", [(0, [1.0])]


CASES = dict(cases())


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [8192, 64])
def test_against_all_pairs(spark, monkeypatch, name, block):
    monkeypatch.setattr(bitsliced, "BLOCK", block)
    assert found(spark, CASES[name]) == brute(CASES[name])


def test_other_k_and_scale(spark):
    rows = CASES["random"][:200]
    assert found(spark, rows, k=250, scale=10.0) == brute(rows, 250, 10)
    assert found(spark, rows, k=1) == brute(rows, 1)


def test_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == []


def test_digits():
    for n in [*range(-700, 700), 12345678, -(1 << 24)]:
        parts = digits(n)
        assert sum(sign << place for place, sign in parts) == n
        assert all(b - a > 1 for (a, _), (b, _) in zip(parts, parts[1:], strict=False))


@pytest.mark.parametrize("slices", [1, 3, 30])
def test_bounds_of_sums(monkeypatch, slices):
    """Sums with what is left out enclose the exact scores, whatever number of slices is kept; the bitmaps' answers match plain ones."""
    monkeypatch.setattr(bitsliced, "SLICES", slices)
    rng = np.random.default_rng(slices)
    import pyarrow as pa

    numbers = rng.integers(-400, 300, size=(200, 7)).astype("<i4")
    numbers[:, 3] = 5
    table = pa.table({"numbers": pa.array([n.tobytes() for n in numbers])})
    row = {"dim": 7, "vec_ids": np.arange(200).tobytes(), "missing": np.zeros(200, dtype=bool).tobytes(), "row_ids": np.arange(200).tobytes(), "numbers": numbers.tobytes()}
    block = Block(row | bitsliced._slices(table, 7))
    for query in rng.integers(-300, 300, size=(20, 7)):
        exact = numbers.astype(np.int64) @ query
        maps, base, short = block.sums(query.tolist())
        sums = sum(np.unpackbits(m.view(np.uint8), bitorder="little")[:200].astype(np.int64) << k for k, m in enumerate(maps))
        assert (sums + base <= exact).all() and (exact <= sums + base + short).all()
        if slices == 30:
            assert short == 0
        for k in (1, 5, 200):
            kth = block.highest(maps, k, block.valid)
            assert kth == np.sort(sums)[-k]
            assert block.rows_from(maps, kth, block.valid).tolist() == np.flatnonzero(sums >= kth).tolist()
