import math

import duckdb
import numpy as np
import pytest

from sluice.llm import vector_dup
from sluice.llm.vector_dup import Codes, key_sizes, near_duplicates, rotation


def brute(rows):
    valid = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            valid[k] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(rows)
    for i in valid:
        for j in valid:
            if j < i and len(valid[i]) == len(valid[j]) and valid[i] @ valid[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        own = min(ids, default=None) if i in valid else d
        out.append((d, links[i], own, d == own))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 24))
    out = [(500 - k, [float(x) for x in (base[k % 12] + rng.normal(size=24) * rng.choice([0, 0.05, 0.15, 0.3])).astype(np.float32)]) for k in range(200)]
    out += [(1000 + k, [float(x) for x in rng.normal(size=24)]) for k in range(60)]
    out += [(k, [float(k % 3), 1.0, 0.5]) for k in range(5)]
    out += [(7, None), (8, []), (9, [0.0] * 24), (10, [math.nan] * 24), (11, [None, 1.0]), (12, [math.inf, 1.0]), (13, [1e300, 1e300]), (14, [2.0, 2.0]), (13, [1.0, 1.0]), (None, [1.0, 1.0]), (15, [3.0]), (16, [-3.0]), (17, [1e-300])]
    return out


@pytest.mark.parametrize("tile", [4096, 16, 3])
def test_equals_brute_force(spark, rows, monkeypatch, tile):
    monkeypatch.setattr(vector_dup, "TILE", tile)
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cid int, sid string, n int").repartition(3)
    got = sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def near_at(x, cosine, rng):
    """Unit vectors at the given cosines to unit vectors x."""
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    y = cosine * x + np.sqrt(1 - cosine**2) * np.divide(noise, length, out=np.zeros_like(noise), where=length > 1e-9)
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def test_no_linked_pair_is_ruled_out_by_its_estimate():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 8, 64, 200):
        x = rng.normal(size=(4000, d))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = near_at(x, 0.9501, rng)
        codes, other = Codes.of(x), Codes.of(y)
        k = np.arange(4000)
        assert codes.may_be_near(k, k, other).all() and other.may_be_near(k, k, codes).all()
        if d >= 64:  # unrelated pairs are ruled out, and estimates are unbiased
            assert codes.may_be_near(k, (k + 1) % 4000).mean() < 0.01
            assert abs((codes.estimates(k, other, k) - (x * y).sum(1)).mean()) < 0.005


def test_estimates_against_plain_loops():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5, 70))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = Codes.of(x)
    turned, dither = x @ rotation(70), np.random.default_rng([7, 70]).random(70)
    for i in range(5):
        for j in range(5):
            step = (turned[j].max() - turned[j].min()) / 15
            q = [turned[j].min() + step * math.floor((v - turned[j].min()) / step + t) for v, t in zip(turned[j], dither, strict=True)]
            c = [math.copysign(1 / math.sqrt(70), v) for v in turned[i]]
            factor = sum(a * b for a, b in zip(c, turned[i], strict=True))
            want = sum(a * b for a, b in zip(c, q, strict=True)) / factor
            assert codes.estimates(np.array([i]), codes, np.array([j]))[0] == pytest.approx(want)


@pytest.fixture(scope="module")
def planted():
    """3,000 vectors of 64 components; 300 pairs at cosines from 0.95 to 1, and a group of 400 near copies."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = near_at(x[:300], np.linspace(0.95001, 0.9999, 300)[:, None], rng)
    copies = near_at(np.repeat(x[999:], 400, 0), rng.uniform(0.97, 0.999, (400, 1)), rng)
    others = rng.normal(size=(1300, 64))
    return np.concatenate([x, y, copies, others])


@pytest.mark.parametrize("tile", [4096, 100])
def test_all_links_of_planted_vectors_are_found(spark, planted, monkeypatch, tile):
    monkeypatch.setattr(vector_dup, "TILE", tile)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(planted)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_duplicates(df).collect()}
    unit = planted / np.linalg.norm(planted, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    assert near.sum() > 2 * 300 and [got[i].n_links for i in range(len(unit))] == near.sum(1).tolist()
    label = np.arange(len(unit))
    while (new := np.array([min(label[i], label[near[i]].min(initial=len(unit))) for i in range(len(unit))])).tolist() != label.tolist():
        label = new
    assert [got[i].component_id for i in range(len(unit))] == label.tolist()


def test_against_the_sql_on_a_table_with_links(spark, planted):
    some = np.concatenate([planted[:150], planted[1000:1150], planted[1300:1420], planted[1700:1800]])
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(some)]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({vector_dup.oracle_sql()}) ORDER BY vec_id").fetchall()
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").collect()
    assert [tuple(r) for r in got] == want and sum(n for _, n, _, _ in want) > 2 * 150


def test_keys_grow_with_the_number_of_vectors():
    sizes = [key_sizes(n) for n in (1, 500, 50_000, 10**9)]
    assert sizes == sorted(sizes) and all((1 - (1 - math.acos(0.95) / math.pi) ** b) ** t <= 1e-6 for b, t in sizes)


def test_groups_of_unrelated_vectors_do_not_grow(spark):
    rng = np.random.default_rng(1)
    means = []
    for n in (2000, 8000):
        bits, tables = key_sizes(n)
        keys = (rng.normal(size=(n, 64)) @ vector_dup._planes_of_keys(64, bits * tables)[:, :bits] >= 0) @ (1 << np.arange(bits))
        means.append(np.bincount(keys)[keys].mean())
    assert means[1] < 1.5 * means[0] < 150


def test_rotation_keeps_lengths():
    assert np.allclose(rotation(17) @ rotation(17).T, np.eye(17))


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_rows_of_a_slice_equal_those_of_lists():
    """Valid vectors by loops; batches may be slices, with nulls at any place."""
    import pyarrow as pa

    lists = [[1.0, -2.0], None, [], [0.0, 0.0], [float("nan"), 1.0], [None, 1.0], [float("inf"), 1.0], [1e300, 1e300], [-0.0, 3.0, 1e-300], [5.0]]
    for vectors in (lists, lists[::-1], lists[2:3], lists[4:7]):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(vectors) + 2)), pa.array([[9.0], *vectors, [8.0]], pa.list_(pa.float64()))], names=["vec_id", "embedding"])
        (found,) = vector_dup._rows(iter([batch.slice(1, len(vectors))]))
        want = []
        for x in vectors:
            ok = x and all(c is not None and math.isfinite(c) for c in x) and any(x)
            v = np.array(x, dtype=np.float64) / np.abs(x).max() if ok else None
            want.append(None if v is None else v.tobytes())
        assert found.column("v").to_pylist() == want and found.column("vec_id").to_pylist() == list(range(1, len(vectors) + 1))
        assert [d is None for d in found.column("sid").to_pylist()] == [w is None for w in want]
