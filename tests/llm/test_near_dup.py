import random

import numpy as np
import pytest

from sluice.llm import near_dup
from sluice.llm.components import connected_components
from sluice.llm.merging import Merged
from sluice.llm.session import work_dir
from sluice.llm.shingles import Signer


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        own = d if not sets[i] else min(ids, default=None)
        out.append((d, len(sets[i]), own, d == own))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    word = lambda: "".join(r.choices("abcdefgh", k=r.randint(2, 6)))
    passage = " ".join(word() for _ in range(40))
    base = [[word() for _ in range(120)] for _ in range(6)]
    out = []
    for k in range(150):
        b = list(base[k % 6])
        for _ in range(r.choice([0, 0, 1, 2, 4, 6, 9])):
            b[r.randrange(len(b))] = word()
        out.append((1000 - k, " ".join(b) + (f" {passage}" if k % 2 else "")))
    out += [(2000 + k, f"{passage} " + " ".join(word() for _ in range(90))) for k in range(60)]
    out += [(5, "A b C d"), (6, "a B c D"), (7, "a b c"), (8, None), (9, ""), (10, "  \n"), (10, " ".join(base[0])), (10, " ".join(base[0])), (None, " ".join(base[1])), (None, "unique words that nobody else has used")]
    return out


@pytest.mark.parametrize(("tile", "refine"), [(1024, 4096), (16, 8)])
def test_equals_brute_force_for_any_constants(spark, rows, monkeypatch, tile, refine):
    monkeypatch.setattr(near_dup, "TILE", tile)
    monkeypatch.setattr(near_dup, "REFINE", refine)
    rows = rows if tile == 1024 else rows[::3]  # divisions multiply the rows
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_one_of_each_component_stays(spark, rows):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, sid string")
    kept = near_dup.keep_one(df)
    want = brute(rows)
    components = {c for d, n, c, _ in want if n}
    assert kept.columns == df.columns and kept.count() == len(components - {None}) + sum(n == 0 for _, n, _, _ in want) + (None in components)
    again = near_dup.near_duplicates(kept).filter("n_shingles > 0").collect()
    assert len({r.component_id for r in again}) == len(again)


def test_repeated_rows_and_clashing_columns(spark):
    names = ["text_hash", "id", "sid", "n", "n_rows", "_text_hash", "component_id"]
    rows = [(1, "", *names), (1, "", *names), (2, "a b", *names), (2, "a b", *names), (3, "A b", *names), (None, None, *names), (None, " \n", *names)]
    df = spark.createDataFrame(rows, ["doc_id", "text", *names])
    got = sorted((tuple(r) for r in near_dup.keep_one(df).collect()), key=str)
    want = [rows[0], rows[1], (2, "a b", *names), rows[5], rows[6]]
    assert got == sorted(want, key=str)


def test_a_division_keeps_all_pairs_within_the_guarantee():
    rng = np.random.default_rng(3)
    for used in (0b111, 0b1011 << 20, 0b1101 << 60, 0b11100011):
        places = near_dup.finer_patterns(used)
        free = [k for k in range(near_dup.SLOTS) if not used >> k & 1]
        for _ in range(300):
            wrong = set(rng.choice(free, near_dup.GUARANTEED, replace=False).tolist())
            assert any(a not in wrong and b not in wrong for a, b in places.tolist())


def test_edges(edges):
    got = near_dup.near_duplicates(edges).collect()
    assert len(got) == edges.count() and near_dup.near_duplicates(edges.limit(0)).count() == 0
    assert near_dup.keep_one(edges).columns == edges.columns


def test_all_signatures_within_the_guarantee_meet():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (200, near_dup.SLOTS)).astype(np.uint16)
    b = a.copy()
    for k in range(200):
        b[k, rng.choice(near_dup.SLOTS, near_dup.GUARANTEED, replace=False)] ^= 1
    ka, kb = near_dup.chunk_keys(a), near_dup.chunk_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist(), strict=True))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    y = np.concatenate([x[:857], rng.integers(0, 1 << 63, 143, dtype=np.uint64)])  # similarity 857 / 1143 = 0.75
    s = Signer(2048, 1).sign([np.unique(x), np.unique(y)])
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.04


def test_common_sizes_by_products():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 6000, n, dtype=np.uint64)) for n in (0, 1, 50, 3000, 3000, 10, 4000)]
    left, right = np.array([0, 2, 3, 6]), np.array([1, 2, 4, 5])
    got = near_dup._common(sets, left, right)
    # a set isn't compared with itself: what no other set holds is left out of the products
    assert all(got[a, b] == len(np.intersect1d(sets[i], sets[j])) for a, i in enumerate(left) for b, j in enumerate(right) if i != j)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 300), (201, 200), (200, 201), (202, 201)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.v: r.label for r in connected_components(df, work_dir(spark, "cc")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(df.limit(0), work_dir(spark, "cc")).count() == 0


def test_union_of_rows():
    m = Merged(10)
    m.add(np.array([3, 4, 9]), np.array([4, 5, 8]))
    m.add(np.array([5, 0]), np.array([9, 1]))
    assert m.up.tolist() == [0, 0, 2, 3, 3, 3, 6, 7, 3, 3]
