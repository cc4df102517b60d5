import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import hmm_lm


def test_forward_equals_the_sum_over_paths():
    model = hmm_lm.Hmm(np.random.default_rng(0).integers(1, 50, 20))
    model.move = np.random.default_rng(1).dirichlet(np.ones(hmm_lm.STATES), hmm_lm.STATES)
    texts = [np.array([3]), np.array([1, 19, 4]), np.array([0, 0, 7, 5])]
    for x, got in zip(texts, model.log_likelihoods(texts), strict=True):
        total = 0.0
        for path in itertools.product(range(hmm_lm.STATES), repeat=len(x)):
            p = model.start[path[0]] * model.emit[x[0], path[0]]
            for a, b, c in zip(path[:-1], path[1:], x[1:], strict=True):
                p *= model.move[a, b] * model.emit[c, b]
            total += p
        assert got == pytest.approx(math.log(total))


def test_expected_counts_and_learning():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 10, rng.integers(1, 600)) + 10 * int(rng.integers(0, 2)) for _ in range(60)]  # two halves of the alphabet
    model = hmm_lm.Hmm(np.bincount(np.concatenate(texts), minlength=20))
    start, move, emit = model.expected(texts)
    assert emit.sum() == pytest.approx(sum(map(len, texts))) and np.allclose(emit.sum(1), np.bincount(np.concatenate(texts), minlength=20))
    assert start.sum() == pytest.approx(len(texts))  # one start for each text, however many sequences it is cut into
    assert move.sum() == pytest.approx(sum(len(x) - -(-len(x) // hmm_lm.SEGMENT) for x in texts))
    before = model.log_likelihoods(texts).sum()
    for _ in range(15):
        model.update(*model.expected(texts))
    assert model.log_likelihoods(texts).sum() > before + 0.3 * sum(map(len, texts))


@pytest.mark.parametrize("head", [1 << 17, 8])
def test_counts_and_base_score(spark, monkeypatch, head):
    monkeypatch.setattr(hmm_lm, "HEAD", head)
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["Alpha", "beta", "gamma", "Ünder", f"rare{r.randrange(300)}"]) for _ in range(r.randint(0, 40)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "x " * 3000), (None, "alpha beta"), (5, rows[5][1]), (7, rows[3][1])]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, uid int").repartition(3)
    model = hmm_lm.learn(df)
    got = sorted((tuple(x) for x in hmm_lm.score(model).collect()), key=str)
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 10 == 0
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        w = tokens(t)
        want.append((d, held(d), len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)))
    assert len(got) == len(want)
    for g, x in zip(got, sorted(want, key=str), strict=True):
        assert g[:5] == x[:5] and g[5] == pytest.approx(x[5], rel=1e-9) and math.isfinite(g[6]) and g[6] < 0


def test_better_than_counts_on_held_out_text(spark):
    r = random.Random(3)
    languages = [[f"{p}{k}" for k in range(40)] for p in ("a", "b", "c", "d")]
    rows = [(i, " ".join(r.choice(languages[i % 4]) for _ in range(60))) for i in range(400)]
    out = hmm_lm.score(hmm_lm.learn(spark.createDataFrame(rows, "doc_id long, text string"))).filter("held_out").toPandas()
    assert out.score.sum() / out.n_tokens.sum() > out.base_score.sum() / out.n_tokens.sum() + 0.4


def test_iterations_over_all_texts_go_on_until_the_likelihood_settles(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "SAMPLE", 2, raising=False)
    monkeypatch.setattr(hmm_lm, "SAMPLE_DOCS", 2, raising=False)
    r = random.Random(5)
    languages = [[f"{p}{k}" for k in range(40)] for p in ("a", "b", "c", "d")]
    rows = [(i, " ".join(r.choice(languages[i % 4]) for _ in range(60))) for i in range(400)]
    model = hmm_lm.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [np.frombuffer(bytes(x.classes), dtype="<u2").astype(np.int64) for x in model.encoded.filter("training").collect()]
    tokens = sum(map(len, texts))
    before = model.hmm.log_likelihoods(texts).sum() / tokens
    model.hmm.update(*model.hmm.expected(texts))
    assert model.hmm.log_likelihoods(texts).sum() / tokens - before < 2e-3
    assert len(model.fits) > 2 and before >= model.fits[-1] - 1e-6


def test_the_sample_reaches_all_places_of_texts(spark):
    classes = np.arange(5000, dtype="<u2")
    rows = [(i, i, 5000, bytearray(classes.tobytes())) for i in range(20)]
    found, begins = hmm_lm._sequences(spark.createDataFrame(rows, "uid long, doc_id long, n_tokens long, classes binary"))
    assert len(found) == 20 * 20 and sorted({int(x[0]) for x in found}) == list(range(0, 5000, 256)) and max(int(x[-1]) for x in found) == 4999
    assert sum(begins) == 20 and all(b == (x[0] == 0) for x, b in zip(found, begins, strict=True))


def test_edges(edges):
    assert hmm_lm.score(hmm_lm.learn(edges)).count() == edges.count()
    assert hmm_lm.score(hmm_lm.learn(edges.limit(0))).count() == 0
