import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import byte_cnn
from sluice.llm.byte_cnn import CHUNK, ByteCnn, chunk_starts


@pytest.mark.parametrize("n", [0, 1, 64, 65, 512, 513, 1000, 10_000])
def test_chunks_cover_everything_and_overlap(n):
    starts = chunk_starts(n)
    covered = np.zeros(n, dtype=int)
    for s in starts:
        covered[s : s + CHUNK] += 1
    assert len(starts) >= 1 and (covered >= 1).all() and (len(starts) == 1 or covered.max() > 1)


def test_gradients():
    model = ByteCnn(1)
    for k, p in enumerate(model.parameters()):
        p[...] = p.astype(np.float32)
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, (6, CHUNK)).astype(np.uint8)
    sizes, labels = np.array([512, 100, 8, 3, 300, 512]), np.array([1, 0, 1, 0, 1, 0], dtype=np.float32)
    for k, n in enumerate(sizes):
        data[k, n:] = 0
    model.__dict__.update({n: v.astype(np.float64) for n, v in model.__dict__.items() if isinstance(v, np.ndarray)})

    def loss():
        values = []
        for k, n in enumerate(sizes):
            text = np.zeros(max(byte_cnn.TAPS, n), dtype=np.uint8)
            text[:n] = data[k, :n]
            z = model.head(model.responses(text)[: max(1, (n - 8) // 2 + 1)].max(axis=0)[None], np.array([n]))[2][0]
            values.append(np.log1p(np.exp(-z)) if labels[k] else np.log1p(np.exp(z)))
        return np.mean(values)

    grads = model.step(data, sizes, labels)
    for p, g in zip(model.parameters(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = loss()
        p[at] = old - 1e-5
        down = loss()
        p[at] = old
        assert (up - down) / 2e-5 == pytest.approx(g[at], rel=2e-2, abs=1e-5)


def test_scores_do_not_depend_on_neighbours():
    model = ByteCnn(3)
    texts = ["", "short", "A sentence, as usual. " * 100, None, "é" * 999, "x" * 513]
    together = np.concatenate(list(model.scores(pa.array(texts, pa.string()))))
    alone = [np.concatenate(list(model.scores(pa.array([t], pa.string()))))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6) and together[0] == together[3]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = byte_cnn.train(docs, labels)
    scored = byte_cnn.score(docs, model).join(labels, "doc_id").toPandas()
    held = scored[[zlib.crc32(str(d).encode()) % 5 == 0 for d in scored.doc_id]]
    right = ((held.score >= 0.3) == (held.quality == 1)).mean()
    assert len(held) > 50 and right >= 0.9 and scored.score.between(0, 1).all()


def test_edges(spark, edges):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r.score, 6) for r in byte_cnn.score(edges.drop("score"), byte_cnn.train(edges, none)).collect()} == {0.5}
    one = spark.createDataFrame([(d, 1, 0) for d in range(40)] + [(1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.score > 0.9 for r in byte_cnn.score(edges.drop("score"), byte_cnn.train(edges, one)).collect()} == {True}
    mixed = one.withColumn("quality", F.when(F.col("doc_id") % 2 == 0, 0).otherwise(F.col("quality"))).unionByName(spark.createDataFrame([(4, 1, 0)], one.schema))
    model = byte_cnn.train(edges, mixed)
    out = byte_cnn.score(edges, model, "quality_score")
    assert out.count() == edges.count() and out.columns == [*edges.columns, "quality_score"] and {r.score for r in out.collect()} == {1.0}
    assert byte_cnn.score(edges.limit(0), model, "quality_score").count() == 0
    with pytest.raises(ValueError):
        byte_cnn.score(edges, model)


def test_scores_against_plain_loops():
    model = ByteCnn(5)
    model.offset = 0.3
    rng = np.random.default_rng(5)
    texts = ["", "a", "seven b", "eight by", "Some prose, as it is. " * 60, "".join(map(chr, rng.integers(32, 400, 700)))]

    def plain(text):
        raw, logits = text.encode(), []
        for start in range(0, max(1, len(raw) - 64), 448):
            chunk = raw[start : start + 512]
            padded = chunk + bytes(max(0, 8 - len(chunk)))
            best = [0.0] * 16
            for p in range(0, len(padded) - 7, 2):
                for f in range(16):
                    total = float(model.bias[f])
                    for t in range(8):
                        for d in range(4):
                            total += float(model.embedding[padded[p + t], d]) * float(model.filters[4 * t + d, f])
                    best[f] = max(best[f], total)
            inputs = [*best, math.log2(max(1, len(chunk))) / 9]
            hidden = [math.tanh(sum(x * float(model.hidden[i, h]) for i, x in enumerate(inputs)) + float(model.hidden_bias[h])) for h in range(8)]
            logits.append(sum(x * float(model.out[h]) for h, x in enumerate(hidden)) + float(model.out_bias[0]))
        return 1 / (1 + math.exp(-(sum(logits) / len(logits) + 0.3)))

    got = np.concatenate(list(model.scores(pa.array(texts))))
    assert got.tolist() == pytest.approx([plain(t) for t in texts], abs=1e-4)


def test_draws_come_from_the_whole_text(spark, monkeypatch):
    monkeypatch.setattr(byte_cnn, "STEPS", 1)
    seen = {}
    monkeypatch.setattr(ByteCnn, "fit", lambda self, data, sizes, labels, weights: seen.update(data=data, weights=weights))
    long = "".join(f"{k:07d} " for k in range(6400))  # 51,200 bytes, 115 chunks
    docs = spark.createDataFrame([(1, long), (1, long), (2, "short"), (3, None)], "doc_id long, text string")
    byte_cnn.train(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int"), folds=10**9)
    firsts = {bytes(x[:8]) for x in seen["data"]}
    assert len(seen["data"]) == len(chunk_starts(len(long))) + 2 == len(firsts) + 0 and seen["weights"].sum() == pytest.approx(1)


@pytest.mark.parametrize("block", [CHUNK, 1000, 4096])
def test_long_texts_are_scored_whole_in_parts(monkeypatch, block):
    """Parts of a long text are the text's own chunks: any block gives the score of one block for all of it."""
    rng = np.random.default_rng(9)
    texts = ["".join(map(chr, rng.integers(32, 1000, n))) for n in (3000, 5, 20_000, 448, 513, 12_345)]
    model = ByteCnn(3)
    whole = np.concatenate([*model.scores(pa.array(texts))])
    monkeypatch.setattr(byte_cnn, "BLOCK", block)
    assert np.concatenate([*model.scores(pa.array(texts))]) == pytest.approx(whole, rel=1e-6)
    changed = texts[2][:-1] + "~" * 9  # the end counts too
    assert np.concatenate([*model.scores(pa.array([changed]))])[0] != pytest.approx(whole[2], rel=1e-9)


def test_memory_does_not_grow_with_a_text():
    model, rng = ByteCnn(3), np.random.default_rng(1)
    peaks = []
    for mb in (2, 24):
        column = pa.array([rng.integers(97, 122, mb << 20).astype(np.uint8).tobytes().decode()])
        tracemalloc.start()
        assert len(np.concatenate([*model.scores(column)])) == 1
        peaks.append(tracemalloc.get_traced_memory()[1] / 2**20)
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 30 and peaks[1] < 150  # MB; starts of chunks are all that grows
