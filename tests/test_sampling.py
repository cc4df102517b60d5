import pytest
from pyspark.sql import functions as F

from sluice.operators.sampling import chunk_bounds, holdout_size, holdout_split, leakage, split_into_chunks, stratified_quotas


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(i, 1 + (i * i) % 9, float(i)) for i in range(600)], "row_id long, size int, mu double")


def rows(df):
    return [r.row_id for r in df.orderBy("row_id").collect()]


def test_ramp_is_monotone_disjoint_and_repeatable(raw):
    out = split_into_chunks(raw, "size", 300, 6, 0.15)
    got = out.orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(got))) and [r["size"] for r in got] == sorted(r["size"] for r in got)
    bounds = chunk_bounds(len(got), 6)
    for k in range(6):
        part = [r for r in got if r.chunk == k]
        assert len(part) == bounds[k + 1] - bounds[k] and sum(r.golden for r in part) == round(len(part) * 0.15)
    assert out.groupBy("chunk").agg(F.avg("size").alias("m")).orderBy("chunk").select("m").collect() == sorted(out.groupBy("chunk").agg(F.avg("size").alias("m")).select("m").collect())
    again = split_into_chunks(raw.repartition(5), "size", 300, 6, 0.15).orderBy("position").collect()
    assert [(r.row_id, r.chunk, r.golden) for r in got] == [(r.row_id, r.chunk, r.golden) for r in again]
    assert not leakage(out.filter("not golden"), out.filter("golden"), ["row_id"]).count()


def test_sequential_and_errors(raw):
    out = split_into_chunks(raw, "size", 150, 3, 0.0, mode="sequential")
    assert rows(out) == list(range(0, 600, 4)) and not out.filter("golden").count()
    with pytest.raises(ValueError):
        split_into_chunks(raw, "size", mode="random")
    with pytest.raises(ValueError):
        split_into_chunks(raw, "size", n_chunks=0)


def test_quotas_share_and_redistribute(spark):
    def quotas(available, n):
        return {r["size"]: r.quota for r in stratified_quotas(spark.createDataFrame(list(available.items()), "size long, n long"), n).collect()}

    assert quotas({0: 5, 1: 3, 2: 100, 3: 1000}, 300) == {1: 3, 2: 100, 3: 197}
    assert quotas({1: 2, 2: 2}, 100) == {1: 2, 2: 2}
    assert quotas({}, 10) == {}
    assert sum(quotas({1: 50, 2: 70, 3: 30}, 60).values()) == 60
    # halves go to the even number, as Python rounds
    assert quotas({1: 10, 2: 15, 3: 15}, 35) == {1: 10, 2: 11 + round(3 * 4 / 8), 3: 11 + round(3 * 4 / 8)}


def test_quotas_of_a_million_sizes(spark):
    counts = spark.range(1, 1_000_001).select(F.col("id").alias("size"), (F.col("id") % 4 + 1).alias("n"))
    found = stratified_quotas(counts, 2_000_000).agg(F.count("*").alias("k"), F.sum("quota").alias("s"), F.max(F.col("quota")).alias("m")).first()
    assert (found.k, found.m) == (1_000_000, 3) and found.s == 2_000_000


def test_pool_by_shuffled_quotas(spark, raw, monkeypatch):
    from sluice.operators import sampling

    a = rows(sampling.stratified_pool(raw, "size", 100, "s"))
    monkeypatch.setattr(sampling, "BROADCAST_SIZES", 0)
    assert rows(sampling.stratified_pool(raw, "size", 100, "s")) == a and a


def test_holdout(spark, raw):
    keep, held = holdout_split(raw, 0.2, "sha256:abc")
    assert len(rows(held)) == 120 and sorted(rows(keep) + rows(held)) == list(range(600))
    assert rows(holdout_split(raw.repartition(3), 0.2, "sha256:abc")[1]) == rows(held)
    assert rows(holdout_split(raw, 0.2, "sha256:abd")[1]) != rows(held)
    one = raw.limit(1)
    assert holdout_split(one, 0.5, "s")[1].count() == 0 and holdout_split(raw, 0.0, "s")[1].count() == 0
    assert [holdout_size(n, f) for n, f in ((2, 0.9), (10, 0.01), (10, 0.25), (0, 0.5))] == [1, 1, 2, 0]
    assert split_into_chunks(raw.limit(0), "size", 10, 2).count() == 0
