import corpus_pipeline
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        docs.count()
        out.append((name, docs))
    return dict(out)


def test_stages_keep_the_columns_of_documents(stages):
    want = stages["documents"].dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_dup", "secrets", "packing"]
    assert all(stages[n].dtypes == want for n in ("quality", "lines", "near_dup", "secrets"))


def test_decisions_take_effect(spark, stages):
    from sluice.llm import line_dedup, near_dup, secrets

    n = {k: v.count() for k, v in stages.items()}
    assert n["documents"] > n["quality"] == n["lines"] > n["near_dup"] == n["secrets"]
    assert line_dedup.deduplicate(stages["lines"]).agg({"n_dropped": "sum"}).first()[0] == 0
    assert near_dup.near_duplicates(stages["near_dup"]).filter("not kept").count() == 0
    assert all(secrets.base_spans(r.text) == [] for r in stages["secrets"].collect())
    assert all(r.n_chars == len(r.text) for r in stages["secrets"].collect())
    assert {r.doc_id for r in stages["packing"].select("doc_id").distinct().collect()} == {r.doc_id for r in stages["secrets"].collect()}


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*key).collect())) == sorted(map(tuple, stages["packing"].select(*key).collect()))


def test_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(x.startswith(f"op{k}_") for x in names) for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= names


CLASHES = ["score", "n_lines", "n_dropped", "text_hash", "dropped", "_id", "_hash", "id", "hot", "salt", "sid", "length", "sequence_id"]


@pytest.fixture(scope="module")
def odd(spark, edges, tmp_path_factory):
    """Rows of all awkward kinds with columns that operators use as names themselves, and a folder with labels."""
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None), (11, None, 0), (4, 1, 1), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    texts = edges.select("doc_id", "text").union(edges.select("doc_id", "text").limit(6))
    return texts.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars", *(f"'{c}' AS {c}" for c in CLASHES)).cache(), path


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES[:-1])
def test_every_stage_takes_awkward_rows(spark, odd, name, stage):
    docs, path = odd
    out = stage(spark, docs, path)
    rows = out.collect()
    assert out.columns == docs.columns and all(r[c] == c for r in rows for c in CLASHES)
    before, after = docs.collect(), sorted(((r.doc_id, r.text or "") for r in rows), key=str)
    if name in ("lines", "secrets"):
        assert after == sorted(((r.doc_id, r.text or "") for r in before), key=str)  # nothing repeats in three documents, nothing is secret
    elif name == "near_dup":
        assert sum(not t.split() for _, t in after) == sum(not (r.text or "").split() for r in before)
        words = [t.lower().split() for _, t in after if t.split()]
        assert len(words) == len({" ".join(w) for w in words})
    else:
        assert len({r.text for r in rows}) <= len({r.text for r in before})
    empty = stage(spark, docs.limit(0), path)
    assert empty.columns == docs.columns and empty.count() == 0


def test_packing_takes_awkward_rows(spark, odd):
    docs, path = odd
    pieces = corpus_pipeline.pack_sequences(spark, docs, path)
    ends = pieces.filter("start + length = doc_tokens")
    assert ends.count() == docs.count() and corpus_pipeline.pack_sequences(spark, docs.limit(0), path).count() == 0
    assert pieces.filter("doc_tokens = 1").count() >= docs.filter("coalesce(text, '') = ''").count()
