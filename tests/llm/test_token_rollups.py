import base64
import re

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from sluice.llm import queries
from sluice.llm.session import work_dir
from sluice.llm.token_rollups import VERSIONS, TokenRollups, maintained_totals


def change(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, lang string, tokenizer_version string, n_docs long, n_tokens long")


def totals(store):
    return {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_signed_changes_and_idempotent_commits(spark):
    store = TokenRollups(spark, work_dir(spark, "rollups"))
    assert totals(store) == {}
    first = change(spark, ("a", "en", "v1", 1, 10), ("a", "en", "v1", 1, 5), (None, "en", "v1", 1, 7))
    assert store.commit("b1", first) and not store.commit("b1", first)
    assert store.commit("b2", change(spark, ("a", "en", "v1", 0, -3), (None, "en", "v1", -1, -7), ("a", "en", "v2", 2, 9)))
    want = {("a", "en", "v1"): (2, 12), ("a", "en", "v2"): (2, 9)}
    assert totals(store) == want
    store.compact()
    assert totals(store) == want and not store.commit("b1", first) and store.committed() == {"b1", "b2"}
    again = TokenRollups(spark, store.path)
    assert again.commit("b3", change(spark, ("a", "en", "v1", 1, 1)))
    again.compact()
    assert totals(again) == {("a", "en", "v1"): (3, 13), ("a", "en", "v2"): (2, 9)} and again.committed() == {"b1", "b2", "b3"}
    with pytest.raises(ValueError):
        store.commit("../x", first)


def test_a_batch_that_was_cut_off_leaves_no_trace(spark):
    store = TokenRollups(spark, work_dir(spark, "rollups"))
    store.commit("b1", change(spark, ("a", "en", "v1", 1, 10)))
    with pytest.raises(Exception, match="boom|BOOM|USER_RAISED"):
        store.commit("b2", change(spark, ("a", "en", "v1", 1, 10)).selectExpr("source", "lang", "tokenizer_version", "n_docs", "raise_error('boom')::long AS n_tokens"))
    assert totals(store) == {("a", "en", "v1"): (1, 10)} and store.commit("b2", change(spark, ("a", "en", "v1", 1, 1)))


def plain_counts(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    if not hasattr(plain_counts, "own"):
        plain_counts.own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain_counts.words = Tokenizer.from_file(P.path("word_bpe_49k.json"))
        plain_counts.words.encode_special_tokens = True
    return {
        "byte_bpe_multi_50k": len(plain_counts.own.encode_ordinary(text)),
        "bytes-1": len(text.encode()),
        "word_bpe_49k": len(plain_counts.words.encode(text, add_special_tokens=False).ids),
        "words-1": len(re.findall(r"[^\x20\x09-\x0D]+", text)),
    }


def brute(docs, labels):
    low = {d for d, q, t in labels if q == 0}
    toxic = {d for d, q, t in labels if t == 1} - low
    out = {}
    for d, text, source, lang in docs:
        if d is None or d not in low:
            text = text or ""
            for version, n in plain_counts(text.split("\n")[0] if d is not None and d in toxic else text).items():
                a, b = out.get((source, lang, version), (0, 0))
                out[source, lang, version] = (a + 1, b + n)
    return out


LABELS = [(1, 0, 0), (1, 1, 1), (2, 1, 1), (11, None, 1), (None, 0, 1), (4, None, None)]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_against_brute_force(spark, edges):
    docs = edges.selectExpr("doc_id", "text", "source", "if(doc_id % 2 = 0, 'en', null) AS lang", "tile", "score", "1 AS n_tokens", "2 AS n_docs")
    got = maintained_totals(docs, labelled(spark, LABELS)).collect()
    want = brute([(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()], LABELS)
    assert {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens) for r in got} == want and len(got) == len(want)


def test_query_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op8_token_rollups(spark, "/root/testdata/sf0.001").collect()
    want = brute([(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens) for r in got} == want


def test_empty_tables(spark, edges):
    docs = edges.selectExpr("*", "'x' AS lang")
    assert maintained_totals(docs.limit(0), labelled(spark, LABELS)).count() == 0 and maintained_totals(docs, labelled(spark, [])).count() == len(VERSIONS)
