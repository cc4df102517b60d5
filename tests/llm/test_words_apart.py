"""Words built to collide under sums of powers stay apart in every operator that looks words up."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluice.llm import byte_bpe, hmm_lm, near_dup, packing
from sluice.llm.shingles import shingle_sets
from sluice.llm.textops import distinct_spans, span_hashes


def pair(a: str, b: str, length: int = 1024) -> tuple[str, str]:
    """Two complementary Thue-Morse words."""
    bits = [bin(i).count("1") & 1 for i in range(length)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    return [pair("a", "b"), *(pair(*rng.sample(letters, 2), rng.choice([512, 1024, 2048])) for _ in range(100))]


@pytest.fixture(scope="module")
def docs(spark, pairs):
    rows = [(2 * i + k, x[k]) for i, x in enumerate(pairs) for k in (0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_spans(pairs):
    raw = "".join(x + y for x, y in pairs).encode()
    edges = np.concatenate([[0], np.cumsum([len(z) for x in pairs for z in x])])
    data = np.frombuffer(raw, dtype=np.uint8)
    spans, number = distinct_spans(data, edges[:-1], edges[1:])
    assert [spans[k].decode() for k in number] == [z for x in pairs for z in x]
    assert len(set(span_hashes(data, edges[:-1], edges[1:]).tolist())) == len(spans) == len({z for x in pairs for z in x})


def test_packing(docs):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {}
    for r in packing.pack(docs[0], P.path("word_bpe_49k.json")).orderBy("doc_id", "start").collect():
        got.setdefault(r.doc_id, []).extend(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    assert all(got[i] == tok.encode(t, add_special_tokens=False).ids + [1] for i, t in docs[1].items())


def test_byte_bpe(docs):
    rows = byte_bpe.encode_decode(docs[0], P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert all(bytes(r.decoded).decode() == docs[1][r.doc_id] for r in rows)


def test_near_duplicates(docs):
    seen = {}
    for r in near_dup.near_duplicates(docs[0]).collect():
        assert r.component_id == min(i for i, t in docs[1].items() if t == docs[1][r.doc_id])
        seen[r.doc_id] = r.n_shingles
    assert set(seen.values()) == {1}


def test_shingles_in_any_order():
    words = ["aa", "bb", "cc", "dd", "ee"]
    texts = [" ".join(random.Random(k).sample(words, 5)) for k in range(60)]
    sets = [bytes(x.tobytes()) for found in shingle_sets(pa.array(texts)) for x in found]
    assert len(set(sets)) == len(set(texts))


def test_known_words(spark):
    a, b = pair("a", "b")
    training = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    held = next(i for i in range(100) if not zlib.crc32(str(i).encode()) % 10)
    rows = {r.doc_id: r for r in hmm_lm.score(hmm_lm.learn(spark.createDataFrame([(training, a), (held, b)], "doc_id long, text string"))).collect()}
    assert rows[held].n_known == 1 and rows[held].held_out and rows[training].n_known == 2
