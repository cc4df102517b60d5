import base64
import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from sluice.llm.byte_bpe import PATTERN, Codec, encode_batch, encode_decode

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("ab'srevllt \n\t.1é 　\x85中😀ñ")), max_size=200), max_size=5), leaf=st.sampled_from([1, 3, 7, 40]))
def test_any_halving_gives_the_same_ids(codec, plain, texts, leaf):
    got = [*encode_batch(pa.array(texts, pa.string()), codec, leaf)]
    assert got == [plain.encode_ordinary(t) for t in texts]
    assert all(codec.decode(x) == t.encode() for x, t in zip(encode_batch(pa.array(texts, pa.string()), codec, leaf), texts, strict=True))


def test_join_is_associative_with_a_neutral_element(codec, plain):
    raw = "ab cd'll  e\n f中文 ghi j".encode()
    sure = bytes(len(raw) + 1)  # no boundary known: windows grow to both parts
    ids = lambda a, b: plain.encode_ordinary(raw[a:b].decode())
    x, y, n = 4, 11, len(raw)
    left = codec.join(raw, sure, 0, codec.join(raw, sure, 0, ids(0, x), x, ids(x, y), y), y, ids(y, n), n)
    right = codec.join(raw, sure, 0, ids(0, x), x, codec.join(raw, sure, x, ids(x, y), y, ids(y, n), n), n)
    assert left == right == ids(0, n)
    assert codec.join(raw, sure, 0, [], 0, ids(0, n), n) == codec.join(raw, sure, 0, ids(0, n), n, [], n) == ids(0, n)


def test_tokens_outside_the_window_are_kept(codec, plain):
    raw = b"one two thr" + b"ee four five"
    sure = bytearray(len(raw) + 1)
    for k in range(1, len(raw)):
        sure[k] = raw[k] == 32
    seen = []
    window, codec.window = codec.window, lambda x: seen.append(x) or window(x)
    try:
        got = codec.join(raw, bytes(sure), 0, plain.encode_ordinary("one two thr"), 11, plain.encode_ordinary("ee four five"), len(raw))
    finally:
        del codec.window
    assert got == plain.encode_ordinary(raw.decode()) and seen == [b" three"]


@pytest.mark.parametrize("leaf", [1, 2, 5, 1000])
def test_decoding_is_the_same_for_every_leaf(codec, plain, leaf):
    text = "é中 words, and more 😀 " * 40
    assert codec.decode(plain.encode_ordinary(text), leaf) == text.encode() and codec.decode([], leaf) == b""


def test_another_pattern_has_no_sure_boundaries():
    pattern = r"[^\s]+\s*|\s+"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    text = "words  with\n ends that \t belong to them " * 9
    assert pattern != PATTERN == P.PATTERN
    assert [*encode_batch(pa.array([text]), Codec(PATH, pattern), 16)] == [other.encode_ordinary(text)]


def test_rows(edges, plain):
    long = "".join(random.Random(1).choice("abc dé\n ") for _ in range(100_000))
    df = edges.select("doc_id", "text").unionByName(edges.sparkSession.createDataFrame([(99, long)], "doc_id long, text string"))
    got = encode_decode(df, PATH, P.PATTERN, leaf=64).collect()
    texts = [r.text or "" for r in df.collect()]
    assert len(got) == len(texts)
    for r, t in zip(got, texts, strict=True):
        ids = plain.encode_ordinary(t)
        assert (r.n_tokens, r.ids, bytes(r.decoded)) == (len(ids), ids, t.encode())
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert encode_decode(df.limit(0), PATH, P.PATTERN).count() == 0
