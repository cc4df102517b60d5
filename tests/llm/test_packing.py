import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm.packing import binary_pieces, pack, write_buckets

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 2047, 2048, 2049, 4095, 10_000])
def test_pieces_are_powers_of_two_that_add_up(n):
    pieces = binary_pieces(n)
    assert sum(pieces) == n and all(p & (p - 1) == 0 for p in pieces) and pieces == sorted(pieces, reverse=True) and max(pieces) <= 2048


def test_every_id_is_in_one_piece(edges, tmp_path):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    packed = pack(edges, PATH)
    rows = packed.collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.offset == 0 and r.length == len(r.ids) == r.bucket
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = defaultdict(list)
    for doc in edges.collect():
        want[doc.doc_id].append(tok.encode(doc.text or "", add_special_tokens=False).ids + [1])
    for doc_id, texts in want.items():
        # rows with the same id keep the order of the scan, in which sequences are numbered
        own, at = sorted(got[doc_id], key=lambda r: r.sequence_id), 0
        for ids in texts:
            cuts = [0, *np.cumsum(binary_pieces(len(ids))).tolist()]
            mine = own[at : at + len(cuts) - 1]
            assert [(r.start, r.ids, r.doc_tokens) for r in mine] == [(a, ids[a:b], len(ids)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            at += len(cuts) - 1
        assert at == len(own)
    write_buckets(packed, str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").glob("bucket=*")} == {f"bucket={r.bucket}" for r in rows}


def test_against_the_tokenizer_text_by_text(spark):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    texts = ["It's 'S don't <|endoftext|> A=b (c)", "ΟΔΟΣ Σ\x1cσ\x85 q", "H̱ ẖ ǅ ﬁ １２ ≠", "Hello,world!!it's:'re", "a" * 5000 + " b." * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(list)
    for r in pack(df, PATH).orderBy("doc_id", "start").collect():
        got[r.doc_id] += r.ids
    assert all(got[i] == tok.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts))


def test_empty_table_and_bad_length(edges):
    assert pack(edges.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        pack(edges, PATH, longest=1000)


def test_a_tokenizer_of_another_kind_gets_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    texts = ["Two  words\n and (marks)!", "", "It's UPPER"]
    got = defaultdict(list)
    for r in pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).orderBy("doc_id", "start").collect():
        got[r.doc_id] += r.ids
    assert all(got[i] == tok.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(texts))
