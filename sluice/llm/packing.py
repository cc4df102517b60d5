"""Packing by power-of-two decomposition.

A document of n tokens (its ids and one end id) is cut into the powers of two that add up to n: as many
pieces of the longest length as fit, then one for each set bit of the rest, longest first. Each piece is
a sequence of its own in the bucket of its length, so no sequence crosses documents and none needs
padding. Batches are drawn from one bucket at a time.

Defined results: a null or empty text is the end id alone (one piece of length 1); every row is packed
by itself, so repeated rows and repeated or null ids give separate sequences; a text of any length is
tokenized whole; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .session import ship
from .textops import LOWER, SpanTokens, blocks, text_buffers, word_spans

END_ID = 1
LONGEST = 2048

_TOKENS: dict[str, SpanTokens] = {}
_BY_WORD: dict[str, bool] = {}


#: 1 for ASCII letters and digits, 2 for other visible ASCII characters but the apostrophe.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KIND[39] = 0


# The normalizers and the pattern under which spans can be encoded one by one.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_at_words(path: str) -> bool:
    """Whether the tokenizer's file says that it lower-cases, drops white space and joins nothing across it."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    steps = (said.get("normalizer") or {}).get("normalizers", [])
    first = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return [x.get("type") for x in steps] == _NORMALIZERS and first.get("pattern") == {"Regex": _SPLIT} and first.get("behavior") == "Removed" and bool(first.get("invert"))


def _tokenizer(path: str) -> SpanTokens:
    if path not in _TOKENS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True

        def encode_many(words: list[bytes]) -> list[list[int]]:
            found: list[list[int]] = []
            for i in range(0, len(words), 4096):
                found += [x.ids for x in tok.encode_batch_fast([w.decode() for w in words[i : i + 4096]], add_special_tokens=False)]
            return found

        _TOKENS[path] = SpanTokens(encode_many)
        _BY_WORD[path] = _cuts_at_words(path)
    return _TOKENS[path]


def binary_pieces(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n tokens, longest first; all are powers of two up to ``longest``."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _spans(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, rows) of spans that the tokenizer treats apart.

    Words are cut further between an ASCII letter or digit and an ASCII mark other than the apostrophe,
    where its pattern always cuts. Words of ASCII alone are lower-cased, as the tokenizer does itself.
    """
    starts, ends, rows = word_spans(part, bounds)
    high = np.concatenate([[0], np.cumsum(part >= 0x80)])
    odd = high[ends] > high[starts]
    edge = np.zeros(len(part) + 1, dtype=np.int8)
    edge[starts[odd]] += 1
    edge[ends[odd]] -= 1
    lowered = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, part, LOWER[part])
    kind = _KIND[part]
    inner = np.flatnonzero((kind[:-1] ^ kind[1:]) == 3) + 1
    inner = inner[~np.isin(inner, bounds)]
    return lowered, (s := np.sort(np.concatenate([starts, inner]))), np.sort(np.concatenate([ends, inner])), np.searchsorted(bounds, s, side="right") - 1


def document_ids(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text, then the end id. Words are encoded one by one where the tokenizer allows it, else whole texts."""
    tokens = _tokenizer(path)
    offsets, data = text_buffers(column)
    for i, j in blocks(offsets):
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if _BY_WORD[path]:
            lowered, starts, ends, rows = _spans(part, bounds)
        else:
            rows = np.flatnonzero(np.diff(bounds))
            lowered, starts, ends = part, bounds[rows], bounds[rows + 1]
        ids, lengths = tokens.ids(lowered, starts, ends)
        sizes = np.bincount(rows, weights=lengths, minlength=j - i).astype(np.int64)
        limits = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in zip(limits[:-1], limits[1:], strict=True):
            yield np.append(ids[a:b], np.uint32(END_ID))


def pack(docs: DataFrame, tokenizer_path: str, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, bucket (the length shared by all sequences of
    a batch), sequence_id (unique, one for each piece), offset (always 0), and ids if asked for. The ids
    of sequences depend on the scan's partitions alone, so a retried task gives the same ones.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int] = []
            starts: list[int] = []
            sizes: list[int] = []
            sums: list[int] = []
            totals: list[int] = []
            pieces: list[np.ndarray] = []
            for row, ids in enumerate(document_ids(batch.column(1), tokenizer_path)):
                raw, at = ids.astype("<u4").tobytes(), 0
                for size in binary_pieces(len(ids), longest):
                    keys.append(row)
                    starts.append(at)
                    sizes.append(size)
                    sums.append(zlib.crc32(raw[4 * at : 4 * (at + size)]))
                    totals.append(len(ids))
                    if with_ids:
                        pieces.append(ids[at : at + size])
                    at += size
            columns = [
                batch.column(0).take(pa.array(keys, pa.int64())),
                *(pa.array(x, pa.int64()) for x in (starts, sizes, sums, totals, sizes)),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket"]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in pieces], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket long" + ", ids array<int>" * with_ids
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Store sequences by length, so that a reader draws each batch from one folder."""
    sequences.write.mode("overwrite").partitionBy("bucket").parquet(path)
