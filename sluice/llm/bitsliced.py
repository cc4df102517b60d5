"""Exact top-k search by inner product with a bit-sliced index.

Index. Components become whole numbers, floor(scale * x). Rows are dealt to blocks of about BLOCK rows, and each block keeps its
columns sliced: a column's numbers less their minimum, without the low bits beyond SLICES, bit by bit as bitmaps over the block's
rows, and their complements. What the slices leave out is known for each column: its minimum, and how much the low bits can add.

Search. A query's numbers are weights. In signed digits (no two neighbours differ from 0) a weight is a few powers of two, so a score
is a sum of slices, each at a place of its own; digits of -1 take the complement. Full adders on whole bitmaps add up all slices
until one bitmap is left at each place: the sliced sum of all rows of the block. From the most significant bitmap downward the k
highest are selected, which gives the k-th highest sum; the exact scores of the rows that reach it set a floor, and every row that the
bits left out could lift to that floor, the boundary, is found by one more pass over the bitmaps and gets its exact score.
So nothing depends on how well the slices approximate. Each block returns its best k rows for each query; the best of these remain.

Queries go to blocks in packs of about PACK_BYTES, as rows of a table sorted after the block's own row; neither side is broadcast. A
task holds one block, about BLOCK * (6 bytes for each component), and a batch of packs.

Defined results: rows whose vector is null, empty or holds a null or non-finite component take no part, nor do those with a component
whose number is LARGEST or more, where sums could leave 64 bits; a query's candidates are the vectors of its length. Rows that share an
id are rows of their own, as queries too; equal scores go by id, those without an id last; a row without an id is no query. Fewer
candidates than k are all returned. An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .session import settle, ship, work_dir

BLOCK, PACK_BYTES, SLICES = 8192, 4096, 6
LARGEST = 1 << 24

_ROW = "vec_id long, row_id long, dim int, numbers binary"


def _numbers(scale: float):
    """(vec_id, row_id, dim, numbers) of the rows that take part; numbers are 32 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            offsets = vectors.offsets.to_numpy()
            values = vectors.values.slice(offsets[0], offsets[-1] - offsets[0])
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
            with np.errstate(over="ignore", invalid="ignore"):
                n = np.floor(scale * x)
                bad = np.concatenate([[0], np.cumsum(~(np.abs(n) < LARGEST))])
            begin, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
            good = (bad[end] == bad[begin]) & (end > begin) & vectors.is_valid().to_numpy(zero_copy_only=False)
            numbers = np.where(np.isfinite(n) & (np.abs(n) < LARGEST), n, 0).astype("<i4")
            raw = pa.array([numbers[b:e].tobytes() if ok else None for b, e, ok in zip(begin, end, good, strict=True)], pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((end - begin).astype(np.int32)), raw], names=["vec_id", "row_id", "dim", "numbers"])
            yield out.filter(pa.array(good))

    return run


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """All rows of a partition by length; an index block at most is held."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if tables:
        table = pa.concat_tables(tables).combine_chunks()
        dims = table.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            yield d, table.filter(pa.array(dims == d)).combine_chunks()


def _matrix(table: pa.Table, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("numbers").to_pylist()), dtype="<i4").reshape(-1, d)


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids, with 0 for null, and which are null."""
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy().astype(bool)


def _slices(table: pa.Table, d: int) -> dict[str, bytes]:
    """One length's part of a block: its columns' minima, dropped bits, numbers of slices, and the slices one after the other."""
    numbers = _matrix(table, d).astype(np.int64)
    low = numbers.min(0)
    above = numbers - low
    bits = np.array([int(m).bit_length() for m in above.max(0)])
    drop = np.maximum(0, bits - SLICES)
    n = -(-len(numbers) // 64) * 64
    maps = []
    for c in range(d):
        for k in range(drop[c], bits[c]):
            one = np.zeros(n, dtype=np.uint8)
            one[: len(numbers)] = above[:, c] >> k & 1
            maps.append(np.packbits(one, bitorder="little"))
    slices = np.concatenate(maps) if maps else np.zeros(0, dtype=np.uint8)
    return {"low": low.tobytes(), "drop": drop.tobytes(), "kept": (bits - drop).tobytes(), "slices": slices.tobytes()}


_INDEX = "block int, dim int, vec_ids binary, missing binary, row_ids binary, numbers binary, low binary, drop binary, kept binary, slices binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each partition is one block; a row for each length of its vectors."""
    block = TaskContext.get().partitionId()
    for d, table in _held(batches):
        ids, missing = _ids(table.column("vec_id"))
        row = {"block": block, "dim": d, "vec_ids": ids.tobytes(), "missing": missing.tobytes(), "row_ids": table.column("row_id").to_numpy().tobytes(), "numbers": _matrix(table, d).tobytes()} | _slices(table, d)
        yield pa.RecordBatch.from_pylist([row], schema=_schema(_INDEX))


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in text.split(", "))])


def digits(weight: int) -> list[tuple[int, int]]:
    """(place, sign) of a whole number's signed digits that aren't 0, no two of them neighbours."""
    found, place = [], 0
    while weight:
        if weight & 1:
            sign = 2 - (weight & 3)
            found.append((place, sign))
            weight -= sign
        weight >>= 1
        place += 1
    return found


class Block:
    """The vectors of one length in a block, with their slices."""

    def __init__(self, row: dict) -> None:
        self.dim = row["dim"]
        self.vec_ids = np.frombuffer(row["vec_ids"], dtype=np.int64)
        self.missing = np.frombuffer(row["missing"], dtype=bool)
        self.row_ids = np.frombuffer(row["row_ids"], dtype=np.int64)
        self.numbers = np.frombuffer(row["numbers"], dtype="<i4").reshape(-1, self.dim)
        self.low, self.drop, kept = (np.frombuffer(row[c], dtype=np.int64) for c in ("low", "drop", "kept"))
        n = len(self.row_ids)
        words = -(-n // 64)
        maps = np.frombuffer(row["slices"], dtype=np.uint64).reshape(-1, words)
        ends = np.cumsum(kept)
        self.slices = [list(maps[e - k : e]) for e, k in zip(ends, kept, strict=True)]
        self.inverse = [[~m for m in column] for column in self.slices]
        valid = np.zeros(words * 64, dtype=np.uint8)
        valid[:n] = 1
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)
        self.none = np.zeros(words, dtype=np.uint64)
        self.order = np.lexsort([self.vec_ids, self.missing])
        self.place = np.empty(n, dtype=np.int64)
        self.place[self.order] = np.arange(n)

    def sums(self, weights: list[int]) -> tuple[list[np.ndarray], int, int]:
        """(bitmaps of each row's sliced sum from the lowest place up, what to add for the least score, how far that may fall short)."""
        columns: list[list[np.ndarray]] = [[]]
        base = short = 0
        for c, weight in enumerate(weights):
            if not weight:
                continue
            drop, slices, inverse = int(self.drop[c]), self.slices[c], self.inverse[c]
            base += weight * int(self.low[c])
            left_out = weight * ((1 << drop) - 1)
            base, short = base + min(0, left_out), short + abs(left_out)
            for place, sign in digits(weight):
                if sign < 0:
                    base -= ((1 << len(slices)) - 1) << place + drop
                at = place + drop
                while len(columns) < at + len(slices):
                    columns.append([])
                for k, bitmap in enumerate(slices if sign > 0 else inverse):
                    columns[at + k].append(bitmap)
        out, at = [], 0
        while at < len(columns):
            column = columns[at]
            if len(column) > 1 and at + 1 == len(columns):
                columns.append([])
            while len(column) > 2:
                a, b, c = column.pop(), column.pop(), column.pop()
                half = a ^ b
                carry = half & c
                carry |= a & b
                half ^= c
                column.append(half)
                columns[at + 1].append(carry)
            if len(column) == 2:
                a, b = column
                columns[at + 1].append(a & b)
                column = [a ^ b]
            out.append(column[0] if column else self.none)
            at += 1
        return out, base, short

    def rows_from(self, sums: list[np.ndarray], least: int, among: np.ndarray) -> np.ndarray:
        """Places of the rows of ``among`` whose sum is ``least`` or more."""
        if least <= 0:
            reached = among
        elif least >> len(sums):
            reached = self.none
        else:
            equal, above = among, self.none
            for k in range(len(sums) - 1, -1, -1):
                if least >> k & 1:
                    equal = equal & sums[k]
                else:
                    above = above | (equal & sums[k])
                    equal = equal & ~sums[k]
            reached = above | equal
        return np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))

    def highest(self, sums: list[np.ndarray], k: int, among: np.ndarray) -> int:
        """The k-th highest sum, from the most significant bitmap down."""
        sure, equal, value = 0, among, 0
        for at in range(len(sums) - 1, -1, -1):
            ones = equal & sums[at]
            n = int(np.bitwise_count(ones).sum())
            if sure + n >= k:
                equal, value = ones, value | 1 << at
            else:
                sure, equal = sure + n, equal & ~sums[at]
        return value

    def best(self, row_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the k best rows but the query's own, best first."""
        among = self.valid
        own = np.flatnonzero(self.row_ids == row_id)
        if len(own):
            among = among.copy()
            among[own // 64] &= ~np.uint64(1 << int(own[0]) % 64)
        n = len(self.row_ids) - len(own)
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        weights = query.astype(np.int64)
        sums, base, short = self.sums(weights.tolist())
        kth = self.highest(sums, min(k, n), among)
        sure = self.rows_from(sums, kth, among)
        scores = self.numbers[sure].astype(np.int64) @ weights
        floor = int(np.partition(scores, len(scores) - min(k, n))[len(scores) - min(k, n)])
        least = floor - short - base  # a sum below it can't reach the floor, whatever was left out
        rows = sure if least >= kth else self.rows_from(sums, least, among)
        scores = scores if least >= kth else self.numbers[rows].astype(np.int64) @ weights
        top = np.lexsort([self.place[rows], -scores])[:k]
        return rows[top], scores[top]


_FOUND = "query_row long, query_id long, score long, vec_id long"


def _search(k: int):
    """The k best rows of each block for each query of the packs that follow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, parts = row["block"], {}
                if row["kind"] == 0:
                    parts[row["dim"]] = Block(row)
                elif (part := parts.get(row["dim"])) is not None:
                    yield _answers(part, row, k)

    return run


def _answers(part: Block, pack: dict, k: int) -> pa.RecordBatch:
    ids, rows = (np.frombuffer(pack[c], dtype=np.int64) for c in ("vec_ids", "row_ids"))
    queries = np.frombuffer(pack["numbers"], dtype="<i4").reshape(-1, part.dim)
    found = [part.best(int(row), query, k) for row, query in zip(rows, queries, strict=True)]
    sizes = [len(places) for places, _ in found]
    places, scores = (np.concatenate([f[c] for f in found]) for c in (0, 1))
    columns = [pa.array(np.repeat(rows, sizes)), pa.array(np.repeat(ids, sizes)), pa.array(scores), pa.array(part.vec_ids[places], mask=part.missing[places])]
    return pa.RecordBatch.from_arrays(columns, names=["query_row", "query_id", "score", "vec_id"])


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, vec_ids, row_ids, numbers) of a few queries."""
    for batch in batches:
        for d, table in _held(iter([batch])):
            size = max(1, PACK_BYTES // (4 * d))
            for at in range(0, table.num_rows, size):
                part = table.slice(at, size)
                row = {"dim": d, "vec_ids": part.column("vec_id").to_numpy().tobytes(), "row_ids": part.column("row_id").to_numpy().tobytes(), "numbers": _matrix(part, d).tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=_schema("dim int, vec_ids binary, row_ids binary, numbers binary"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` (vec_id, embedding) nearest to each row that ``is_query`` marks.

    ``is_query`` may use vec_id alone.
    """
    spark = vectors.sparkSession
    ship(spark)
    path = work_dir(spark, "top-k")
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = settle(raw.mapInArrow(_numbers(scale), _ROW), f"{path}/rows")
    n_blocks = max(1, math.ceil(rows.count() / BLOCK))
    index = settle(rows.repartition(n_blocks).mapInArrow(_blocks, _INDEX), f"{path}/index")

    queries = rows.filter(is_query & F.col("vec_id").isNotNull())
    packs = settle(queries.mapInArrow(_packs, "dim int, vec_ids binary, row_ids binary, numbers binary"), f"{path}/queries")
    everywhere = packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("kind", F.lit(1))
    together = index.withColumn("kind", F.lit(0)).unionByName(everywhere, allowMissingColumns=True)
    found = together.repartition(n_blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(_search(k), _FOUND)

    found = settle(found, f"{path}/found")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def oracle_sql() -> str:
    """All pairs of queries and rows, for small tables."""
    return f"""
    WITH v AS (
      SELECT vec_id, row_number() OVER () AS row_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    w AS (SELECT * FROM v WHERE list_max(list_transform(e, lambda x: abs(x))) < {LARGEST}),
    p AS (
      SELECT q.vec_id AS query_id, q.row_id, w.vec_id, list_inner_product(q.e, w.e)::BIGINT AS score
      FROM w q JOIN w ON w.row_id <> q.row_id AND len(w.e) = len(q.e) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM p)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
