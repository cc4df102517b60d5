"""Near-duplicate vectors by randomised-rotation binary codes.

Codes. A unit vector x of D components is rotated at random and replaced by the signs of its coordinates,
c = sign(x) / sqrt(D), packed as bits; the correction factor f = <c, x> is stored beside it. For the rotated
coordinates q of another vector, <c, q> / f is an unbiased estimate of <x, q>: it equals
r + sqrt(1/f^2 - 1) * sqrt(1 - r^2) * <e, u>, where r is the true cosine and e, u are unit vectors in random
position to each other. Of q itself four bits of each coordinate are stored, rounded by a fixed dither, which is
unbiased too; so an estimate is four ANDs and bit counts of each word of the code. Deviations of DEVIATIONS standard
deviations of both errors, in few dimensions their greatest values, bound the estimate of any pair with r >= 0.95
from below. Only pairs above the bound are recomputed in double precision.

Candidates. More rotations give TABLES keys of some bits each; vectors with the same key in a table meet there. A
pair at cosine 0.95 agrees in a bit with p = 1 - acos(0.95) / pi = 0.899. Keys have log2(n) - SPARE bits, so groups of
unrelated vectors don't grow with n, and as many tables are made as leave a pair at 0.95 apart in all with a probability
of MISSED; nearer pairs are missed more rarely still. Groups receive codes, factors and rounded coordinates, no vectors.

Work. Equal vectors are merged and counted. In a group the members are first compared with one of them; rows near to it are
joined and need no comparison among each other, the rest is compared with all, in tiles of bounded size. A tile returns a spanning
set of the pairs whose estimates pass, and their components are families: whatever is linked lies in one family.
Families get their vectors. Members within half of the threshold's angle of the family's first member are all linked with
each other, by the triangle inequality; the rest is compared with all, in tiles, first by estimate, then exactly. A tile returns
sums of links and spanning edges, never its pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing, and
so do vectors of different length; repeated rows and ids are rows of their own; a null vec_id is never a
component's id unless all of its members' are null; an empty table gives no rows; other columns, labels
too and whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .joining import join_facts
from .merging import Merged
from .session import settle, ship, work_dir
from .tiles import grouped, limits_of, open_pairs

THRESHOLD = 0.95
DEVIATIONS = 5.8
MISSED, SPARE = 1e-6, 5
#: Rows on a side of a tile.
TILE = 4096
#: Bits of a rounded coordinate.
LEVELS = 4

_CODE = ["code", "planes", "factor", "low", "step"]
_CODE_TYPES = "code binary, planes binary, factor double, low double, step double"


def rotation(dimensions: int, seed: int = 95, columns: int | None = None) -> np.ndarray:
    """Random orthonormal columns, the same on every machine; a square matrix unless fewer are wanted."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimensions]).normal(size=(dimensions, columns or dimensions)))
    return q * np.sign(np.diag(r))


@cache
def _turn(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes' rotation and the dither of each coordinate."""
    return rotation(dimensions), np.random.default_rng([7, dimensions]).random(dimensions)


@cache
def _planes_of_keys(dimensions: int, bits: int) -> np.ndarray:
    blocks = [rotation(dimensions, 1000 + k, min(dimensions, bits - at)) for k, at in enumerate(range(0, bits, dimensions))]
    return np.concatenate(blocks, axis=1)


def key_sizes(n: int) -> tuple[int, int]:
    """(bits of a key, number of tables) for n vectors."""
    bits = min(62, max(1, round(math.log2(max(n, 2))) - SPARE))
    agree = (1 - math.acos(THRESHOLD) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    rows, d = bits.shape
    padded = np.zeros((rows, -(-d // 64) * 64), dtype=np.uint8)
    padded[:, :d] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Codes:
    """Codes, factors and rounded coordinates of vectors of one length."""

    def __init__(self, dimensions: int, code: np.ndarray, planes: np.ndarray, factor: np.ndarray, low: np.ndarray, step: np.ndarray) -> None:
        self.dimensions, self.code, self.planes, self.factor, self.low, self.step = dimensions, code, planes, factor, low, step

    @classmethod
    def of(cls, units: np.ndarray) -> Codes:
        d = units.shape[1]
        turn, dither = _turn(d)
        x = units @ turn
        low = x.min(1)
        step = (x.max(1) - low) / (2**LEVELS - 1)
        level = np.floor(np.divide(x - low[:, None], step[:, None], out=np.zeros_like(x), where=step[:, None] > 0) + dither).astype(np.int64)
        level = np.clip(level, 0, 2**LEVELS - 1)
        planes = np.stack([_packed(level >> k & 1) for k in range(LEVELS)], axis=1)
        return cls(d, _packed(x >= 0), planes, np.abs(x).sum(1) / math.sqrt(d), low, step)

    @classmethod
    def read(cls, table: pa.Table, dimensions: int) -> Codes:
        words = -(-dimensions // 64)
        code = np.frombuffer(b"".join(table.column("code").to_pylist()), dtype=np.uint64).reshape(-1, words)
        planes = np.frombuffer(b"".join(table.column("planes").to_pylist()), dtype=np.uint64).reshape(-1, LEVELS, words)
        return cls(dimensions, code, planes, *(table.column(c).to_numpy() for c in ("factor", "low", "step")))

    def columns(self) -> list[pa.Array]:
        raws = [pa.array([x.tobytes() for x in a], pa.binary()) for a in (self.code, self.planes)]
        return [*raws, pa.array(self.factor), pa.array(self.low), pa.array(self.step)]

    def _levels(self, planes: np.ndarray) -> np.ndarray:
        """Sums over the bits of rows of planes, weighted by their places."""
        counts = np.bitwise_count(planes).sum(-1, dtype=np.int64)
        return counts @ (1 << np.arange(LEVELS))

    def estimates(self, i: np.ndarray, other: Codes, j: np.ndarray) -> np.ndarray:
        """Of the cosines of pairs: our codes against the other's coordinates."""
        d = self.dimensions
        code, planes = self.code[i], other.planes[j]
        both = self._levels(code[:, None, :] & planes)
        ones = np.bitwise_count(code).sum(-1, dtype=np.int64)
        low, step = other.low[j], other.step[j]
        product = 2 * (low * ones + step * both) - (d * low + step * self._levels(planes))
        return product / (math.sqrt(d) * self.factor[i])

    def floors(self, i: np.ndarray, other: Codes, j: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
        """The least estimates that pairs at the threshold or above can have."""
        d, f = self.dimensions, np.minimum(self.factor[i], 1.0)
        spread = min(1.0, DEVIATIONS / math.sqrt(d - 2)) if d > 2 else 1.0
        by_code = np.sqrt(np.maximum(0.0, 1 / f**2 - 1) * (1 - threshold**2)) * spread
        by_rounding = other.step[j] * min(DEVIATIONS / 2, math.sqrt(d)) / f
        return threshold - by_code - by_rounding - 1e-9

    def may_be_near(self, i: np.ndarray, j: np.ndarray, other: Codes | None = None) -> np.ndarray:
        other = other or self
        return self.estimates(i, other, j) >= self.floors(i, other, j)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, sid, v): digest and doubles of each valid vector; null otherwise."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = batch.column(1)
        ends = vectors.offsets.to_numpy().astype(np.int64)
        values = vectors.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
        ends = ends - ends[0]
        sizes, full = np.diff(ends), np.diff(ends) > 0
        size = np.abs(values)
        top = np.zeros(len(sizes))
        top[full] = np.maximum.reduceat(size, ends[:-1][full]) if full.any() else 0
        good = vectors.is_valid().to_numpy(zero_copy_only=False) & np.isfinite(top) & (top > 0)
        raw = (values / np.repeat(np.where(good, top, 1.0), sizes)).tobytes()  # large components must not overflow
        whole = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((8 * ends).astype(np.int32).tobytes()), pa.py_buffer(raw)])
        view = memoryview(raw)
        digests = [hashlib.blake2b(view[8 * a : 8 * b], digest_size=16).digest() if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), good.tolist(), strict=True)]
        columns = [batch.column(0), pa.array(digests, pa.binary()), pc.if_else(pa.array(good), whole, pa.scalar(None, pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "sid", "v"])


def _units(raws: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(raws), dtype=np.float64).reshape(len(raws), -1)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _coded(bits: int, tables: int):
    """(cid, dim, code columns, keys) of (cid, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(1).to_pylist()
            sizes = np.array([len(r) // 8 for r in raws])
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                units = _units([raws[k] for k in at])
                signs = (units @ _planes_of_keys(d, bits * tables) >= 0).reshape(len(at), tables, bits)
                keys = signs @ (1 << np.arange(bits, dtype=np.int64))
                columns = [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), d, dtype=np.int32)), *Codes.of(units).columns()]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*columns, lists], names=["cid", "dim", *_CODE, "keys"])

    return run


def _by_length(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    dims = table.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        yield d, table.filter(pa.array(dims == d)).combine_chunks()


def _edges(merged: Merged, cids: np.ndarray) -> pa.RecordBatch:
    rows, roots = merged.spanning()
    return pa.RecordBatch.from_arrays([pa.array(cids[roots]), pa.array(cids[rows])], names=["a", "b"])


def _possible_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges (a, b) of the pairs of each tile whose estimates pass."""
    for whole in grouped(batches, "tile", 20_000):
        for d, table in _by_length(whole):
            cids, tiles, sides = (table.column(c).to_numpy() for c in ("cid", "tile", "side"))
            marked = table.column("marked").to_numpy(zero_copy_only=False).astype(bool)
            codes, merged = Codes.read(table, d), Merged(len(cids))
            # in a tile by itself the rows near its first one are joined at once
            limits = limits_of(tiles)
            first = np.repeat(limits[:-1], np.diff(limits))
            own = np.flatnonzero((sides == 2) & (first != np.arange(len(cids))))
            near = own[codes.may_be_near(first[own], own)]
            merged.add(first[near], near)
            marked[near] = True
            marked[limits[:-1][sides[limits[:-1]] == 2]] = True
            for i, j in open_pairs(tiles, sides, marked, cids):
                fresh = ~((sides[i] == 2) & (first[i] == j))
                i, j = i[fresh], j[fresh]
                good = codes.may_be_near(i, j)
                merged.add(i[good], j[good])
            yield _edges(merged, cids)


def _near_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, cid, head, near) of rows of large groups with the code of their head beside."""
    for batch in batches:
        for d, table in _by_length(pa.Table.from_batches([batch])):
            own = Codes.read(table, d)
            head = Codes.read(pa.table({c: table.column(f"head_{c}") for c in _CODE}), d)
            every = np.arange(table.num_rows)
            near = head.may_be_near(every, every, own)
            yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in ("group", "cid", "head_cid")), pa.array(near)], names=["group", "cid", "head", "near"])


def _core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, marked): whether members of families are within half of the threshold's angle of the head."""
    least = math.cos(math.acos(THRESHOLD) / 2) + 1e-12
    for batch in batches:
        for d, table in _by_length(pa.Table.from_batches([batch])):
            own, head = _units(table.column("v").to_pylist()), _units(table.column("head").to_pylist())
            marked = np.einsum("ij,ij->i", own, head) >= least
            yield pa.RecordBatch.from_arrays([table.column("cid").combine_chunks(), pa.array(marked)], names=["cid", "marked"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, links, root) of the rows that have a link in a tile of families; pairs of two marked rows are left out."""
    for whole in grouped(batches, "tile", 8_000):
        for d, table in _by_length(whole):
            cids, tiles, sides, weights = (table.column(c).to_numpy() for c in ("cid", "tile", "side", "n"))
            marked = table.column("marked").to_numpy(zero_copy_only=False).astype(bool)
            codes, units = Codes.read(table, d), _units(table.column("v").to_pylist())
            links, merged = np.zeros(len(cids), dtype=np.int64), Merged(len(cids))
            for i, j in open_pairs(tiles, sides, marked, cids):
                maybe = codes.may_be_near(i, j)
                i, j = i[maybe], j[maybe]
                for at in range(0, len(i), 1 << 16):
                    x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    good = np.einsum("ij,ij->i", units[x], units[y]) >= THRESHOLD
                    x, y = x[good], y[good]
                    links += np.bincount(x, weights=weights[y], minlength=len(cids)).astype(np.int64)
                    links += np.bincount(y, weights=weights[x], minlength=len(cids)).astype(np.int64)
                    merged.add(x, y)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(cids[hit]), pa.array(links[hit]), pa.array(cids[merged.up[hit]])], names=["cid", "links", "root"])


def _tiled(rows: DataFrame, group: str, tile: int) -> DataFrame:
    """Rows (group, cid, marked, ...) as tiles of unmarked rows against all rows: columns tile and side beside.

    A group of one tile comes once, as side 2. In larger groups unmarked rows (side 0) go to every part of all rows, and
    these (side 1) to every part of the unmarked ones.
    """
    parts, left = F.ceil(F.count("*") / tile).cast("int"), F.ceil(F.sum((~F.col("marked")).cast("long")) / tile).cast("int")
    sizes = rows.groupBy(group).agg(F.count("*").alias("rows_of_group"), parts.alias("parts"), left.alias("open"))
    sized = join_facts(rows, sizes, group, "rows_of_group").filter("open > 0")
    one = sized.filter("parts = 1").withColumns({"tile": F.col(group), "side": F.lit(2)})
    many = sized.filter("parts > 1")

    def placed(df: DataFrame, own: str, other: str, side: int) -> DataFrame:
        part, across = F.pmod(F.xxhash64("cid"), F.col(own)), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        df = df.withColumn("own", part.cast("int")).withColumn("other", across)
        pair = ("own", "other") if side == 0 else ("other", "own")
        return df.withColumns({"tile": F.xxhash64(group, *pair), "side": F.lit(side)}).drop("own", "other")

    unmarked, every = placed(many.filter("not marked"), "open", "parts", 0), placed(many, "parts", "open", 1)
    return one.unionByName(unmarked).unionByName(every).drop("parts", "open")


def _in_tiles(rows: DataFrame, run, schema: str, path: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(rows.repartition(n, "tile").sortWithinPartitions("tile", "side").mapInArrow(run, schema), path)


def _families(coded: DataFrame, path: str) -> DataFrame:
    """(cid, family): components of the pairs whose estimates pass, of vectors that have such a pair."""
    keyed = coded.select("cid", "dim", *_CODE, F.posexplode("keys").alias("t", "k"))
    keyed = keyed.select(F.xxhash64("dim", "t", "k").alias("group"), "cid", "dim", *_CODE)
    sizes = settle(keyed.groupBy("group").agg(F.count("*").alias("size"), F.min("cid").alias("head")).filter("size > 1"), f"{path}/groups")
    small = keyed.join(sizes.filter(F.col("size") <= TILE).select("group"), "group").withColumns({"tile": F.col("group"), "side": F.lit(2), "marked": F.lit(False)})
    columns = ["tile", "side", "marked", "cid", "dim", *_CODE]
    edges = _in_tiles(small.select(*columns), _possible_joins, "a long, b long", f"{path}/small")
    large = sizes.filter(F.col("size") > TILE)
    if not large.isEmpty():
        heads = large.select("group", F.col("head").alias("cid")).join(coded.select("cid", *_CODE), "cid")
        heads = heads.select("group", F.col("cid").alias("head_cid"), *(F.col(c).alias(f"head_{c}") for c in _CODE))
        members = keyed.join(large.select("group"), "group")
        near = settle(members.join(heads, "group").mapInArrow(_near_head, "group long, cid long, head long, near boolean"), f"{path}/near-heads")
        edges = edges.unionByName(near.filter("near and cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")))
        tiled = _tiled(near.select("group", "cid", F.col("near").alias("marked")), "group", TILE)
        edges = edges.unionByName(_in_tiles(tiled.join(coded.select("cid", "dim", *_CODE), "cid").select(*columns), _possible_joins, "a long, b long", f"{path}/large"))
    return connected_components(edges, f"{path}/families").select(F.col("v").alias("cid"), F.col("label").alias("family"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    ship(spark)
    path = work_dir(spark, "vector-dup")
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = settle(raw.mapInArrow(_rows, "vec_id long, sid binary, v binary"), f"{path}/rows")
    merged = rows.filter("sid is not null").groupBy("sid").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = settle(merged.withColumn("cid", F.monotonically_increasing_id()), f"{path}/classes")
    coded = classes.select("cid", "v").mapInArrow(_coded(*key_sizes(classes.count())), f"cid long, dim int, {_CODE_TYPES}, keys array<long>")
    coded = settle(coded, f"{path}/codes")

    family = _families(coded, path)
    members = settle(family.join(classes.select("cid", "n", "v"), "cid").join(coded.select("cid", "dim", *_CODE), "cid"), f"{path}/members")
    heads = members.groupBy("family").agg(F.min("cid").alias("cid"), F.count("*").alias("rows_of_family"))
    heads = settle(heads.join(classes.select("cid", F.col("v").alias("head")), "cid").drop("cid"), f"{path}/heads")
    with_head = join_facts(members.select("family", "cid", "dim", "v"), heads, "family", "rows_of_family")
    core = settle(with_head.mapInArrow(_core, "cid long, marked boolean"), f"{path}/core")
    members = members.join(core, "cid")
    tiled = _tiled(members.withColumnRenamed("family", "group"), "group", TILE)
    found = _in_tiles(tiled.select("tile", "side", "marked", "cid", "dim", "n", "v", *_CODE), _links, "cid long, links long, root long", f"{path}/links")

    # Marked rows are linked with each other and with the head, which is one of them.
    marked = members.filter("marked").select("family", "cid", "n")
    weights = marked.groupBy("family").agg(F.sum("n").alias("all"), F.min("cid").alias("root"))
    among = marked.join(weights, "family").filter(F.col("all") > F.col("n")).select("cid", (F.col("all") - F.col("n")).alias("links"), "root")
    found = settle(found.unionByName(among), f"{path}/found")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), f"{path}/components").withColumnRenamed("v", "cid")
    known = settle(
        classes.select("sid", "cid", "vec_id", "n").join(links, "cid", "left").join(labels, "cid", "left").select("sid", "vec_id", "n", F.coalesce("label", "cid").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        f"{path}/known",
    )
    least = known.groupBy("label").agg(F.min("vec_id").alias("component_id"))
    facts = settle(known.join(least, "label").select("sid", "n", "n_links", "component_id"), f"{path}/facts")
    out = join_facts(rows.select("vec_id", "sid"), facts, "sid", "n")
    own = F.when(F.col("sid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


def oracle_sql() -> str:
    """All pairs, for small tables."""
    return f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
    p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
    SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
    FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id"""
