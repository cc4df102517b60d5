"""Near-duplicate documents: a multi-index Hamming join of MinHash signatures, confirmed on full shingle sets.

Signatures. A document's set of five-word shingles gets SLOTS = 64 MinHash symbols of 16 bits, a signature
of 1,024 bits whose distance is the number of differing symbols. At similarity 0.75 the distance has mean
16 and standard deviation 3.5.

Join. The signature is cut into 16 chunks of 4 symbols. Two signatures that differ in at most 31 symbols
have, by the pigeonhole principle, a chunk with at most one error (16 chunks with two each would make 32).
Every chunk is entered under its four one-error patterns (three symbols with the fourth left out), so all
pairs up to distance 31 meet under some key. A pair at similarity 0.75 exceeds 31 with a probability near
1e-5, one at 0.8 with 1e-8.

Work without all pairs. Equal sets are merged first. Then
  1. each member of a key's group is compared with one group's smallest member, one pair for each document,
     and components are found;
  2. in groups that still hold several components, members of different ones within distance 31 are joined
     to families. A group's task returns a spanning set of these joins, never its pairs;
  3. each family is compared in full, in tiles of bounded size that hold the sets themselves. A tile returns
     a spanning set of its links. All pairs that may still be linked are in one family, so none is lost.
A group over REFINE rows is first divided without loss. Its members agree in three symbols of one chunk, so the
errors of a pair lie in the other symbols; these are cut into chunks of three, at least 16 of them, and by the same
principle a pair with at most 31 errors has one of these chunks with at most one error. Members are entered under
its one-error patterns, and so on, up to REFINE_DEPTH times. The division saves work and changes no result. Sets are
compared as sorted 64-bit shingle hashes; in a family only sets whose sizes allow the similarity meet in a tile.

Defined results: null or empty texts, or texts without words, have no set and link with nothing; texts with
one to four words have one shingle; texts of any length are read whole; repeated rows and repeated doc_ids are rows of
their own, linked by their texts; a null doc_id never is a component's id unless all its members' are null, and its row is
kept only then; an empty table gives no rows; other columns, whatever their names, are not read by ``near_duplicates`` and
pass through ``keep_one``, which keeps one row of each component, also of repeated rows, and every row without words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .merging import Merged
from .joining import join_facts
from .session import fresh_names, settle, ship, work_dir
from .shingles import Signer, shingle_sets
from .textops import mix64
from .tiles import grouped

SLOTS, WIDTH = 64, 4
CHUNKS = SLOTS // WIDTH
GUARANTEED = 2 * CHUNKS - 1
#: Rows of a tile; groups over REFINE rows are divided, REFINE_DEPTH times at most.
TILE, REFINE, REFINE_DEPTH = 1024, 4096, 2
FINER = 3
#: Ratio of the set sizes of a band.
SIZE_BAND = 1.34
#: Shingles on one side of a family's tile; with more candidate pairs than ONE_BY_ONE its sets are compared by matrix products.
TILE_SHINGLES, ONE_BY_ONE, COLUMNS = 1 << 20, 20_000, 4096

_SIGNER = Signer(SLOTS, 75)
_OTHERS = np.array([[x for x in range(WIDTH) if x != left_out] for left_out in range(WIDTH)])


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """The 64 keys of each signature: chunk, symbol left out, and the other three symbols."""
    chunks = signatures.reshape(len(signatures), CHUNKS, WIDTH).astype(np.int64)
    kept = chunks[:, :, _OTHERS]
    tags = np.arange(CHUNKS * WIDTH, dtype=np.int64).reshape(CHUNKS, WIDTH) << 48
    keys = tags | kept[..., 0] << 32 | kept[..., 1] << 16 | kept[..., 2]
    return keys.reshape(len(signatures), CHUNKS * WIDTH)


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long binaries of 16-bit symbols as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, sid, sig, text_hash): the set's digest and its signature; null without words."""
    for batch in batches:
        counts, digests, signatures = [], [], []
        for sets in shingle_sets(batch.column(1)):
            full = [x for x in sets if len(x)]
            signed = iter(_SIGNER.sign(full))
            for x in sets:
                counts.append(len(x))
                digests.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                signatures.append(next(signed).tobytes() if len(x) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary()), batch.column(2)],
            names=["doc_id", "n_shingles", "sid", "sig", "text_hash"],
        )


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, vid, used): each signature under its keys, with the places that the key holds."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys = chunk_keys(_matrix(part.column(1)))
            yield _key_rows(keys, np.arange(part.num_rows), part.column(0))


def finer_patterns(used: int) -> np.ndarray:
    """Pairs of places that are keys of a division, when the places of the bits of ``used`` are agreed on already.

    The other places are cut into chunks of FINER; each chunk is entered with one of its places left out.
    """
    free = [k for k in range(SLOTS) if not used >> k & 1]
    chunks = [free[k : k + FINER] for k in range(0, len(free) - FINER + 1, FINER)]
    if 2 * len(chunks) <= GUARANTEED:
        raise ValueError("too few places are left to divide without loss")
    return np.array([[x for x in chunk if x != left_out] for chunk in chunks for left_out in chunk])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, vid, used): members (key, vid, used, sig) of a group under the keys of its division; ``used`` are the places agreed on."""
    for batch in batches:
        used = batch.column(2).to_numpy()
        for u in np.unique(used).tolist():
            of_group = batch.filter(pa.array(used == u))
            places = finer_patterns(u & (1 << SLOTS) - 1)
            marks = np.array([1 << int(x) | 1 << int(y) for x, y in places], dtype=np.uint64)
            for at in range(0, of_group.num_rows, 2048):
                part = of_group.slice(at, 2048)
                symbols = _matrix(part.column(3)).astype(np.uint64)
                keys = symbols[:, places[:, 0]] << np.uint64(16) | symbols[:, places[:, 1]] | np.arange(len(places), dtype=np.uint64) << np.uint64(32)
                former = part.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
                keys = mix64(mix64(former)[:, None] ^ keys).astype(np.int64)
                now = np.broadcast_to(np.uint64(u & (1 << SLOTS) - 1) | marks, keys.shape).astype(np.int64)
                rows = np.repeat(np.arange(part.num_rows), len(places))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column(1).take(pa.array(rows)), pa.array(now.ravel())], names=["key", "vid", "used"])


#: By key of a signature: its three places, as bits.
_USED = np.array([sum(1 << (WIDTH * chunk + int(x)) for x in kept) for chunk in range(CHUNKS) for kept in _OTHERS], dtype=np.uint64).astype(np.int64)


def _key_rows(keys: np.ndarray, rows: np.ndarray, vids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), vids.take(pa.array(np.repeat(rows, CHUNKS * WIDTH))), pa.array(np.tile(_USED, len(rows)))], names=["key", "vid", "used"])


def _near(signatures: np.ndarray, sizes: np.ndarray, labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of different components that are near enough to be linked."""
    for part in np.array_split(left, max(1, len(left) * len(right) // 200_000)):
        far = np.zeros((len(part), len(right)), dtype=np.uint8)
        for k in range(SLOTS):
            far += signatures[part, k][:, None] != signatures[right, k][None, :]
        small = np.minimum(sizes[part][:, None], sizes[right][None, :])
        large = np.maximum(sizes[part][:, None], sizes[right][None, :])
        i, j = np.nonzero((far <= GUARANTEED) & (labels[part][:, None] != labels[right][None, :]) & (100 * small >= 75 * large))
        yield part[i], right[j]


def _tiles_of(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, left places, right places) of each tile of a table."""
    tiles, sides = table.column("tile").to_numpy(), table.column("side").to_numpy()
    limits = np.flatnonzero(np.concatenate([[True], tiles[1:] != tiles[:-1], [True]]))
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
        yield a, b, a + np.flatnonzero(sides[a:b] != 1), a + np.flatnonzero(sides[a:b] != 0)


def _spanning(merged: Merged, vids: np.ndarray) -> pa.RecordBatch:
    rows, roots = merged.spanning()
    return pa.RecordBatch.from_arrays([pa.array(vids[roots]), pa.array(vids[rows])], names=["a", "b"])


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning joins (a, b) of the near pairs of each tile."""
    for table in grouped(batches, "tile", 20_000):
        vids, labels, sizes = (table.column(n).to_numpy() for n in ("vid", "label", "n_shingles"))
        signatures = _matrix(table.column("sig").combine_chunks())
        merged = Merged(len(vids))
        for _, _, left, right in _tiles_of(table):
            for i, j in _near(signatures, sizes, labels, left, right):
                merged.add(i, j)
        yield _spanning(merged, vids)


def _similar(s: np.ndarray, t: np.ndarray) -> bool:
    small, large = (s, t) if len(s) <= len(t) else (t, s)
    both = int(np.count_nonzero(large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small))
    return 100 * both >= 75 * (len(s) + len(t) - both)


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, from products of blocks of their incidence matrix."""
    used = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([sets[k] for k in used])
    owner = np.repeat(used, [len(sets[k]) for k in used])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    row = np.zeros(len(sets), dtype=np.int64)
    row[used] = np.arange(len(used))
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        block = np.zeros((len(used), COLUMNS), dtype=np.float32)
        block[row[owner[a:b]], column[a:b] - at] = 1
        out += block[row[left]] @ block[row[right]].T
    return out


def _family_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links (a, b) of the near pairs of each tile whose full sets are similar enough."""
    for table in grouped(batches, "tile", 2_000):
        vids, labels, sizes = (table.column(n).to_numpy() for n in ("vid", "label", "n_shingles"))
        signatures = _matrix(table.column("sig").combine_chunks())
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("set").to_pylist()]
        merged = Merged(len(vids))
        for _, _, left, right in _tiles_of(table):
            near = list(_near(signatures, sizes, labels, left, right))
            i, j = (np.concatenate([x[k] for x in near]) for k in (0, 1))
            if len(i) <= ONE_BY_ONE:
                good = np.array([_similar(sets[a], sets[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
            else:
                place = np.zeros(len(vids), dtype=np.int64)
                place[right] = np.arange(len(right))
                at = np.zeros(len(vids), dtype=np.int64)
                at[left] = np.arange(len(left))
                both = _common(sets, left, right)[at[i], place[j]]
                good = 100 * both >= 75 * (sizes[i] + sizes[j] - both)
            merged.add(i[good], j[good])
        yield _spanning(merged, vids)


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vid, set) of the wanted texts; a row whose text has another set than the wanted one is left out."""
    for batch in batches:
        vids, wanted, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
        for sets in shingle_sets(batch.column(2)):
            found = []
            for x in sets:
                raw = x.tobytes()
                if hashlib.blake2b(raw, digest_size=16).digest() == wanted[at]:
                    found.append((vids[at], raw))
                at += 1
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in found], pa.int64()), pa.array([r for _, r in found], pa.binary())], names=["vid", "set"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in batches:
        keep = [_similar(*(np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in pair)) for pair in zip(batch.column(2), batch.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


class _Job:
    """The tables of one run."""

    def __init__(self, docs: DataFrame) -> None:
        self.spark = docs.sparkSession
        self.path = work_dir(self.spark, "near-dup")
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
        self.tables = 0

    def kept(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return settle(df, f"{self.path}/{self.tables}")

    def sets(self, vids: DataFrame, classes: DataFrame) -> DataFrame:
        """(vid, set) of the named classes, made from their texts once more."""
        wanted = vids.join(classes, "vid").select("vid", "sid", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
        texts = self.docs.join(wanted, self.docs.doc_id.eqNullSafe(wanted.id) & (self.docs.text_hash == wanted.hash)).select("vid", "sid", "text")
        return self.kept(texts.mapInArrow(_sets_of, "vid long, set binary").dropDuplicates(["vid"]))

    def verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that are linked."""
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("vid")).distinct(), classes)
        left = sets.select(F.col("vid").alias("a"), F.col("set").alias("set_a"))
        right = sets.select(F.col("vid").alias("b"), F.col("set").alias("set_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
        return self.kept(both.mapInArrow(_linked, "a long, b long"))

    def labels(self, links: DataFrame) -> DataFrame:
        self.tables += 1
        return connected_components(links, f"{self.path}/components-{self.tables}").withColumnRenamed("v", "vid")

    def open_groups(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of the groups that hold more than one component: (key, vid, used, label, n)."""
        labelled = members.join(labels, "vid", "left").select("key", "vid", "used", F.coalesce("label", "vid").alias("label"))
        several = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).filter("lo <> hi")
        return labelled.join(several.select("key", "n"), "key")

    def tiles(self, members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
        """Open groups in tiles of bounded size; side is 0, 1, or 2 for a tile that meets itself."""
        facts = classes.select("vid", "n_shingles", "sig")
        opened, done = self.kept(self.open_groups(members, labels)), []
        for _ in range(REFINE_DEPTH):
            large = opened.filter(F.col("n") > REFINE)
            if large.isEmpty():
                break
            done.append(opened.filter(F.col("n") <= REFINE))
            finer = large.select("key", "vid", "used").join(facts.select("vid", "sig"), "vid").select("key", "vid", "used", "sig")
            opened = self.kept(self.open_groups(finer.mapInArrow(_finer, "key long, vid long, used long"), labels))
        for part in done:
            opened = opened.unionByName(part)
        placed = _spread(opened, "key", F.ceil(F.col("n") / TILE).cast("int"))
        return placed.select("tile", "vid", "label", "side").join(facts, "vid").select("tile", "vid", "label", "side", "n_shingles", "sig")

    def in_tiles(self, rows: DataFrame, run) -> DataFrame:
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.kept(rows.repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long"))

    def family_links(self, members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
        """Spanning links between the components found so far."""
        joins = self.in_tiles(self.tiles(members, labels, classes), _families)
        families = self.labels(joins).withColumnRenamed("label", "family")
        known = self.kept(families.join(classes.select("vid", "n_shingles", "sig"), "vid").join(labels, "vid", "left").withColumn("label", F.coalesce("label", "vid")))
        sized = known.join(known.groupBy("family").agg(_n_tiles("n_tiles")), "family")
        placed = _spread(sized.filter("n_tiles = 1"), "family", F.lit(1)).unionByName(_by_size(sized.filter("n_tiles > 1").drop("n_tiles")), allowMissingColumns=True)
        sets = self.sets(known.select("vid"), classes)
        return self.in_tiles(placed.select("tile", "vid", "label", "side", "n_shingles", "sig").join(sets, "vid").select("tile", "vid", "label", "side", "n_shingles", "sig", "set"), _family_links)


def _n_tiles(name: str) -> Column:
    """Of the rows and shingles of a group."""
    return F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("n_shingles") / TILE_SHINGLES)).cast("int").alias(name)


def _by_size(rows: DataFrame) -> DataFrame:
    """Rows of families in tiles of one band of set sizes, or of one band against the next.

    Bands grow by more than 4/3, so sets of similarity 0.75 are at most one band apart.
    """
    banded = rows.withColumn("band", F.floor(F.log(F.col("n_shingles")) / math.log(SIZE_BAND)))
    lower = banded.withColumn("pair", F.xxhash64("family", "band"))
    upper = banded.withColumn("pair", F.xxhash64("family", F.col("band") - 1))
    n_lower, n_upper = lower.groupBy("pair").agg(_n_tiles("n_lower")), upper.groupBy("pair").agg(_n_tiles("n_upper"))
    both = n_lower.join(n_upper, "pair")

    def across(df: DataFrame, own: str, other: str, side: int) -> DataFrame:
        part, many = F.pmod(F.xxhash64("vid"), F.col(own)), F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        df = df.join(both, "pair").withColumn("own", part.cast("int")).withColumn("other", many)
        names = ("own", "other") if side == 0 else ("other", "own")
        return df.withColumns({"tile": F.xxhash64(F.lit("bands"), "pair", *names), "side": F.lit(side)})

    within = _spread(lower.join(n_lower, "pair"), "pair", F.col("n_lower"))
    columns = [*rows.columns, "tile", "side"]
    return within.select(*columns).unionByName(across(lower, "n_lower", "n_upper", 0).select(*columns)).unionByName(across(upper, "n_upper", "n_lower", 1).select(*columns))


def _spread(rows: DataFrame, key: str, n_tiles: Column) -> DataFrame:
    """Rows of each key in tiles of parts against parts; side is 0, 1, or 2 for a part that meets itself."""
    own = F.pmod(F.xxhash64("vid"), n_tiles).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), n_tiles - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    tile = F.when(n_tiles == 1, F.col(key)).otherwise(F.xxhash64(F.col(key), F.least("own", "other"), F.greatest("own", "other")))
    return spread.withColumns({"tile": tile, "side": side.cast("int")})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    return _resolved(docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for all except one of each component, the one with the smallest doc_id."""
    found = _resolved(docs)
    path = work_dir(docs.sparkSession, "near-dup-kept")
    alike = found.groupBy("doc_id", "text_hash", "component_id", "n_shingles").agg(F.count("*").alias("n"))
    alone = alike.filter("n_shingles = 0").select("doc_id", "text_hash", F.lit(1).cast("long").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = alike.filter("n_shingles > 0").groupBy("component_id").agg(F.min_by(F.struct("doc_id", "text_hash", "n"), order).alias("x")).select("x.*")
    id_, hash_ = fresh_names(docs.columns, "id", "text_hash")
    chosen = settle(chosen.unionByName(alone).withColumnsRenamed({"doc_id": f"{id_}_", "text_hash": f"{hash_}_", "n": "n_rows"}), path)
    keyed = docs.withColumns({id_: F.col("doc_id").cast("long"), hash_: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})

    def of(some: DataFrame) -> DataFrame:
        return keyed.join(some, keyed[id_].eqNullSafe(some[f"{id_}_"]) & (keyed[hash_] == some[f"{hash_}_"]), "left_semi")

    repeated = chosen.filter("n_rows > 1")
    left = of(chosen.filter("n_rows = 1"))
    if not repeated.isEmpty():
        left = left.unionByName(of(repeated).dropDuplicates([id_, hash_]))
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def _resolved(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    job = _Job(docs)
    rows = job.kept(job.docs.mapInArrow(_profile, "doc_id long, n_shingles long, sid binary, sig binary, text_hash long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")).alias("row")
    merged = rows.filter("sid is not null").groupBy("sid").agg(first, F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.count("*").alias("n"))
    classes = job.kept(merged.select("sid", "row.doc_id", "row.text_hash", "n_shingles", "sig", "n", F.monotonically_increasing_id().alias("vid")))

    keyed = classes.select("vid", "sig").mapInArrow(_keyed, "key long, vid long, used long")
    heads = keyed.groupBy("key").agg(F.min("vid").alias("head"), F.count("*").alias("n")).filter("n > 1")
    members = job.kept(keyed.join(heads.select("key", "head"), "key"))

    stars = members.filter("vid <> head").groupBy(F.col("vid").alias("b")).agg(F.min("head").alias("a")).select("a", "b")
    links = job.verified(job.kept(stars), classes)
    labels = job.labels(links)
    links = links.unionByName(job.family_links(members, labels, classes))
    labels = job.labels(links)

    placed = job.kept(classes.join(labels, "vid", "left").select("sid", "doc_id", "n", F.coalesce("label", "vid").alias("label")))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ids = job.kept(placed.select("sid", "n", "label").join(least, "label").select("sid", "n", "component_id"))
    out = join_facts(rows.select("doc_id", "n_shingles", "sid", "text_hash"), ids, "sid", "n")
    own = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def oracle_sql() -> str:
    """All pairs by shared shingles, for small tables."""
    return r"""
    WITH RECURSIVE d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d),
    u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b)
    SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
    FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = s.doc_id"""
