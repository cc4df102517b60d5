"""A Merkle manifest of a dataset, and proofs that a row belongs to it.

Leaves. A row's leaf is the digest of its fields: each ``-`` if null, else its length in UTF-8 bytes, ``:`` and its value.
All digests are SHA-256; where digests are concatenated they stand as lowercase hex text. Tables hold them as 32 bytes.

Trees. Rows of one group (``lang``) ascend by id and form one tree; FANOUT consecutive nodes have one parent, until one
node is left, the group's subroot. The subroots, in order of their groups, form the top tree in the same way. Rows get their places
by ranges of (group, id): a range's rows are counted by group and the counts of earlier ranges added, so a group that holds most
rows is spread like any other. Each level is aggregated from the one below and becomes part of one materialised node table,
whose rows are the runs of siblings: (tree, level, run) and the run's digests.

Proofs. A leaf's place and its group's size tell the coordinates of all runs on its way to the root, and its own place in
each. Leaves explode these, join the node table, put what they found in order and concatenate the digests before and after the
own place; from these a proof is made, and the root computed anew. Levels of at most WIDE runs in all, which all leaves need, are
broadcast; a run of the others is needed by at most a few thousandths of the leaves.

Defined results: null fields count as above; rows without an id come first in their group, and rows with the same id go by their
leaf; rows that are equal have equal leaves, each at a place of its own. A null group is a group, the first. An empty table
gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .session import settle, work_dir

FANOUT = 8
#: Runs of levels that are broadcast: at most 4,096 in each tree level, 300 bytes each.
WIDE = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The number of the tree over all groups.
TOP = -1


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def framed(value: Column) -> Column:
    """``-`` or length and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    return digest(F.concat(*(framed(fields[name]) for name in FIELDS)))


@dataclass(frozen=True)
class Manifest:
    """``places``: the leaves with tree, place and size; ``runs``: the node table; ``trees``: tree, group, size and subroot; ``root``."""

    places: DataFrame
    runs: DataFrame
    trees: DataFrame
    root: str | None


def _placed(rows: DataFrame, group: str, order: list[str], path: str) -> DataFrame:
    """``rows`` with ``place`` in their group, in the given order, and ``size`` of the group."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = ranged.withColumn("range", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    ranged = settle(ranged, f"{path}-ranged")
    counts = ranged.groupBy(group, "range").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy(group).orderBy("range")
    offsets = counts.select(
        F.col(group).alias("of_group"), F.col("range").alias("of_range"), "first",
        (F.sum("n").over(earlier) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy(group)).alias("size"),
    )
    same = F.col(group).eqNullSafe(F.col("of_group")) & (F.col("range") == F.col("of_range"))
    place = F.col("before") + F.col("at") - F.col("first")
    return ranged.join(offsets, same).select(*rows.columns, place.alias("place"), "size")


def _runs(nodes: DataFrame, path: str) -> DataFrame:
    """The runs (tree, level, run, digests) of all levels above the given nodes (tree, size, place, node)."""
    level, spark, found = 0, nodes.sparkSession, []
    while True:
        members = F.array_sort(F.collect_list(F.struct("place", "node"))).alias("members")
        runs = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("run")).agg(members, F.ceil(F.first("size") / FANOUT).alias("size"))
        joined = F.aggregate("members", F.lit(b""), lambda text, m: F.concat(text, m["node"]))
        runs = settle(runs.select("tree", F.lit(level).alias("level"), "run", "size", joined.alias("digests")), f"{path}-{level}")
        found.append(f"{path}-{level}")
        several = runs.filter("size > 1")  # a tree of one run has reached its top
        if several.isEmpty():
            return spark.read.schema(runs.schema).parquet(*found).drop("size")
        nodes = several.select("tree", "size", F.col("run").alias("place"), digest(as_hex(F.col("digests"))).alias("node"))
        level += 1


def _subroot(size: Column, digests: Column) -> Column:
    """Of the last run of a tree: the only leaf itself, else the digest of the run."""
    return F.when(size == 1, digests).otherwise(digest(as_hex(digests)))


def _levels(size: Column) -> Column:
    """Numbers of nodes on each level that has several, from the leaves up."""
    counts = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.ceil(size / F.pow(F.lit(float(FANOUT)), k)).cast("long"))
    return F.filter(counts, lambda n: n > 1)


def build(leaves: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``leaves``: columns ``group``, those of ``order`` (the last one distinct), and ``leaf``."""
    path = work_dir(leaves.sparkSession, "merkle")
    places = settle(_placed(leaves, group, order, f"{path}/leaves"), f"{path}/placed")
    groups = places.groupBy(F.col(group).alias("group")).agg(F.first("size").alias("leaves"))
    groups = settle(groups.withColumn("all", F.lit(1)), f"{path}/groups")
    trees = _placed(groups, "all", ["group"], f"{path}/trees").select("group", "leaves", F.col("place").alias("tree"), F.col("size").alias("trees"))
    trees = settle(trees, f"{path}/trees")
    numbered = places.join(trees.select("group", "tree", "trees"), F.col(group).eqNullSafe(F.col("group"))).drop("group")
    numbered = settle(numbered, f"{path}/numbered")

    runs = _runs(numbered.select("tree", "size", "place", F.col("leaf").alias("node")), f"{path}/runs")
    last = runs.groupBy("tree").agg(F.max_by("digests", "level").alias("digests"))
    trees = settle(trees.join(last, "tree").withColumn("subroot", _subroot(F.col("leaves"), F.col("digests"))).drop("digests"), f"{path}/subroots")
    top = _runs(trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("trees").alias("size"), F.col("tree").alias("place"), F.col("subroot").alias("node")), f"{path}/top")
    end = top.orderBy(F.desc("level")).first()
    root = None
    if end is not None:
        n = trees.count()
        root = top.limit(1).select(as_hex(_subroot(F.lit(n), F.lit(bytes(end["digests"]))))).first()[0]
    return Manifest(numbered, runs.unionByName(top), trees, root)


def coordinates(manifest: Manifest) -> DataFrame:
    """(leaf_id, step, tree, level, run, own): the runs that each leaf needs, from its own level to the root."""

    def steps(tree: Column, place: Column, size: Column, low: int) -> Column:
        def step(n: Column, level: Column) -> Column:
            at = F.floor(place / F.pow(F.lit(float(FANOUT)), level)).cast("long")
            return F.struct(
                (level + low).cast("int").alias("step"), tree.cast("long").alias("tree"), level.cast("int").alias("level"),
                F.floor(at / FANOUT).alias("run"), F.pmod(at, F.lit(FANOUT)).cast("int").alias("own"),
            )

        return F.transform(_levels(size), step)

    every = F.concat(steps(F.col("tree"), F.col("place"), F.col("size"), 0), steps(F.lit(TOP), F.col("tree"), F.col("trees"), 100))
    return manifest.places.select("leaf_id", F.explode(every).alias("c")).select("leaf_id", "c.*")


def prove(manifest: Manifest) -> DataFrame:
    """(leaf_id, path): for each leaf that has siblings, the hex texts before and after its own place, level by level."""
    runs = manifest.runs
    widths = runs.groupBy(F.when(F.col("tree") == TOP, F.lit(TOP)).otherwise(0).alias("kind"), F.col("level").alias("of_level")).agg(F.count("*").alias("width"))
    wide = F.broadcast(widths.filter(F.col("width") > WIDE))  # a row for each level at most
    kind = F.when(F.col("tree") == TOP, F.lit(TOP)).otherwise(0)
    of_wide = (kind == F.col("kind")) & (F.col("level") == F.col("of_level"))
    needed, key = coordinates(manifest), ["tree", "level", "run"]
    near = needed.join(wide, of_wide, "left_semi").join(runs.join(wide, of_wide, "left_semi"), key)
    far = needed.join(wide, of_wide, "left_anti").join(F.broadcast(runs.join(wide, of_wide, "left_anti")), key)
    before = F.substring("digests", F.lit(1), 32 * F.col("own"))
    after = F.substring("digests", 32 * F.col("own") + 33, F.lit(32 * FANOUT))
    siblings = near.unionByName(far).select("leaf_id", F.struct("step", before.alias("before"), after.alias("after")).alias("s"))
    return siblings.groupBy("leaf_id").agg(F.array_sort(F.collect_list("s")).alias("path"))


def proof_text(path: Column) -> Column:
    """The digests of all siblings, in order."""
    return F.coalesce(F.array_join(F.transform(path, lambda s: as_hex(F.concat(s["before"], s["after"]))), ""), F.lit(""))


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf (hex) and the digests beside its way."""
    fold = F.aggregate(path, start, lambda own, s: F.sha2(F.concat(as_hex(s["before"]), own, as_hex(s["after"])).cast("binary"), 256))
    return F.coalesce(fold, start)


def verify(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """For each row of ``docs`` (FIELDS): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` replaces fields in the rows that are proved; the manifest is of the rows as they are. ``verified`` says whether
    the proof leads from the row to the root.
    """
    path = work_dir(docs.sparkSession, "merkle-rows")
    given = {name: F.col(name) for name in FIELDS}
    rows = docs.select("doc_id", "lang", leaf(given).alias("leaf"), leaf(given | (tampered or {})).alias("shown"))
    rows = settle(rows.withColumn("leaf_id", F.monotonically_increasing_id()), f"{path}/rows")
    manifest = build(rows, "lang", ["doc_id", "leaf", "leaf_id"])
    proofs = prove(manifest)
    subroots = manifest.trees.select("tree", as_hex(F.col("subroot")).alias("subroot"))
    own = manifest.places.select("leaf_id", "doc_id", "leaf", "shown", "tree").join(subroots, "tree")
    again = folded(as_hex(F.col("shown")), F.col("path"))
    root = F.lit(manifest.root)
    return own.join(proofs, "leaf_id", "left").select(
        "doc_id", as_hex(F.col("leaf")).alias("leaf"), "subroot", root.cast("string").alias("root"),
        F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), again.alias("folded_root"), (again == root).alias("verified"),
    )


def lowered(text: Column) -> Column:
    """A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_third(doc_id: Column) -> Column:
    """Whether 3 divides the crc32 of the id as text; not without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def verify_lowered(docs: DataFrame) -> DataFrame:
    """``verify`` where the texts of ``every_third`` row are shown in lower case."""
    return verify(docs, {"text": F.when(every_third(F.col("doc_id")), lowered(F.col("text"))).otherwise(F.col("text"))})


def oracle_sql() -> str:
    """The trees level by level, then each leaf's way up."""

    def leaf_sql(text: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"

    return f"""
    WITH RECURSIVE crc AS (
      SELECT n, CASE k WHEN 0 THEN n END AS start, n AS c, k FROM (SELECT unnest(range(256)) AS n, 0 AS k) UNION ALL
      SELECT n, start, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc WHERE k < 8),
    bytes AS (SELECT list(c ORDER BY n) AS t FROM crc WHERE k = 8),
    d AS (
      SELECT doc_id, source, lang, n_chars, text, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree,
        CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
          lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]::BIGINT)), 4294967295::BIGINT) % 3 = 0
        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other FROM documents, bytes),
    f AS (SELECT doc_id, tree, {leaf_sql("text")} AS leaf, {leaf_sql("other")} AS shown FROM d),
    g AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM f),
    low(level, tree, pos, h, n) AS (
      SELECT 0, tree, pos, leaf, n FROM g UNION ALL
      SELECT level + 1, tree, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY level, tree, n, pos // 8),
    high(level, pos, h, n) AS (
      SELECT 0, tree, h, (SELECT count(DISTINCT tree) FROM g) FROM low WHERE n = 1 UNION ALL
      SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM high WHERE n > 1 GROUP BY level, n, pos // 8),
    s AS (
      SELECT g.tree, g.pos, low.level AS step, low.pos AS place, g.pos // (8 ** low.level)::BIGINT AS own, low.h FROM g JOIN low
        ON low.tree = g.tree AND low.n > 1 AND low.pos // 8 = g.pos // (8 ** (low.level + 1))::BIGINT UNION ALL
      SELECT g.tree, g.pos, 100 + high.level, high.pos, g.tree // (8 ** high.level)::BIGINT, high.h FROM g JOIN high
        ON high.n > 1 AND high.pos // 8 = g.tree // (8 ** (high.level + 1))::BIGINT),
    p AS (
      SELECT tree, pos, step, coalesce(string_agg(h, '' ORDER BY place) FILTER (place < own), '') AS before,
        coalesce(string_agg(h, '' ORDER BY place) FILTER (place > own), '') AS after, row_number() OVER (PARTITION BY tree, pos ORDER BY step) AS k
      FROM s GROUP BY tree, pos, step),
    fold(tree, pos, k, h) AS (
      SELECT tree, pos, 0, shown FROM g UNION ALL
      SELECT p.tree, p.pos, p.k, sha256(concat(p.before, fold.h, p.after)) FROM fold JOIN p ON p.tree = fold.tree AND p.pos = fold.pos AND p.k = fold.k + 1),
    ends AS (SELECT tree, pos, max_by(h, k) AS h FROM fold GROUP BY tree, pos),
    proofs AS (SELECT tree, pos, string_agg(before || after, '' ORDER BY step) AS proof FROM p GROUP BY tree, pos)
    SELECT g.doc_id, g.leaf, low.h AS subroot, high.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, ends.h AS folded_root, ends.h = high.h AS verified
    FROM g JOIN low ON low.tree = g.tree AND low.n = 1 JOIN high ON high.n = 1 JOIN ends ON ends.tree = g.tree AND ends.pos = g.pos
    LEFT JOIN proofs ON proofs.tree = g.tree AND proofs.pos = g.pos"""
