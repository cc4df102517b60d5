"""Connected components of an edge table by hooking to smaller neighbours and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .session import settle


def connected_components(edges: DataFrame, path: str) -> DataFrame:
    """(v, label) for every vertex of ``edges`` (a, b); label is the smallest vertex of v's component.

    Each round hooks every vertex to its smallest smaller neighbour, follows the hooks to their roots
    (doubling), and keeps the edges between different roots. Only local minima survive a round, so a few
    rounds are enough for any shape, chains and stars alike. Every step is a table below ``path``.
    Loops and repeated edges do no harm; an edge with a null end is ignored; no edges give no rows.
    """
    step = 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        return settle(df, f"{path}/{step}")

    def oriented(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    labels = None
    left = kept(oriented(edges))
    while not left.isEmpty():
        hooks = kept(left.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")))
        while True:
            up = hooks.select(F.col("v").alias("p"), F.col("p").alias("q"))
            jumped = kept(hooks.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")))
            hooks = jumped.select("v", "p")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = kept(hooks.select("v", F.col("p").alias("label")))
        else:
            root = hooks.select(F.col("v").alias("label"), F.col("p").alias("root"))
            old = labels.join(root, "label", "left").select("v", F.coalesce("root", "label").alias("label"))
            labels = kept(old.union(hooks.join(labels, "v", "left_anti").select("v", F.col("p").alias("label"))))
        a = hooks.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        b = hooks.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        left = kept(oriented(left.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))))
    if labels is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("label"))
    roots = labels.select(F.col("label").alias("v"), "label").distinct()
    return kept(labels.unionByName(roots).groupBy("v").agg(F.min("label").alias("label")))
