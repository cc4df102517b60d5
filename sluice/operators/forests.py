"""All trees of all targets as flat node tables, evaluated in one vectorised pass.

Each node is a place in five arrays: the feature it looks at, its threshold, the places of its two sides and its value. Rows go down all trees at
once, a level a step, so the plan is one expression however many trees and targets there are. The tables are broadcast; they
hold 28 bytes a node, so trees * 2^(depth + 1) * 28 bytes at most, which ``MOST_BYTES`` bounds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

from ..functions.shipping import ship

#: Rows and trees that are looked at together: places, features and thresholds take 24 bytes each.
CELLS = 1 << 20
MOST_BYTES = 1 << 30


@dataclass(frozen=True)
class FlatForest:
    """Node arrays, the places of the roots, and which target each tree belongs to; a leaf's sides are its own place."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    target: np.ndarray
    targets: tuple[str, ...]

    @classmethod
    def read(cls, spark: SparkSession, paths: Sequence[tuple[str, str]]) -> FlatForest:
        """From (target, path) of saved forests; ``nodes`` of a tree come to the driver, as the model itself did when it was trained."""
        parts, roots, owners, at = [], [], [], 0
        for k, (_, path) in enumerate(paths):
            node = F.col("nodeData")
            rows = spark.read.parquet(f"{path}/data").select(
                "treeID", node["id"].alias("id"), node["split"]["featureIndex"].alias("feature"), F.coalesce(F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)), F.lit(0.0)).alias("threshold"),
                node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["prediction"].alias("value"), (node["split"]["numCategories"] >= 0).alias("categories"),
            )
            table = rows.orderBy("treeID", "id").toArrow()
            if any(table.column("categories").to_pylist()):
                raise ValueError("splits by categories aren't supported; features are numbers")
            trees, ids = table.column("treeID").to_numpy(), table.column("id").to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], trees[1:] != trees[:-1]])) if len(trees) else np.zeros(0, dtype=np.int64)
            base = np.repeat(begins, np.diff(np.append(begins, len(trees)))) + at
            if (ids != np.arange(len(ids)) + at - base).any():
                raise ValueError(f"{path} lacks nodes")
            own = np.arange(len(ids)) + at
            leaf = table.column("left").to_numpy() < 0
            sides = [np.where(leaf, own, base + table.column(c).to_numpy()) for c in ("left", "right")]
            parts.append([np.where(leaf, 0, table.column("feature").to_numpy()), table.column("threshold").to_numpy(), *sides, table.column("value").to_numpy()])
            roots.append(begins + at)
            owners.append(np.full(len(begins), k))
            at += len(ids)
        feature, threshold, left, right, value = (np.concatenate([p[c] for p in parts]) for c in range(5))
        kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
        made = cls(*(a.astype(t) for a, t in zip((feature, threshold, left, right, value), kinds, strict=True)), np.concatenate(roots).astype(np.int32), np.concatenate(owners).astype(np.int32), tuple(t for t, _ in paths))
        if made.n_bytes > MOST_BYTES:
            raise ValueError(f"the forests' nodes take {made.n_bytes} bytes, more than are broadcast")
        return made

    @property
    def n_bytes(self) -> int:
        return sum(a.nbytes for a in (self.feature, self.threshold, self.left, self.right, self.value))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The values that each row (a row of the result) gets from each tree."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        while True:
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            below = np.where(goes_left, self.left[at], self.right[at])
            if (below == at).all():
                return self.value[at]
            at = below

    def means_and_spreads(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each target the mean and the population deviation over its trees."""
        step = max(1, CELLS // max(1, len(self.roots)))
        parts = [self.leaves(x[k : k + step]) for k in range(0, len(x), step)]
        each = np.concatenate(parts) if parts else np.zeros((0, len(self.roots)))
        own = [each[:, self.target == k] for k in range(len(self.targets))]
        return [(e.mean(1), e.std(1)) for e in own]


def scores(spark: SparkSession, forest: FlatForest, features: Column) -> Column:
    """A struct of pred_<t> and unc_<t> of an array of numbers."""
    ship(spark)
    sent = spark.sparkContext.broadcast(forest)
    names = [f"{kind}_{t}" for t in forest.targets for kind in ("pred", "unc")]

    def evaluate(column: pa.Array) -> pa.Array:
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
        arrays = [pa.array(a) for pair in sent.value.means_and_spreads(x) for a in pair]
        return pa.StructArray.from_arrays(arrays, names=names)

    return F.arrow_udf(evaluate, "struct<" + ",".join(f"{json.dumps(n).replace(chr(34), chr(96))}:double" for n in names) + ">")(features)
