"""Forests of every size and depth from one fit, and leave-one-group-out tuning with them.

The first n trees of a forest are a forest of n trees, and a tree cut at depth d is the tree that
would have been grown to depth d: splits above d don't know how far growth goes on. So one fit
with the most trees and the greatest depth answers for the whole grid, in one scoring pass that adds the
trees' votes up and looks at the sums after each wanted number of trees.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.operators.splits import logo_frames
from vitalis.session import scratch_path


@dataclass(frozen=True)
class ForestNodes:
    """All nodes of a forest's trees in a row; ``votes`` are each node's class shares, leaf or not."""

    roots: np.ndarray
    feature: np.ndarray  # -1 at leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    votes: np.ndarray

    @classmethod
    def of(cls, model: Model, spark) -> "ForestNodes":
        """Read from the model's own saved table of nodes (continuous splits only)."""
        path = scratch_path(spark, "forest")
        model.write().save(path)
        node = F.col("nodeData")
        split = node["split"]
        saved = spark.read.parquet(f"{path}/data").select(
            F.col("treeID").alias("tree"), node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
            split["numCategories"].alias("categories"), node["impurityStats"].alias("stats"),
        )
        rows = saved.toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])  # at most trees x 2^(depth + 1) rows
        get = lambda c: rows[c].to_numpy()
        tree, inner = get("tree"), get("left") >= 0
        if (get("categories")[inner] >= 0).any():
            raise ValueError("categorical splits can't be staged")
        roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
        start = roots[np.cumsum(np.r_[False, tree[1:] != tree[:-1]])]  # ids count from 0 within a tree
        stats = np.array(rows["stats"].to_pylist())
        return cls(
            roots, np.where(inner, get("feature"), -1), np.nan_to_num(rows["threshold"].fill_null(0.0).to_numpy()),
            np.where(inner, start + get("left"), -1), np.where(inner, start + get("right"), -1), stats / stats.sum(axis=1, keepdims=True),
        )

    def staged(self, x: np.ndarray, trees: Sequence[int], depths: Sequence[int]) -> np.ndarray:
        """Predicted class by (depth, number of trees, row)."""
        wanted, rows = {n: k for k, n in enumerate(trees)}, np.arange(len(x))
        sums = np.zeros((len(depths), len(x), self.votes.shape[1]))
        out = np.zeros((len(depths), len(trees), len(x)), dtype=np.int64)
        for number, root in enumerate(self.roots[: max(trees)], start=1):
            at = np.full(len(x), root)
            for depth in range(max(depths) + 1):
                for k, d in enumerate(depths):
                    if d == depth:
                        sums[k] += self.votes[at]
                inner = self.feature[at] >= 0
                goes_left = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            if number in wanted:
                out[:, wanted[number]] = sums.argmax(axis=2)
        return out


FEW_PLACES = 10_000_000  # rows x trees up to which walking the trees costs less than remembering where rows are
MOST_PLACES = 1_200_000_000  # rows x trees of all fits that run at once, whose counts and nodes are to stay in memory

_CELLS = pa.schema([(c, pa.int64()) for c in ("trees", "depth", "truth", "pred", "n")])


def staged_cells(df: DataFrame, nodes: ForestNodes, trees: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """(trees, depth, truth, pred, n): the confusion counts of every forest of the grid, in one pass over the rows."""
    trees, depths = list(trees), list(depths)
    if max(trees) > len(nodes.roots):
        raise ValueError(f"the forest has {len(nodes.roots)} trees only")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: Counter = Counter()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
            truth = np.asarray(batch.column("truth"))
            for i, by_trees in enumerate(nodes.staged(x, trees, depths)):
                for k, pred in enumerate(by_trees):
                    for (t, p), n in zip(*_counted(truth, pred)):
                        cells[trees[k], depths[i], t, p] += n
        lines = [(*cell, n) for cell, n in cells.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in lines], pa.int64()) for k in range(5)], schema=_CELLS)

    rows = df.filter("label IS NOT NULL").select(vector_to_array("features").alias("x"), F.col("label").cast("long").alias("truth"))
    counted = rows.mapInArrow(run, "trees long, depth long, truth long, pred long, n long")
    return counted.groupBy("trees", "depth", "truth", "pred").agg(F.sum("n").alias("n"))


def _counted(truth: np.ndarray, pred: np.ndarray) -> tuple[list, list]:
    pairs, n = np.unique(np.stack([truth, pred], axis=1), axis=0, return_counts=True)
    return pairs.tolist(), n.tolist()


def loso_tune(
    df: DataFrame, group: str, trees: Sequence[int], depths: Sequence[int], seed: int = 42, parallelism: int = 4
) -> DataFrame:
    """Accuracy of balanced forests for each (trees, depth) under leave-one-group-out.

    One forest is fitted for each group left out, several side by side, fewer if rows x trees are many; rows without
    label or group take no part.
    """
    from vitalis.operators.models import fit_forest

    trees, depths = list(trees), list(depths)
    places = df.filter("label IS NOT NULL").count() * max(trees)
    keep = FEW_PLACES < places <= MOST_PLACES

    def fold(parts: tuple) -> list:
        _, train, test = parts
        nodes = ForestNodes.of(fit_forest(train, max(trees), max(depths), True, seed, keep), df.sparkSession)
        return staged_cells(test, nodes, trees, depths).collect()  # at most grid x labels x labels rows

    right, total = Counter(), Counter()
    with ThreadPoolExecutor(max(1, min(parallelism, MOST_PLACES // max(places, 1)))) as pool:
        for cells in pool.map(fold, logo_frames(df, group)):
            for c in cells:
                total[c.trees, c.depth] += c.n
                right[c.trees, c.depth] += c.n * (c.truth == c.pred)
    rows = [(n, d, right[n, d] / total[n, d] if total[n, d] else None) for n in trees for d in depths]
    return df.sparkSession.createDataFrame(rows, "n_estimators int, max_tree_depth int, accuracy double")
