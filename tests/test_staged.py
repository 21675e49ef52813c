"""Forests of every size and depth from one fit, against trees that vote one by one."""

from unittest.mock import patch

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitalis.operators import models, staged


def labelled(spark, n=240, groups=4, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        label = int(rng.integers(3))
        x = rng.normal(size=4) + [label, 0, -label * 0.5, 0]
        rows.append((k, f"s{k % groups}", *map(float, x), float(label)))
    df = spark.createDataFrame(rows, "id long, subject string, a double, b double, c double, d double, label double")
    return models.assemble(df, ["a", "b", "c", "d"]).select("id", "subject", "features", "label")


def plain_vote(tree, x, depth):
    """Class shares at the node that a row reaches in at most ``depth`` steps, by walking Spark's own tree."""
    node = tree._java_obj.rootNode()
    for _ in range(depth):
        if node.subtreeDepth() == 0:
            break
        split = node.split()
        node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
    stats = np.array(list(node.impurityStats().stats()))
    return stats / stats.sum()


def test_staged_votes_equal_separate_ones(spark):
    df = labelled(spark)
    model = models.fit_forest(df, trees=12, depth=4, balanced=True)
    nodes = staged.ForestNodes.of(model, spark)
    x = np.array([r[0] for r in df.orderBy("id").select(vector_to_array("features")).collect()])
    trees, depths = [1, 2, 5, 12], [0, 1, 3, 4]
    got = nodes.staged(x, trees, depths)
    for i, depth in enumerate(depths):
        votes = np.array([[plain_vote(t, row, depth) for row in x[:60]] for t in model.trees])
        for k, n in enumerate(trees):
            assert (got[i, k, :60] == votes[:n].sum(axis=0).argmax(axis=1)).all()
    whole = [int(r.prediction) for r in model.transform(df).orderBy("id").collect()]
    assert got[3, 3].tolist() == whole  # all trees at full depth are Spark's own prediction


def test_cells_count_every_row_once(spark):
    df = labelled(spark)
    model = models.fit_forest(df, trees=6, depth=3)
    nodes = staged.ForestNodes.of(model, spark)
    empty = df.limit(1).select("id", "subject", "features", F.lit(None).cast("double").alias("label"))
    cells = staged.staged_cells(df.unionByName(empty).repartition(5), nodes, [2, 6], [1, 3]).collect()
    assert all(sum(c.n for c in cells if (c.trees, c.depth) == (n, d)) == 240 for n in (2, 6) for d in (1, 3))
    right = model.transform(df).filter("label = prediction").count()
    assert sum(c.n for c in cells if (c.trees, c.depth) == (6, 3) and c.truth == c.pred) == right
    with pytest.raises(ValueError, match="6 trees"):
        staged.staged_cells(df, nodes, [7], [1])


def test_leave_one_group_out(spark):
    df = labelled(spark)
    table = {(r.n_estimators, r.max_tree_depth): r.accuracy for r in staged.loso_tune(df, "subject", [1, 8], [1, 3]).collect()}
    assert set(table) == {(1, 1), (1, 3), (8, 1), (8, 3)}
    right = 0
    for g in range(4):
        train, test = df.filter(f"subject <> 's{g}'"), df.filter(f"subject = 's{g}'")
        right += models.fit_forest(train, 8, 3, True).transform(test).filter("label = prediction").count()
    assert table[8, 3] == pytest.approx(right / 240)
    (none,) = staged.loso_tune(df.filter("false"), "subject", [2], [1]).collect()
    assert none.accuracy is None


def test_many_rows_keep_their_nodes(spark):
    """Beyond few rows x trees a fit remembers where rows are, beyond many fits no longer run side by side; the table is the same."""
    df = labelled(spark)
    tune = lambda: sorted(tuple(r) for r in staged.loso_tune(df, "subject", [3, 8], [1, 3]).collect())
    want, kept, threads = tune(), [], []

    def fit(*args):
        kept.append(args[-1])
        return plain(*args)

    def pool(n):
        threads.append(n)
        return workers(n)

    plain, workers = models.fit_forest, staged.ThreadPoolExecutor
    for few, most, keeps, side in ((10**7, 10**9, False, 4), (1000, 4000, True, 2), (0, 1000, False, 1)):
        kept.clear()
        with patch.multiple(staged, FEW_PLACES=few, MOST_PLACES=most, ThreadPoolExecutor=pool), patch.object(models, "fit_forest", fit):
            assert tune() == want
        assert set(kept) == {keeps} and threads.pop() == side


def test_kept_nodes_give_the_same_trees(spark):
    df = labelled(spark)
    plain, kept = (models.fit_forest(df, 9, 4, True, 42, keep) for keep in (False, True))
    assert kept.getCacheNodeIds() and not plain.getCacheNodeIds()
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in plain.trees]
