"""Fitted models against what they are defined by: their losses, kernels, splits and components, written out in numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitalis.operators import models
from vitalis.operators.decompose import Pca, components_to_columns


@pytest.fixture(scope="module")
def points():
    """Three overlapping clouds in two columns of unlike scale."""
    rng = np.random.default_rng(5)
    y = np.arange(150) % 3
    x = rng.normal(0, 1, (150, 2)) * [1.0, 4.0] + np.array([[0, 0], [2, 3], [-2, 5]])[y]
    return x, y


def _frame(spark, x, y):
    rows = pd.DataFrame({"id": np.arange(len(y)), "x": x.tolist(), "label": y.astype(float)})
    return models.assemble(spark.createDataFrame(rows, "id long, x array<double>, label double"), ["x"]).coalesce(1).cache()


def _no_neighbour_is_lower(loss, at, slack=1e-6):
    """Whether no small step, along an axis or in a random direction, lowers a convex loss."""
    rng = np.random.default_rng(0)
    steps = np.vstack([np.eye(len(at)), rng.normal(size=(200, len(at)))])
    here = loss(at)
    return all(loss(at + sign * size * s) >= here - slack for s in steps for size in (0.3, 0.03) for sign in (1, -1))


def test_linear_svc_is_the_least_of_its_loss(spark, points):
    x, y = points[0], (points[1] == 1).astype(int)
    c = 0.5
    model = models.fit_linear_svc(_frame(spark, x, y), c)

    def loss(v):
        margin = (2 * y - 1) * (x @ v[:2] + v[2])
        return np.maximum(0, 1 - margin).mean() + 0.5 / (c * len(y)) * v[:2] @ v[:2]

    at = np.r_[model.coefficients.toArray(), model.intercept]
    assert loss(at) < 0.8 * loss(np.zeros(3)) and _no_neighbour_is_lower(loss, at, 2e-3)


def test_logistic_regression_is_the_least_of_its_loss(spark, points):
    x, y = points
    c, share = 2.0, 0.5
    model = models.fit_logistic(_frame(spark, x, y), c, share)

    def loss(v):
        w, b = v[:6].reshape(3, 2), v[6:]
        z = x @ w.T + b
        likelihood = (np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(y)), y]).mean()
        return likelihood + (share * np.abs(w).sum() + (1 - share) / 2 * (w**2).sum()) / (c * len(y))

    at = np.r_[model.coefficientMatrix.toArray().ravel(), model.interceptVector.toArray()]
    assert _no_neighbour_is_lower(loss, at, 1e-5)
    found = model.transform(_frame(spark, x, y)).orderBy("id").select(vector_to_array("probability").alias("p")).collect()
    z = x @ at[:6].reshape(3, 2).T + at[6:]
    want = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert np.allclose([r["p"] for r in found], want, atol=1e-9)


def test_cosine_features_approximate_the_kernel(spark, points):
    x, y = points
    mapped = _frame(spark, x, y).select("id", vector_to_array(models.fourier_features("features", 2, 0.05, 4096)).alias("m"))
    m = np.array([r["m"] for r in mapped.orderBy("id").collect()])
    want = np.exp(-0.05 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(m @ m.T - want).max() < 0.1 and np.abs(m @ m.T - want).mean() < 0.02


def test_rbf_svc_separates_a_ring(spark):
    rng = np.random.default_rng(2)
    angle, radius = rng.uniform(0, 2 * np.pi, 200), np.r_[rng.uniform(0, 1, 100), rng.uniform(2, 3, 100)]
    x, y = np.c_[radius * np.cos(angle), radius * np.sin(angle)], np.repeat([0, 1], 100)
    rows = _frame(spark, x, y)
    linear = models.fit_linear_svc(rows, 10.0).transform(rows).filter("label = prediction").count()
    assert models.fit_rbf_svc(rows, 2, 10.0, gamma=0.5).transform(rows).filter("label = prediction").count() >= 196 > linear


def test_network_scores_are_its_weights_forward_pass(spark, points):
    x, y = points
    rows = _frame(spark, x, y)
    model = models.fit_mlp(rows, [2, 5, 3], 60)
    v = model.weights.toArray()
    a, b = v[:10].reshape(5, 2, order="F").T, v[10:15]  # as the layers keep them: columns of the matrix one after the other
    hidden = 1 / (1 + np.exp(-(x @ a + b)))
    z = hidden @ v[15:30].reshape(3, 5, order="F").T + v[30:]
    want = np.exp(z - z.max(1, keepdims=True))
    want /= want.sum(1, keepdims=True)
    got = model.transform(rows).orderBy("id").select(vector_to_array("probability").alias("p"), "prediction").collect()
    assert np.allclose([r["p"] for r in got], want, atol=1e-6)
    assert (np.array([r["prediction"] for r in got]) == y).mean() > 0.8


def test_forest_predicts_the_mean_of_its_trees_leaves(spark, points):
    x, y = points
    rows = _frame(spark, x, y)
    model = models.fit_forest(rows, trees=7, depth=3)
    votes = sum(
        np.array([r["p"] for r in tree.transform(rows.select("id", "features")).orderBy("id").select(vector_to_array("probability").alias("p")).collect()])
        for tree in model.trees
    )
    got = np.array([r["p"] for r in model.transform(rows).orderBy("id").select(vector_to_array("probability").alias("p")).collect()])
    assert np.allclose(got, votes / 7) and (got.argmax(1) == y).mean() > 0.8


def test_balanced_forest_hears_the_rare_class(spark):
    rng = np.random.default_rng(8)
    y = (np.arange(400) % 20 == 0).astype(int)
    x = rng.normal(0, 1, (400, 2)) + 1.5 * y[:, None]
    rows = _frame(spark, x, y)
    rare = [models.fit_forest(rows, 30, 2, balanced).transform(rows).filter("label = 1 and prediction = 1").count() for balanced in (False, True)]
    assert rare[1] > rare[0] and rare[1] >= 14


def test_boosted_margin_is_the_weighted_sum_of_trees(spark, points):
    x, y = points[0], (points[1] == 2).astype(int)
    rows = _frame(spark, x, y)
    model = models.fit_gbt(rows, learning_rate=0.3, rounds=6, depth=2)
    trees = [[r["prediction"] for r in t.transform(rows.select("id", "features")).orderBy("id").collect()] for t in model.trees]
    margin = np.array(model.treeWeights) @ np.array(trees)
    got = model.transform(rows).orderBy("id").select(vector_to_array("probability").alias("p")).collect()
    assert np.allclose([r["p"][1] for r in got], 1 / (1 + np.exp(-2 * margin)))
    assert model.treeWeights == pytest.approx([1.0] + [0.3] * 5)
    first = np.array(trees[0])  # the first tree fits the signs: each leaf holds their mean
    assert all(v == pytest.approx((2 * y - 1)[first == v].mean()) for v in set(trees[0]))


def test_component_columns_equal_an_svd(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 5)) @ np.diag([5, 3, 2, 1, 0.5]) + 7
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(120), "v": x.tolist()}), "id long, v array<double>")
    made = components_to_columns(Pca.fit(df, "v", k=3).transform(df, "v").drop("v"), "components", 3).orderBy("id")
    got = made.select([F.col(f"pc{i}") for i in (1, 2, 3)]).toPandas().to_numpy()
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = (u * s)[:, :3]
    assert np.allclose(got * np.sign((got * want).sum(0)), want, atol=1e-6)
    assert made.columns[0] == "id"
