"""Kernel classifiers: the map against its kernel, the fit against a plain minimiser, searches and saved models."""

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vitalis.operators import kernels, models


def rings(n=240, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    return x, ((x**2).sum(axis=1) > 1.4).astype(int)


def frame_of(spark, x, y, folds=4):
    rows = [(k, k % folds, *map(float, v), float(t)) for k, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, label double")
    return models.assemble(df, ["a", "b"]).select("id", "fold", "features", "label")


def test_map_reproduces_the_kernel():
    x, _ = rings(300)
    for gamma in (0.05, 0.5, 2.0):
        whole = kernels.kernel_block(x, x, "rbf", gamma)
        assert whole[3, 8] == pytest.approx(np.exp(-gamma * ((x[3] - x[8]) ** 2).sum()))
        errors = []
        for n in (10, 40, 160):
            phi = kernels.Nystroem(x[:n], "rbf", gamma)(x)[:, :-1]
            errors.append(np.abs(phi @ phi.T - whole).mean())
            assert np.abs(phi[:n] @ phi.T - whole[:n]).max() < 1e-3  # exact where one side is a landmark
        assert errors[-1] < 0.01 and errors[-1] <= errors[0]


def plain_objective(phi, y, w, c, width):
    return 0.5 * w[:-1] @ w[:-1] + c * kernels.hinge(y * (phi @ w), width)[0].sum()


def test_machines_reach_the_minimum(spark):
    x, y = rings(120, 9)
    df = frame_of(spark, x, y)
    points = kernels.landmarks_of(df, "features", 20)
    assert len(points) == 20 and {tuple(p) for p in points} <= {tuple(p) for p in x}
    machines = [kernels.Machine(1.0, 0.5), kernels.Machine(10.0, 0.5, held_out=2), kernels.Machine(1.0, 0.0, "linear"), kernels.Machine(0.1, 2.0)]
    rows = kernels.plain_rows(df.repartition(3), "features", "label", "fold")
    for m, w in zip(machines, kernels.fit_machines(rows, machines, points)):
        seen = np.arange(120) % 4 != m.held_out
        phi, sign = kernels.Nystroem(points, m.kernel, m.gamma)(x)[seen], np.where(y == 1, 1.0, -1.0)[seen]
        v, width = np.zeros(phi.shape[1]), kernels.WIDTHS[-1]
        for k in range(20_000):  # plain gradient steps
            g = np.r_[v[:-1], 0.0] + m.c * phi.T @ (kernels.hinge(sign * (phi @ v), width)[1] * sign)
            v -= g / (1 + m.c * np.linalg.norm(phi, 2) ** 2 / width) * 1.0
        assert plain_objective(phi, sign, w, m.c, width) <= plain_objective(phi, sign, v, m.c, width) * 1.01 + 1e-9


def test_hinge_derivatives():
    z = np.linspace(-2, 2, 401)
    for width in (1.0, 0.1):
        value, slope, bend = kernels.hinge(z, width)
        assert np.abs(np.gradient(value, z) - slope)[1:-1].max() < 0.06 and (bend >= 0).all()
        assert np.abs(value - np.maximum(0, 1 - z)).max() <= width / 2 + 1e-12


def test_estimator_in_a_search_and_saved_model(spark, tmp_path):
    x, y = rings()
    df = frame_of(spark, x, y).unionByName(frame_of(spark, x[:3], y[:3]).withColumn("label", F.lit(None).cast("double")).withColumn("id", F.col("id") + 1000))
    model = kernels.KernelSvc(C=10.0, gamma=0.5, landmarks=60).fit(df)
    scored = model.transform(df)
    assert scored.filter("label = prediction").count() > 0.95 * 240 and scored.count() == 243
    model.write().overwrite().save(str(tmp_path / "m"))
    again = kernels.KernelSvcModel.load(str(tmp_path / "m"))
    assert (again.getOrDefault("C"), again.getOrDefault("kernel"), again.uid) == (10.0, "rbf", model.uid)
    both = scored.select("id", "rawPrediction").join(again.transform(df).select("id", F.col("rawPrediction").alias("other")), "id")
    assert both.filter("rawPrediction = other").count() == 243
    svc = kernels.KernelSvc(landmarks=30)
    svc.write().overwrite().save(str(tmp_path / "e"))
    assert kernels.KernelSvc.load(str(tmp_path / "e")).getOrDefault("landmarks") == 30
    grid = ParamGridBuilder().addGrid(svc.kernel, ["linear", "rbf"]).build()
    metric = MulticlassClassificationEvaluator(metricName="accuracy")
    search = CrossValidator(estimator=svc, estimatorParamMaps=grid, evaluator=metric, numFolds=2, foldCol="half")
    found = search.fit(df.dropna().withColumn("half", (F.col("fold") % 2).cast("int")))
    assert found.bestModel.getOrDefault("kernel") == "rbf"


def test_grid(spark):
    x, y = rings()
    best, table = kernels.svc_grid(frame_of(spark, x, y), "fold", 4, {"c": [0.1, 10], "gamma": [5, 0.5], "kernel": ["linear", "rbf"]}, landmarks=50)
    scores = {(r.C, r.gamma, r.kernel): r.accuracy for r in table.collect()}
    assert len(scores) == 8 and scores[0.1, 5, "linear"] == scores[0.1, 0.5, "linear"]
    assert max(scores, key=scores.get)[2] == "rbf" and best.getOrDefault("kernel") == "rbf" and max(scores.values()) > 0.9
    machine = kernels.Machine(10, 0.5, "rbf", held_out=1)  # one cell by itself
    rows = kernels.plain_rows(frame_of(spark, x, y), "features", "label", "fold")
    points = kernels.landmarks_of(frame_of(spark, x, y), "features", 50)
    (w,) = kernels.fit_machines(rows, [machine], points)
    own = np.arange(240) % 4 == 1
    hits = ((kernels.Nystroem(points, "rbf", 0.5)(x[own]) @ w > 0) == (y[own] == 1)).sum()
    assert kernels._right(rows, [machine], points, [w]).tolist() == [[hits, own.sum()]]
