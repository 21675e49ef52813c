"""Summed gradients against finite differences and plain fits; wide components against a singular value decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.operators import descent, models, wide


def frame_of(spark, x, y):
    names = [f"c{k}" for k in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "label"]))
    return models.assemble(df, names).select("features", "label")


def test_candidates_reach_the_absolute_minimum(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 3)) * [1, 10, 0.1] + [0, 5, 1]
    y = x @ [2.0, -0.3, 4.0] + 7 + rng.laplace(size=1500) + 40 * (rng.random(1500) < 0.1)  # outliers that squares would follow
    df = frame_of(spark, x, y).unionByName(frame_of(spark, x[:2], y[:2]).withColumn("label", F.lit(None).cast("double")))
    fitted = descent.lad_candidates(df.repartition(3), df.limit(1200))
    assert len(fitted.errors) == 32 and len({tuple(c) for c in fitted.coefficients.round(9)}) == 32
    best = fitted.best
    got = np.abs(x @ fitted.coefficients[best] + fitted.intercepts[best] - y).mean()
    lad = models.mean_absolute_error(models.fit_lad(df.dropna()), df.dropna())
    assert got <= 1.01 * lad and got < models.mean_absolute_error(models.fit_linear(df.dropna()), df.dropna())
    rows = fitted.table(df).collect()
    assert sum(r.chosen for r in rows) == 1 and {(r.learning_rate, r.penalty) for r in rows} == {(a, b) for a in descent.RATES for b in descent.PENALTIES}
    for k in (0, 17):  # the errors are those of the returned coefficients
        part = df.dropna().limit(1200).collect()
        want = np.mean([abs(r.features.toArray() @ fitted.coefficients[k] + fitted.intercepts[k] - r.label) for r in part])
        assert fitted.errors[k] == pytest.approx(want, rel=0.05)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(5)
    net = descent.ReluNet.start([3, 6, 5, 2])
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 2, 20)
    loss, found = net.gradients(x, y)
    for w, g in zip(net.layers, found):
        for place in [(0, 0), (1, 1), (w.shape[0] - 1, w.shape[1] - 1)]:
            old, step = w[place], 1e-6
            w[place] = old + step
            up = net.gradients(x, y)[0]
            w[place] = old - step
            down = net.gradients(x, y)[0]
            w[place] = old
            assert g[place] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-6)
    assert loss == pytest.approx(-net.forward(x)[0][np.arange(20), y].sum())


def test_network_learns_and_matches_a_plain_loop(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    net = descent.fit_relu_net(frame_of(spark, x, y).repartition(4), [2, 10, 10, 2], epochs=60, rate=0.02)
    assert len(net.losses) == 60 and net.losses[-1] < 0.4 * net.losses[0]
    plain = descent.ReluNet.start([2, 10, 10, 2])
    m, v = [0.0] * 3, [0.0] * 3
    for step in range(1, 61):
        _, found = plain.gradients(x, y)
        for k, g in enumerate(found):
            g = g / 400
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            plain.layers[k] = plain.layers[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(net.layers, plain.layers))
    df = frame_of(spark, x, y)
    assert net.transform(df).filter("prediction = label").count() > 0.85 * 400
    assert descent.fit_relu_net(df.limit(0), [2, 3, 2], epochs=2).losses == []


@pytest.mark.parametrize("center", [True, False])
def test_wide_components_span_those_of_a_decomposition(spark, center):
    rng = np.random.default_rng(7)
    n, d, rank = 60, 20_000, 6
    x = rng.normal(size=(n, rank)) * [9, 7, 5, 3, 2, 1] @ np.linalg.qr(rng.normal(size=(d, rank)))[0].T + 2.0 + rng.normal(size=(n, d)) * 1e-5
    df = spark.createDataFrame([(row.tolist(),) for row in x] + [(None,)], "v array<double>").repartition(5)
    pca = wide.wide_pca(df, "v", 5, center=center)
    moved = x - x.mean(axis=0) if center else x
    _, values, axes = np.linalg.svd(moved, full_matrices=False)
    base = n - 1 if center else n
    assert pca.variances == pytest.approx(values[:5] ** 2 / base, rel=1e-6)
    assert pca.total_variance == pytest.approx((moved**2).sum() / base, rel=1e-9)
    overlap = np.linalg.svd(pca.components @ axes[:5].T, compute_uv=False)
    assert np.abs(1 - overlap).max() < 1e-6 and np.allclose(pca.components @ pca.components.T, np.eye(5), atol=1e-9)


def test_tree_of_factors_is_one_factor(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 4))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(9)
    r = wide.tree_qr(df, "v", 4, 4, lambda a: a)
    assert np.allclose(r.T @ r, x.T @ x)
    with pytest.raises(ValueError, match="no rows"):
        wide.wide_pca(df.limit(0), "v", 2)


def test_passes_read_blocks_and_a_constant_has_deviation_one(spark):
    x = np.c_[np.arange(5000) % 97 / 7, np.full(5000, 0.1)]
    y = x[:, 0] * 3 + 1
    rows = descent._plain(frame_of(spark, x, y).coalesce(1), "features", "label")
    assert rows.count() <= 2 and dict(rows.dtypes) == {"x": "binary", "y": "binary"}  # not a row for each row
    mean, spread = descent._spread(rows)
    assert mean == pytest.approx([x[:, 0].mean(), 0.1, y.mean()]) and spread == pytest.approx([x[:, 0].std(), 1.0, y.std()])


def test_gradients_of_tiles_add_up():
    rng = np.random.default_rng(8)
    net = descent.ReluNet.start([2, 10, 10, 2])
    x, y = rng.normal(size=(descent.TILE * 2 + 5, 2)), rng.integers(0, 2, descent.TILE * 2 + 5)
    loss, found = net.gradients(x, y)
    parts = [net.gradients(x[k::3], y[k::3]) for k in range(3)]
    assert loss == pytest.approx(sum(p[0] for p in parts))
    assert all(np.allclose(g, sum(p[1][k] for p in parts)) for k, g in enumerate(found))
    assert loss == pytest.approx(-net.forward(x)[0][np.arange(len(y)), y].sum())
