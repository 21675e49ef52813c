"""Models, tuning, scoring and components over the tables."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from vitalis.operators import boosting, descent, evaluate, kernels, models, scale, splits, staged
from vitalis.operators.decompose import Pca, components_to_columns
from vitalis.operators.wide import wide_pca
from vitalis.plans.core_queries import rounded
from vitalis.plans.frames import FEATURES, LINE_KEY_SQL, keyed_lines
from vitalis.plans.registry import query, table
from vitalis.session import durable, scratch_path


def _price_lines(spark, d, features):
    lines = keyed_lines(spark, d).select("row_key", *FEATURES).withColumnRenamed("l_extendedprice", "label")
    return models.assemble(lines, features)


@query(
    "linear_regression",
    """
    select round(regr_slope(l_extendedprice, l_quantity), 4) as slope, round(regr_intercept(l_extendedprice, l_quantity), 3) as intercept,
           round(regr_r2(l_extendedprice, l_quantity), 6) as r2 from lineitem
    """,
)
def linear_regression(spark, d):
    lines = _price_lines(spark, d, ["l_quantity"])
    model = models.fit_linear(lines)
    row = (float(model.coefficients[0]), float(model.intercept), models.r2_score(model, lines))
    made = spark.createDataFrame([row], "slope double, intercept double, r2 double")
    return rounded(rounded(rounded(made, 4, "slope"), 3, "intercept"), 6, "r2")


@query(
    "linear_regression_residuals",
    "select count(*) as n, true as sums_to_zero, true as orthogonal from lineitem",
)
def linear_regression_residuals(spark, d):
    """Residuals of the three-feature fit sum to zero and are orthogonal to every feature."""
    columns = ["l_quantity", "l_discount", "l_tax"]
    lines = _price_lines(spark, d, columns)
    residual = F.col("label") - F.col("prediction")
    scored = models.fit_linear(lines).transform(lines)
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("t"), F.sum(residual).alias("r"),
        *[F.sum(residual * F.col(c)).alias(f"r_{c}") for c in columns],
    )
    orthogonal = F.lit(True)
    for c in columns:
        orthogonal = orthogonal & (F.abs(f"r_{c}") < 1e-7 * F.col("t"))
    return sums.select("n", (F.abs("r") < 1e-7 * F.col("t")).alias("sums_to_zero"), orthogonal.alias("orthogonal"))


@query("lad_regression", "select count(*) as n, true as not_worse_than_least_squares from lineitem")
def lad_regression(spark, d):
    lines = durable(_price_lines(spark, d, ["l_quantity", "l_discount", "l_tax"]).select("features", "label"))
    lad = models.mean_absolute_error(models.fit_lad(lines), lines)
    ols = models.mean_absolute_error(models.fit_linear(lines), lines)
    return lines.agg(F.count(F.lit(1)).alias("n")).withColumn("not_worse_than_least_squares", F.lit(bool(lad <= ols)))


@query("lad_candidates", "select cast(32 as bigint) as n_models, cast(1 as bigint) as n_chosen, true as near_reweighted from lineitem having count(*) > 0")
def lad_candidates(spark, d):
    """32 candidates in batches of 30 over 20 epochs; the chosen one is within 2 % of reweighted least squares on the validation rows."""
    lines = _price_lines(spark, d, ["l_quantity", "l_discount", "l_tax"])
    parts = durable(splits.split(lines, ["row_key"], {"train": 0.8, "valid": 0.2}, "candidates").select("features", "label", "split"))
    train, valid = parts.filter("split = 'train'"), parts.filter("split = 'valid'")
    fitted = descent.lad_candidates(train, valid)
    reweighted = models.mean_absolute_error(models.fit_lad(train), valid)
    made = fitted.table(lines).agg(F.count(F.lit(1)).alias("n_models"), F.sum(F.col("chosen").cast("bigint")).alias("n_chosen"))
    return made.withColumn("near_reweighted", F.lit(bool(fitted.errors.min() <= 1.02 * reweighted)))


def _status_parts(spark, d, seed):
    lines = keyed_lines(spark, d).select("row_key", "l_linestatus", *FEATURES)
    ready = models.index_labels(models.assemble(lines, FEATURES), "l_linestatus", ["F", "O"])
    parts = durable(splits.split(ready, ["row_key"], {"train": 0.8, "test": 0.2}, seed).select("row_key", "features", "label", "split"))
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


def _matrix(model, test, n):
    scored = model.transform(test).select(F.col("label").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return evaluate.confusion(scored, "truth", "pred", list(range(n)))


@query("gbt_classifier")
def gbt_classifier(spark, d):
    train, test = _status_parts(spark, d, "gbt")
    return _matrix(models.fit_gbt(train, learning_rate=0.5, rounds=150, depth=3), test, 2)


def _spenders(spark, d):
    """One row per customer with orders: balance, nation and orders, labelled by whether they spend more than 1.2 million."""
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.max("o_totalprice").alias("dearest"), F.sum("o_totalprice").alias("spent")
    )
    people = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    rows = people.join(orders, "c_custkey").withColumn("label", (F.col("spent") > 1_200_000).cast("double"))
    return models.assemble(rows, ["c_acctbal", "nation", "n_orders", "dearest"]).select("c_custkey", "features", "label")


@query("boosting_grid")
def boosting_grid(spark, d):
    """The 81 combinations of least gain, row share, column share and depth, five folds each, in one fit."""
    folded = durable(splits.kfold(_spenders(spark, d), ["c_custkey"], "label", 5, "boosting"))
    grid = {"gamma": [0.5, 1, 5], "row_share": [0.6, 0.8, 1.0], "column_share": [0.6, 0.8, 1.0], "depth": [3, 4, 5]}
    _, scores = boosting.boosted_grid(folded, ["c_custkey"], "fold", 5, grid, rounds=100, base=boosting.Setting(learning_rate=0.01))
    return rounded(scores, 6, "accuracy")


@query("boosting_stages")
def boosting_stages(spark, d):
    """Accuracy on one fold after 10 to 100 rounds of depth 5, for three learning rates, from one fit."""
    folded = durable(splits.kfold(_spenders(spark, d), ["c_custkey"], "label", 5, "stages"))
    base = boosting.Setting(depth=5)
    _, scores = boosting.boosted_grid(folded, ["c_custkey"], "fold", 1, {"learning_rate": [0.01, 0.1, 0.5]}, rounds=100, base=base, stages=range(10, 101, 10))
    return rounded(scores, 6, "accuracy")


@query("mlp_classifier")
def mlp_classifier(spark, d):
    lines = keyed_lines(spark, d).select("row_key", "l_linestatus", "l_discount", "l_tax")
    ready = models.index_labels(models.assemble(lines, ["l_discount", "l_tax"]), "l_linestatus", ["F", "O"])
    parts = durable(splits.split(ready, ["row_key"], {"train": 0.9, "test": 0.1}, "mlp").select("features", "label", "split"))
    model = models.fit_mlp(parts.filter("split = 'train'"), [2, 10, 10, 2])
    return _matrix(model, parts.filter("split = 'test'"), 2)


@query("relu_net_history", "select cast(100 as bigint) as n_epochs, true as falls, true as above_zero from lineitem having count(*) > 0")
def relu_net_history(spark, d):
    """The loss table of a 2-10-10-2 network of rectifiers over 100 epochs on standardised columns."""
    lines = keyed_lines(spark, d).select("row_key", "l_linestatus", "l_discount", "l_tax")
    scaled = scale.StdScale.fit(lines, ["l_discount", "l_tax"]).transform(lines)
    ready = models.index_labels(models.assemble(scaled, ["l_discount", "l_tax"]), "l_linestatus", ["F", "O"])
    parts = splits.split(ready, ["row_key"], {"train": 0.8, "test": 0.2}, "relu").select("features", "label", "split")
    net = descent.fit_relu_net(parts.filter("split = 'train'"), [2, 10, 10, 2])
    losses = models.history(net.losses, lines)
    first, last = F.min_by("loss", "epoch"), F.max_by("loss", "epoch")
    return losses.agg(F.count(F.lit(1)).alias("n_epochs"), (last < first).alias("falls"), (F.min("loss") > 0).alias("above_zero"))


def _vector_parts(spark, d, seed, binary):
    rows = models.assemble(table(spark, d, "embeddings"), ["embedding"])
    label = (F.col("label") < 5).cast("double") if binary else F.col("label").cast("double")
    parts = splits.split(rows.withColumn("label", label), ["vec_id"], {"train": 0.8, "test": 0.2}, seed)
    parts = durable(parts.select("vec_id", "features", "label", "split"))
    return parts.filter("split = 'train'"), parts.filter("split = 'test'")


@query("linear_svc")
def linear_svc(spark, d):
    train, test = _vector_parts(spark, d, "svc", True)
    return _matrix(models.fit_linear_svc(train, c=1.0), test, 2)


@query("rbf_svc")
def rbf_svc(spark, d):
    train, test = _vector_parts(spark, d, "rbf", True)
    return _matrix(models.fit_rbf_svc(train, dim=64, gamma=0.5), test, 2)


@query("logistic_elasticnet")
def logistic_elasticnet(spark, d):
    train, test = _vector_parts(spark, d, "logistic", False)
    return _matrix(models.fit_logistic(train), test, 10)


@query("grid_search_table")
def grid_search_table(spark, d):
    rows = models.assemble(table(spark, d, "embeddings"), ["embedding"])
    rows = rows.withColumn("label", (F.col("label") < 5).cast("double")).select("vec_id", "features", "label")
    folded = durable(splits.kfold(rows, ["vec_id"], "label", 5, "grid"))
    _, scores = models.grid_search(
        folded, LogisticRegression(), {"regParam": [0.001, 0.1], "elasticNetParam": [0.0, 0.5]}
    )
    return rounded(scores, 6, "accuracy")


def _folded_vectors(spark, d, seed):
    rows = models.assemble(table(spark, d, "embeddings"), ["embedding"])
    rows = rows.withColumn("label", (F.col("label") < 5).cast("double")).select("vec_id", "features", "label")
    return durable(splits.kfold(rows, ["vec_id"], "label", 5, seed))


@query("svc_grid_50")
def svc_grid_50(spark, d):
    """Five penalties, five widths, both kernels, five folds."""
    grid = {"c": [0.1, 1, 10, 100, 1000], "gamma": [10, 1, 0.1, 0.01, 0.001], "kernel": ["linear", "rbf"]}
    return rounded(kernels.svc_grid(_folded_vectors(spark, d, "svc50"), "fold", 5, grid)[1], 6, "accuracy")


@query("svc_grid_16")
def svc_grid_16(spark, d):
    """Four penalties, four widths, the rbf kernel, five folds."""
    grid = {"c": [0.1, 1, 10, 100], "gamma": [1, 0.1, 0.01, 0.001], "kernel": ["rbf"]}
    return rounded(kernels.svc_grid(_folded_vectors(spark, d, "svc16"), "fold", 5, grid)[1], 6, "accuracy")


def _window_rows(spark, d):
    from vitalis.operators.signal import FEATURE_NAMES
    from vitalis.plans.signal_queries import feature_table

    made = feature_table(spark, d).fillna(0.0, FEATURE_NAMES)
    ready = models.index_labels(models.assemble(made, FEATURE_NAMES), "activity", ["bike", "run", "walk"])
    return durable(ready.select("subject", "user_id", "window", "features", "label"))


@query("random_forest")
def random_forest(spark, d):
    rows = _window_rows(spark, d)
    return _matrix(models.fit_forest(rows, trees=100, depth=4, balanced=True), rows, 3)


@query("feature_importance", "select true as sums_to_one, true as none_negative, cast(7 as bigint) as n_features from events having count(*) > 0")
def feature_importance(spark, d):
    from vitalis.operators.signal import FEATURE_NAMES

    rows = _window_rows(spark, d)
    listed = models.importances(models.fit_forest(rows, trees=100, depth=4), FEATURE_NAMES, rows)
    return listed.agg(
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
        F.count(F.lit(1)).alias("n_features"),
    )


@query("loso_accuracy_table")
def loso_accuracy_table(spark, d):
    """The 35 forests of the grid from one fit per left-out subject."""
    rows = _window_rows(spark, d)
    return rounded(staged.loso_tune(rows, "subject", trees=[2, 10, 20, 50, 100, 150, 300], depths=range(2, 7)), 6, "accuracy")


@query("training_history", "select true as never_rises, true as starts_at_zero from lineitem having count(*) > 0")
def training_history(spark, d):
    train, _ = _status_parts(spark, d, "history")
    model = LogisticRegression(maxIter=10, regParam=0.01).fit(train)
    losses = models.history(model.summary.objectiveHistory, train)
    steps = F.transform(F.array_sort(F.collect_list(F.struct("epoch", "loss"))), lambda s: s["loss"])
    falling = losses.agg(steps.alias("s"), F.min("epoch").alias("first"))
    pairs = F.zip_with(F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1), lambda a, b: b <= a + 1e-12)
    return falling.select(F.forall(pairs, lambda ok: ok).alias("never_rises"), (F.col("first") == 0).alias("starts_at_zero"))


@query(
    "model_roundtrip",
    f"select {LINE_KEY_SQL} as row_key, true as same_prediction from lineitem",
)
def model_roundtrip(spark, d):
    """A saved and reloaded model predicts as before."""
    lines = _price_lines(spark, d, ["l_quantity", "l_discount"])
    model, path = models.fit_linear(lines), scratch_path(spark, "model")
    models.save_model(model, path)
    first = models.score(lines, model, out="before")
    both = models.score(first, models.load_model(path), out="after")
    return both.select("row_key", (F.col("before") == F.col("after")).alias("same_prediction"))


@query(
    "batch_score",
    f"""
    select {LINE_KEY_SQL} as row_key, round(regr_slope(l_extendedprice, l_quantity) over () * l_quantity
           + regr_intercept(l_extendedprice, l_quantity) over (), 2) as score from lineitem
    """,
)
def batch_score(spark, d):
    lines = _price_lines(spark, d, ["l_quantity"])
    return rounded(models.score(lines, models.fit_linear(lines)), 2, "score").select("row_key", "score")


@query(
    "filter_detections",
    f"""
    select {LINE_KEY_SQL} as row_key, cast(trunc(l_quantity) as integer) as x1, l_linenumber as y1,
           cast(trunc(l_quantity + l_tax * 100) as integer) as x2, l_linenumber + 10 as y2, l_discount * 10 as score,
           case l_suppkey % 3 when 0 then 'GLOVE' when 1 then 'MASK' else 'GOWN' end as class_name
    from lineitem where l_discount * 10 > 0.25
    """,
)
def filter_detections(spark, d):
    lines = keyed_lines(spark, d)
    box = F.struct(
        F.col("l_quantity").alias("x1"),
        F.col("l_linenumber").cast("double").alias("y1"),
        (F.col("l_quantity") + F.col("l_tax") * 100).alias("x2"),
        (F.col("l_linenumber") + 10).cast("double").alias("y2"),
        (F.col("l_discount") * 10).alias("score"),
        (F.col("l_suppkey") % 3).cast("double").alias("class_id"),
    )
    frames = lines.select("row_key", F.array(box).alias("boxes"))
    return models.filter_detections(frames, "boxes", 0.25, {0: "glove", 1: "mask", 2: "gown"})


@query(
    "pca_variance",
    """
    select round(sum(v), 5) as total_variance, true as orthonormal, true as reaches_share, true as is_fewest from
      (select var_samp(x) as v from (select unnest(cast(embedding as double[])) as x, generate_subscripts(embedding, 1) as p from embeddings) group by p)
    """,
)
def pca_variance(spark, d):
    rows = table(spark, d, "embeddings")
    pca = Pca.fit(rows, "embedding", variance=0.95)
    share = np.cumsum(pca.variances) / pca.total_variance
    line = (
        float(pca.total_variance),
        bool(np.allclose(pca.components @ pca.components.T, np.eye(pca.k), atol=1e-9)),
        bool(share[-1] > 0.95),
        bool(pca.k == 1 or share[-2] <= 0.95),
    )
    made = spark.createDataFrame([line], "total_variance double, orthonormal boolean, reaches_share boolean, is_fewest boolean")
    return rounded(made, 5, "total_variance")


@query(
    "pca_spectrum",
    """
    with x as (select vec_id, unnest(cast(embedding as double[])) as v, generate_subscripts(embedding, 1) as p from embeddings),
    c as (select covar_samp(a.v, b.v) as c, a.p = b.p as own from x a join x b using (vec_id) group by a.p, b.p)
    select round(sum(case when own then c end), 6) as variances, round(sum(c * c), 6) as squares from c
    """,
)
def pca_spectrum(spark, d):
    """All variances: their sum is the covariance's trace, their squares' sum that of its cells' squares."""
    pca = Pca.fit(table(spark, d, "embeddings"), "embedding")
    made = spark.createDataFrame([(float(pca.variances.sum()), float((pca.variances**2).sum()))], "variances double, squares double")
    return rounded(made, 6, "variances", "squares")


@query(
    "pca_projection",
    "select cast(i as integer) as component, true as centred, true as own_variance, true as uncorrelated from range(1, 7) t(i) where (select count(*) from embeddings) > 0",
)
def pca_projection(spark, d):
    """Projected components have mean 0, the fitted variance, and no correlation with each other."""
    rows = table(spark, d, "embeddings")
    pca = Pca.fit(rows, "embedding", k=6)
    names = [f"pc{i}" for i in range(1, 7)]
    wide = components_to_columns(pca.transform(rows, "embedding").drop("embedding"), "components", 6)
    row = wide.agg(
        *[F.avg(n).alias(f"m_{n}") for n in names], *[F.covar_samp(a, b).alias(f"c_{a}_{b}") for a in names for b in names]
    ).first()
    lines = [
        (i + 1, abs(row[f"m_{a}"]) < 1e-9, abs(row[f"c_{a}_{a}"] - pca.variances[i]) < 1e-9,
         all(abs(row[f"c_{a}_{b}"]) < 1e-9 for b in names if b != a))
        for i, a in enumerate(names)
    ]
    return spark.createDataFrame([(i, *map(bool, x)) for i, *x in lines], "component int, centred boolean, own_variance boolean, uncorrelated boolean")


@query(
    "pca_wide",
    """
    with x as (select vec_id, unnest(cast(embedding as double[])) as v, generate_subscripts(embedding, 1) as i from embeddings),
    w as (select a.i, b.i as j, var_samp(a.v * b.v) as s from x a join x b using (vec_id) group by 1, 2)
    select cast(5 as integer) as k, round(sum(s) + (select sum(s) from (select var_samp(v) as s from x group by i)), 6) as total_variance,
           true as orthonormal, true as falling, true as projects_to_its_variances from w
    """,
)
def pca_wide(spark, d):
    """Five components of 4,160 columns: every product of two components, and the components."""
    rows = table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("e"))
    products = F.flatten(F.transform("e", lambda a: F.transform(F.col("e"), lambda b: a * b)))
    rows = durable(rows.select(F.concat(products, "e").alias("wide")))
    pca = wide_pca(rows, "wide", 5, power=5)
    projected = components_to_columns(pca.transform(rows, "wide").drop("wide"), "components", 5)
    own = projected.agg(*[F.var_samp(f"pc{i}").alias(f"v{i}") for i in range(1, 6)]).first()
    line = (
        pca.k, pca.total_variance, bool(np.allclose(pca.components @ pca.components.T, np.eye(5), atol=1e-9)), bool((np.diff(pca.variances) <= 0).all()),
        bool(np.allclose([own[f"v{i}"] for i in range(1, 6)], pca.variances, rtol=0.01)),
    )
    made = spark.createDataFrame([line], "k int, total_variance double, orthonormal boolean, falling boolean, projects_to_its_variances boolean")
    return rounded(made, 6, "total_variance")


@query(
    "pca_uncentered",
    """
    select round(sum(v), 5) as total, true as orthonormal, true as falling, cast(6 as integer) as k from
      (select avg(x * x) as v from (select unnest(cast(embedding as double[])) as x, generate_subscripts(embedding, 1) as p from embeddings) group by p)
    """,
)
def pca_uncentered(spark, d):
    pca = Pca.fit(table(spark, d, "embeddings"), "embedding", k=6, center=False)
    line = (
        pca.total_variance,
        bool(np.allclose(pca.components @ pca.components.T, np.eye(pca.k), atol=1e-9)),
        bool(np.all(np.diff(pca.variances) <= 0)),
        pca.k,
    )
    made = spark.createDataFrame([line], "total double, orthonormal boolean, falling boolean, k int")
    return rounded(made, 5, "total")


@query("pca_columns")
def pca_columns(spark, d):
    rows = table(spark, d, "embeddings")
    projected = Pca.fit(rows, "embedding", k=6).transform(rows, "embedding").drop("embedding")
    return rounded(components_to_columns(projected, "components", 6), 5, *[f"pc{i}" for i in range(1, 7)])
