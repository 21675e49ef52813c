"""Regression and classification models, tuning and scoring on Spark ML.

Frames carry a ``features`` vector and a numeric ``label``; ``assemble`` and ``index_labels``
make them. Inputs of iterative fits should be persisted or written first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.operators.splits import balanced_weights, logo_frames
from vitalis.session import durable, spread


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """One vector column from numeric columns or one array column."""
    if len(columns) == 1 and dict(df.dtypes)[columns[0]].startswith("array"):
        return df.withColumn(out, array_to_vector(F.col(columns[0]).cast("array<double>")))
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def index_labels(df: DataFrame, column: str, levels: Sequence, out: str = "label") -> DataFrame:
    """Position of the value among the given levels, as the numeric label; an unknown value is an error."""
    place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(column))
    known = F.when(place > 0, place - 1).otherwise(F.raise_error(F.lit(f"{column} holds a value outside the levels")))
    return df.withColumn(out, known.cast("double"))


def fit_linear(df: DataFrame, **params) -> Model:
    """Ordinary least squares by the normal equations: one pass over the rows."""
    return LinearRegression(solver="normal", regParam=0.0, **params).fit(df)


def r2_score(model: Model, df: DataFrame) -> float:
    """R squared of the predictions on given rows."""
    scored = model.transform(df)
    row = scored.agg(
        F.avg((F.col("label") - F.col("prediction")) ** 2).alias("mse"), F.var_pop("label").alias("spread")
    ).first()
    return 1.0 - row["mse"] / row["spread"]


def mean_absolute_error(model: Model, df: DataFrame) -> float:
    return model.transform(df).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]


def fit_lad(df: DataFrame, iterations: int = 20, tolerance: float = 1e-4) -> Model:
    """Linear regression under absolute loss, by reweighting least squares with 1 / |residual|.

    Every step is one pass. The fit with the lowest absolute error is returned, so it is never
    worse than least squares, the first step.
    """
    best = model = fit_linear(df)
    best_error = error = mean_absolute_error(model, df)
    floor = max(error, 1e-12) * 1e-4
    for _ in range(iterations):
        residual = F.abs(F.col("label") - F.col("prediction"))
        weighted = model.transform(df).withColumn("_w", 1.0 / F.greatest(residual, F.lit(floor))).drop("prediction")
        model = fit_linear(weighted, weightCol="_w")
        new_error = mean_absolute_error(model, df)
        if new_error < best_error:
            best, best_error = model, new_error
        if abs(error - new_error) <= tolerance * error:
            break
        error = new_error
    return best


@dataclass(frozen=True)
class BinnedGbt:
    """Boosted trees over the bins of the features, grown on one weighted row per combination of bins and label."""

    model: Model
    cuts: tuple[tuple[float, ...], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(_with_bins(df, self.cuts)).drop("_bins")


def _with_bins(df: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``_bins``, per feature the number of cuts up to its value; NaN comes after all values."""
    values, places = ([f"_{name}{k}" for k in range(len(cuts))] for name in "xb")
    split = [[-np.inf, *(own or [0.0]), np.inf] for own in cuts]  # one value alone needs no cut, but the stage does
    x = vector_to_array("features")
    ready = df.withColumns({v: x[k] for k, v in enumerate(values)})
    binned = Bucketizer(splitsArray=split, inputCols=values, outputCols=places, handleInvalid="keep").transform(ready)
    return VectorAssembler(inputCols=places, outputCol="_bins").transform(binned).drop(*values, *places)


def _cuts(df: DataFrame, n_features: int, bins: int) -> tuple[tuple[float, ...], ...]:
    """Per feature the middles between its values if there are no more than ``bins``, else quantiles of all rows."""
    x = vector_to_array("features")
    columns = df.select(*(x[k].alias(f"x{k}") for k in range(n_features)))
    shares = [k / bins for k in range(1, bins)]
    found = columns.agg(
        *(F.percentile_approx(f"x{k}", shares, 10_000).alias(f"q{k}") for k in range(n_features)),
        *(F.approx_count_distinct(f"x{k}").alias(f"n{k}") for k in range(n_features)),
    ).first()
    cuts = []
    for k in range(n_features):
        own = []
        if found[f"n{k}"] <= 1.2 * bins:  # an estimate; the values themselves are counted next
            own = sorted(r[0] for r in columns.select(f"x{k}").distinct().limit(bins + 1).collect() if r[0] == r[0])
        few = 0 < len(own) <= bins
        cuts.append(tuple((a + b) / 2 for a, b in zip(own, own[1:])) if few else tuple(sorted(set(found[f"q{k}"] or []))))
    return tuple(cuts)


def fit_gbt(
    df: DataFrame, learning_rate: float = 0.1, rounds: int = 100, depth: int = 5, row_share: float = 1.0,
    column_share: float = 1.0, min_gain: float = 0.0, seed: int = 42, most_rows: int = 1_000_000,
) -> Model | BinnedGbt:
    """Gradient-boosted trees for a 0/1 label.

    Trees see features as 32 bins only, so rows that agree in all bins and the label have the same gradients in every
    round. Beyond ``most_rows`` rows each such combination becomes one row with their number as weight: the fit then reads
    no more than that many combinations, however many rows there are, and gives the trees of all rows. Its cuts are
    quantiles of all rows, where Spark's own come from a sample. Shares of rows are drawn by row, so they rule this out.
    """
    gbt = GBTClassifier(
        stepSize=learning_rate, maxIter=rounds, maxDepth=depth, subsamplingRate=row_share,
        featureSubsetStrategy="all" if column_share >= 1 else str(column_share), minInfoGain=min_gain, seed=seed,
    )
    if row_share < 1 or df.limit(most_rows + 1).count() <= most_rows:
        return gbt.fit(df)
    cuts = _cuts(df, len(df.select("features").first()[0]), gbt.getMaxBins())
    key = [F.col("label"), vector_to_array("_bins").alias("_key")]
    weighted = _with_bins(df.select("features", "label"), cuts).groupBy(*key).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    if weighted.count() > df.count() / 2:  # many features: hardly any rows agree
        return gbt.fit(df)
    rows = spread(durable(weighted.select("label", "_weight", array_to_vector("_key").alias("_bins"))))
    # more bins than any feature has: then Spark takes every bin's edge as a cut, from up to a million rows instead of a sample
    return BinnedGbt(gbt.setMaxBins(1024).setFeaturesCol("_bins").setWeightCol("_weight").fit(rows), cuts)


def linear_svc(c: float, n: int, **params) -> LinearSVC:
    """Linear-kernel support vector estimator with penalty ``c`` on ``n`` rows, on the columns as they are."""
    return LinearSVC(regParam=1.0 / (c * n), **{"standardization": False, **params})


def fit_linear_svc(df: DataFrame, c: float = 1.0, **params) -> Model:
    return linear_svc(c, df.count(), **params).fit(df)


def fourier_features(column: str, dim: int, gamma: float, n_features: int, seed: int = 11) -> Column:
    """Random cosine features whose inner products approximate exp(-gamma * |x - y|^2)."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((dim, n_features)) * np.sqrt(2 * gamma)
    phases = rng.uniform(0, 2 * np.pi, n_features)

    @F.pandas_udf("array<double>")
    def project(rows: pd.Series) -> pd.Series:
        x = np.stack(rows.to_numpy())
        return pd.Series(list(np.sqrt(2.0 / n_features) * np.cos(x @ directions + phases)))

    return array_to_vector(project(vector_to_array(column)))


@dataclass(frozen=True)
class RbfSvc:
    """RBF-kernel classifier: random cosine features under a linear one."""

    model: Model
    dim: int
    gamma: float
    n_features: int
    seed: int

    def transform(self, df: DataFrame) -> DataFrame:
        mapped = fourier_features("features", self.dim, self.gamma, self.n_features, self.seed)
        return self.model.transform(df.withColumn("_rff", mapped)).drop("_rff")


def fit_rbf_svc(
    df: DataFrame, dim: int, c: float = 1.0, gamma: float | None = None, n_features: int = 256, seed: int = 11, **params
) -> RbfSvc:
    gamma = gamma if gamma is not None else 1.0 / dim
    mapped = df.withColumn("_rff", fourier_features("features", dim, gamma, n_features, seed))
    model = linear_svc(c, df.count(), featuresCol="_rff", **params).fit(mapped)
    return RbfSvc(model, dim, gamma, n_features, seed)


def fit_logistic(df: DataFrame, c: float = 1.0, l1_ratio: float = 0.5, **params) -> Model:
    """Multinomial logistic regression with elastic net on unscaled features."""
    return LogisticRegression(
        family="multinomial", elasticNetParam=l1_ratio, regParam=1.0 / (c * df.count()), standardization=False, **params
    ).fit(df)


def fit_forest(
    df: DataFrame, trees: int = 100, depth: int = 4, balanced: bool = False, seed: int = 42, keep_nodes: bool = False
) -> Model:
    """Random forest; ``keep_nodes`` remembers each row's node in every tree between passes (4 bytes each) instead of
    walking all trees from their roots for every row in each pass. The forest is the same."""
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=keep_nodes)
    if not balanced:
        return forest.fit(df)
    return forest.setWeightCol("_weight").fit(balanced_weights(df.filter("label IS NOT NULL"), "label", "_weight"))


def fit_mlp(df: DataFrame, layers: Sequence[int], iterations: int = 100, seed: int = 42) -> Model:
    """Small feed-forward classifier."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=iterations, seed=seed).fit(df)


def grid_search(
    df: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], fold: str = "fold", folds: int = 5,
    parallelism: int = 4,
) -> tuple[Model, DataFrame]:
    """Fit every parameter combination on every fold; the best model refitted, and the table of scores.

    ``fold`` is a column of fold numbers (see ``splits.kfold``); the score is accuracy.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=builder.build(), numFolds=folds, foldCol=fold, parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), collectSubModels=False,
    )
    fitted = search.fit(df)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda x: x[0].name)), float(score))
        for params, score in zip(search.getEstimatorParamMaps(), fitted.avgMetrics)
    ]
    return fitted.bestModel, df.sparkSession.createDataFrame(rows, "params string, accuracy double")


def _fold_cells(train: DataFrame, test: DataFrame, fit: Callable[[DataFrame], Model]) -> list[tuple[int, int, int]]:
    """(truth, pred, n) of one fold: at most labels x labels cells, whatever the number of rows."""
    pairs = fit(train).transform(test).groupBy(F.col("label").cast("int"), F.col("prediction").cast("int")).count()
    return [tuple(r) for r in pairs.collect()]


def loso_confusion(
    df: DataFrame, group: str, n_labels: int, fit: Callable[[DataFrame], Model], parallelism: int = 8
) -> DataFrame:
    """Leave one group out, fit on the rest, predict it; the confusion matrix summed over the groups, which are fitted side by side."""
    cells: Counter = Counter()
    with ThreadPoolExecutor(parallelism) as pool:
        for fold in pool.map(lambda parts: _fold_cells(parts[1], parts[2], fit), logo_frames(df, group)):
            for truth, pred, n in fold:
                cells[truth, pred] += n
    rows = [(t, p, cells[t, p]) for t in range(n_labels) for p in range(n_labels)]
    return df.sparkSession.createDataFrame(rows, "truth int, pred int, n bigint")


def importances(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    rows = [(n, i, float(v)) for i, (n, v) in enumerate(zip(names, model.featureImportances.toArray()))]
    return df.sparkSession.createDataFrame(rows, "feature string, position int, importance double")


def history(losses: Sequence[float], df: DataFrame, name: str = "loss") -> DataFrame:
    """Table (epoch, loss) of a training history such as ``model.summary.objectiveHistory``."""
    rows = [(i, float(v)) for i, v in enumerate(losses)]
    return df.sparkSession.createDataFrame(rows, f"epoch int, {name} double")


def save_model(model, path: str) -> None:
    """Write a fitted model; a single stage is wrapped as a pipeline so one reader serves all."""
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    wrapped.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(df: DataFrame, model, field: str = "prediction", out: str = "score") -> DataFrame:
    """Batch scoring in the job: the model's field as a plain column next to the source columns."""
    scored = model.transform(df)
    value = vector_to_array(field) if dict(scored.dtypes)[field] == "vector" else F.col(field)
    return scored.select(*df.columns, value.alias(out))


def pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def filter_detections(df: DataFrame, boxes: str, threshold: float, names: Mapping[int, str]) -> DataFrame:
    """One row per detected box above the score threshold: whole coordinates, upper-case class name."""
    found = df.withColumn("_b", F.explode(boxes)).filter(F.col("_b.score") > threshold)
    name = None
    for k, v in names.items():
        hit = F.col("_b.class_id").cast("int") == k
        name = F.when(hit, v) if name is None else name.when(hit, v)
    kept = [c for c in df.columns if c != boxes]
    corners = [F.col(f"_b.{c}").cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")]
    return found.select(*kept, *corners, F.col("_b.score").alias("score"), F.upper(name).alias("class_name"))
