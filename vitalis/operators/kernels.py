"""Support vector classifiers with kernels: a Nystroem map under linear machines, many of them fitted side by side.

Landmark rows span the kernel's feature space: phi(x) = K(x, landmarks) W with W the inverse root of the landmarks' own
kernel block, so that phi(x).phi(y) equals K(x, y) where x or y is a landmark and is near it elsewhere. Penalties, kernels and
folds are fitted together: a Newton step of all machines is one pass that adds up gradients and curvatures, summed and solved
in one group per machine, and one pass that compares step lengths. The hinge is rounded off over a width that shrinks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.session import configured, durable

STEPS = np.array([1.0, 0.5, 0.2, 0.05, 0.01])
WIDTHS = (1.0, 0.3, 0.1)  # of the rounded part of the hinge, one after the other


@dataclass(frozen=True)
class Machine:
    """One classifier to fit; ``held_out`` is the fold it doesn't see, -1 for none."""

    c: float = 1.0
    gamma: float = 1.0
    kernel: str = "rbf"
    held_out: int = -1


def kernel_block(x: np.ndarray, y: np.ndarray, kernel: str, gamma: float) -> np.ndarray:
    if kernel == "linear":
        return x @ y.T
    far = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(far, 0))


class Nystroem:
    """The map of one kernel, ending in a constant 1 for the intercept. The linear kernel needs no landmarks."""

    def __init__(self, landmarks: np.ndarray, kernel: str, gamma: float) -> None:
        self.landmarks, self.kernel, self.gamma = landmarks, kernel, gamma
        if kernel == "rbf":
            values, vectors = np.linalg.eigh(kernel_block(landmarks, landmarks, kernel, gamma))
            kept = values > 1e-9 * values.max(initial=1.0)
            self.white = vectors[:, kept] / np.sqrt(values[kept])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        phi = x if self.kernel == "linear" else kernel_block(x, self.landmarks, self.kernel, self.gamma) @ self.white
        return np.hstack([phi, np.ones((len(x), 1))])


def landmarks_of(df: DataFrame, features: str, n: int, seed: int = 7) -> np.ndarray:
    """``n`` distinct rows, those of the smallest seeded hash (all, if fewer)."""
    x = df.select(vector_to_array(features).alias("x")).filter(F.col("x").isNotNull())
    least = x.withColumn("h", F.xxhash64("x", F.lit(seed))).dropDuplicates(["h"]).orderBy("h").limit(n)
    return np.array([r.x for r in least.collect()], dtype=float)  # n rows


def hinge(z: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rounded hinge max(0, 1 - z), its first and second derivative."""
    lack = 1 - z
    inside, below = (lack > 0) & (lack <= width), lack > width
    value = np.where(below, lack - width / 2, np.where(inside, lack * lack / (2 * width), 0.0))
    return value, -np.where(below, 1.0, np.where(inside, lack / width, 0.0)), inside / width


def _batches(batches: Iterator[pa.RecordBatch], maps: Mapping):
    """(sign of the label, fold, {kernel: phi}) of each slice of rows."""
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
            y = np.where(np.asarray(batch.column("label")) == 1, 1.0, -1.0)
            yield y, np.asarray(batch.column("fold")), {k: m(x) for k, m in maps.items()}


def _curvatures(machines: list[Machine], maps: Mapping, weights: list[np.ndarray], width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for y, fold, phis in _batches(batches, maps):
            for m, machine in enumerate(machines):
                if weights[m] is None:
                    continue
                seen = fold != machine.held_out
                phi, sign = phis[machine.kernel, machine.gamma][seen], y[seen]
                _, slope, bend = hinge(sign * (phi @ weights[m]), width)
                inside = bend > 0
                g, h = phi.T @ (slope * sign), phi[inside].T @ phi[inside] / width
                if m in sums:
                    sums[m][0] += g
                    sums[m][1] += h
                else:
                    sums[m] = [g, h]
        rows = [(m, np.concatenate([g, h.ravel()]).tobytes()) for m, (g, h) in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["model", "sums"])

    return run


def _solved(machines: list[Machine], weights: list[np.ndarray]):
    """The Newton step of one machine from what the tasks found."""

    def run(table: pa.Table) -> pa.Table:
        m = table["model"][0].as_py()
        total, w, c = sum(np.frombuffer(s, "<f8") for s in table["sums"].to_pylist()), weights[m], machines[m].c
        penalty = np.r_[np.ones(len(w) - 1), 1e-8]  # the intercept is hardly held
        gradient = penalty * w + c * total[: len(w)]
        curvature = np.diag(penalty) + c * total[len(w) :].reshape(len(w), -1)
        curvature[-1, -1] += 0.1 * abs(gradient[-1])  # no leaps of the intercept where no row bends
        step = -np.linalg.solve(curvature, gradient)
        return pa.table([pa.array([m], pa.int32()), pa.array([step.tobytes()], pa.binary())], names=["model", "step"])

    return run


def _losses(machines: list[Machine], maps: Mapping, weights: list, steps: list, width: float):
    """Sums of the rounded hinge at the weights and at every step length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(machines), 1 + len(STEPS)))
        for y, fold, phis in _batches(batches, maps):
            for m, machine in enumerate(machines):
                if weights[m] is None:
                    continue
                seen = fold != machine.held_out
                phi, sign = phis[machine.kernel, machine.gamma][seen], y[seen][:, None]
                at = (phi @ weights[m])[:, None] + (phi @ steps[m])[:, None] * np.r_[0.0, STEPS]
                total[m] += hinge(sign * at, width)[0].sum(axis=0)
        for k in range(total.shape[1]):
            names = ["model", "k", "loss"]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(machines)), pa.int32()), pa.array(np.full(len(machines), k), pa.int32()), pa.array(total[:, k])], names=names)

    return run


def plain_rows(df: DataFrame, features: str, label: str, fold: str | None) -> DataFrame:
    """(x, label, fold) of the labelled rows, written once for all passes."""
    fold = F.col(fold).cast("int") if fold else F.lit(-2)
    rows = df.filter(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("label"), fold.alias("fold"))
    return durable(rows)


def fit_machines(rows: DataFrame, machines: Sequence[Machine], landmarks: np.ndarray, rounds: int = 10, tolerance: float = 1e-4) -> list[np.ndarray]:
    """Weights of all machines on ``plain_rows``; each step is two passes, whatever their number.

    A machine stops once no step length lowers its objective by more than ``tolerance`` of it. A task's sums are
    landmarks^2 numbers a machine.
    """
    machines, spark = list(machines), rows.sparkSession
    maps = {(m.kernel, m.gamma): Nystroem(landmarks, m.kernel, m.gamma) for m in machines}
    sizes = {k: m(landmarks[:1]).shape[1] for k, m in maps.items()} if len(landmarks) else {}
    weights = [np.zeros(sizes.get((m.kernel, m.gamma), 1)) for m in machines]
    groups = str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(4, len(machines) // 64)))
    with configured(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=groups):
        for width in WIDTHS:
            active = [True] * len(machines)
            for _ in range(rounds):
                now = [w if a else None for w, a in zip(weights, active)]
                made = rows.mapInArrow(_curvatures(machines, maps, now, width), "model int, sums binary")
                solved = made.groupBy("model").applyInArrow(_solved(machines, now), "model int, step binary").collect()  # a row per machine
                steps = [None] * len(machines)
                for r in solved:
                    steps[r.model] = np.frombuffer(r.step, "<f8")
                now = [w if s is not None else None for w, s in zip(now, steps)]
                made = rows.mapInArrow(_losses(machines, maps, now, steps, width), "model int, k int, loss double")
                losses = np.zeros((len(machines), 1 + len(STEPS)))
                for r in made.groupBy("model", "k").agg(F.sum("loss").alias("loss")).collect():
                    losses[r.model, r.k] = r.loss
                for m, w in enumerate(now):
                    if w is None:
                        active[m] = False
                        continue
                    tried = [w, *(w + t * steps[m] for t in STEPS)]
                    cost = [0.5 * (v[:-1] @ v[:-1]) + machines[m].c * loss for v, loss in zip(tried, losses[m])]
                    best = int(np.argmin(cost))
                    active[m] = best > 0 and cost[0] - cost[best] > tolerance * max(cost[0], 1e-12)
                    weights[m] = tried[best]
                if not any(active):
                    break
    return weights


def _right(rows: DataFrame, machines: list[Machine], landmarks: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
    """(machine, 2): right predictions and rows of its held-out fold."""
    maps = {(m.kernel, m.gamma): Nystroem(landmarks, m.kernel, m.gamma) for m in machines}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(machines), 2), dtype=np.int64)
        for y, fold, phis in _batches(batches, maps):
            for m, machine in enumerate(machines):
                own = fold == machine.held_out
                hit = (phis[machine.kernel, machine.gamma][own] @ weights[m] > 0) == (y[own] > 0)
                total[m] += hit.sum(), own.sum()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (np.arange(len(machines)), *total.T)], names=["model", "hits", "n"])

    counted = rows.mapInArrow(run, "model long, hits long, n long").groupBy("model").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    out = np.zeros((len(machines), 2), dtype=np.int64)
    for r in counted.collect():
        out[r.model] = r.hits, r.n
    return out


class _SvcParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    C = Param(Params._dummy(), "C", "penalty on margins", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "width of the rbf kernel", TypeConverters.toFloat)
    kernel = Param(Params._dummy(), "kernel", "rbf or linear", TypeConverters.toString)
    landmarks = Param(Params._dummy(), "landmarks", "rows that span the kernel's feature space", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(C=1.0, gamma=1.0, kernel="rbf", landmarks=100)

    def machine(self) -> Machine:
        return Machine(self.getOrDefault("C"), self.getOrDefault("gamma"), self.getOrDefault("kernel"))


class KernelSvc(Estimator, _SvcParams, DefaultParamsReadable, DefaultParamsWritable):
    """A kernel classifier for a 0/1 label that pipelines and Spark's own searches can take."""

    @keyword_only
    def __init__(self, *, C=1.0, gamma=1.0, kernel="rbf", landmarks=100, featuresCol="features", labelCol="label", predictionCol="prediction") -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "KernelSvcModel":
        features = self.getFeaturesCol()
        rows = plain_rows(df, features, self.getLabelCol(), None)
        points = landmarks_of(df, features, self.getOrDefault("landmarks"))
        (weights,) = fit_machines(rows, [self.machine()], points)
        return self._copyValues(KernelSvcModel(points, weights))


class KernelSvcModel(Model, _SvcParams, MLWritable, MLReadable):
    """Landmarks and weights; ``transform`` adds the margin and the predicted label."""

    def __init__(self, points: np.ndarray | None = None, weights: np.ndarray | None = None) -> None:
        super().__init__()
        self.points, self.weights = points, weights

    def _transform(self, df: DataFrame) -> DataFrame:
        machine, points, weights = self.machine(), self.points, self.weights
        phi = Nystroem(points, machine.kernel, machine.gamma)

        @F.pandas_udf("double")
        def margin(rows):
            import pandas as pd

            return pd.Series(phi(np.stack(rows.to_numpy())) @ weights if len(rows) else [], dtype=float)

        raw = self.getOrDefault("rawPredictionCol")
        scored = df.withColumn(raw, margin(vector_to_array(self.getFeaturesCol())))
        return scored.withColumn(self.getPredictionCol(), (F.col(raw) > 0).cast("double"))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, instance: KernelSvcModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark, model = self.sparkSession, self.instance
        DefaultParamsWriter.saveMetadata(model, path, spark)
        lines = [("weights", [float(w) for w in model.weights]), *(("landmark", [float(v) for v in p]) for p in model.points)]
        spark.createDataFrame([(k, *line) for k, line in enumerate(lines)], "place int, kind string, numbers array<double>").coalesce(1).write.parquet(f"{path}/data")


class _ModelReader(MLReader):
    def load(self, path: str) -> KernelSvcModel:
        spark = self.sparkSession
        lines = spark.read.parquet(f"{path}/data").orderBy("place").collect()  # landmarks + 1 rows
        model = KernelSvcModel(np.array([r.numbers for r in lines[1:]]), np.array(lines[0].numbers))
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def svc_grid(
    df: DataFrame, fold: str, folds: int, grid: Mapping[str, Sequence], landmarks: int = 100, features: str = "features", label: str = "label",
) -> tuple[KernelSvcModel, DataFrame]:
    """Mean accuracy over the folds of every combination of ``c``, ``gamma`` and ``kernel``, and the best one fitted on all rows.

    Combinations that differ only in a gamma the linear kernel doesn't have are fitted once; ties go to the earlier one.
    """
    names = list(grid)
    combos = [replace(Machine(), **dict(zip(names, values))) for values in product(*grid.values())]
    distinct = {m: None for c in combos for f in (*range(folds), -1) for m in [_bare(replace(c, held_out=f))]}
    machines = list(distinct)
    rows, points = plain_rows(df, features, label, fold), landmarks_of(df, features, landmarks)
    weights = fit_machines(rows, machines, points)
    right = dict(zip(machines, _right(rows, machines, points, weights)))
    lines = []
    for c in combos:
        own = [right[_bare(replace(c, held_out=f))] for f in range(folds)]
        lines.append((float(c.c), float(c.gamma), c.kernel, float(np.mean([h / max(n, 1) for h, n in own]))))
    best = combos[int(np.argmax([r[3] for r in lines]))]
    model = KernelSvcModel(points, weights[machines.index(_bare(best))])
    model._set(C=float(best.c), gamma=float(best.gamma), kernel=best.kernel, landmarks=landmarks, featuresCol=features)
    return model, df.sparkSession.createDataFrame(lines, "C double, gamma double, kernel string, accuracy double")


def _bare(m: Machine) -> Machine:
    return replace(m, gamma=0.0) if m.kernel == "linear" else m
