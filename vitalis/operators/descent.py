"""Models fitted by steps along gradients that tasks add up: candidates of a linear model under absolute loss, and a small network.

Rows stay where they are; a pass sends the current weights to the tasks and brings back sums of a few numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.session import durable

RATES = (0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.5, 1.0)
PENALTIES = (0.0, 1e-5, 1e-4, 1e-3)
TILE = 2048  # rows that go through a network at once


def _plain(df: DataFrame, features: str, label: str) -> DataFrame:
    """The rows with a label, written once as blocks of numbers, which every pass reads without a step per row."""
    rows = df.filter(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("x").flatten())
                yield pa.RecordBatch.from_pydict({"x": [x.tobytes()], "y": [np.asarray(batch.column("y")).tobytes()]})

    return durable(rows.mapInArrow(pack, "x binary, y binary"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of one block after the other, as they lie in the batches."""
    for batch in batches:
        for x, y in zip(batch.column("x"), batch.column("y")):
            y = np.frombuffer(y.as_buffer(), np.float64)
            yield np.frombuffer(x.as_buffer(), np.float64).reshape(len(y), -1), y


def _summed(rows: DataFrame, add) -> np.ndarray | None:
    """The sum over all blocks of an array that ``add`` makes of each; none without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(add(x, y) for x, y in _blocks(batches))
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "v"])

    found = {r.place: r.v for r in rows.mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()}
    return np.array([found[k] for k in range(len(found))]) if found else None


def _spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each component, the label last; a constant has deviation 1."""
    sums = _summed(rows, lambda x, y: np.array([*x.sum(axis=0), y.sum(), len(y)]))
    if sums is None:
        return np.zeros(0), np.zeros(0)
    mean = sums[:-1] / sums[-1]

    def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        d = np.hstack([x, y[:, None]]) - mean
        return np.concatenate([(d * d).sum(axis=0), (np.abs(d) > 1e-12 * np.abs(mean)).sum(axis=0)])

    squares, differ = np.split(_summed(rows, apart), 2)  # a constant differs from its mean by rounding only
    return mean, np.where((differ > 0) & (squares > 0), np.sqrt(squares / sums[-1]), 1.0)


@dataclass(frozen=True)
class LadCandidates:
    """Coefficients (candidate, component) and intercepts on the columns as they are, with their mean absolute errors on the validation rows."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    settings: list[tuple[float, float]]
    errors: np.ndarray

    @property
    def best(self) -> int:
        return int(self.errors.argmin())

    def table(self, df: DataFrame) -> DataFrame:
        rows = [(k, r, p, float(e), k == self.best) for k, ((r, p), e) in enumerate(zip(self.settings, self.errors))]
        return df.sparkSession.createDataFrame(rows, "model int, learning_rate double, penalty double, validation_error double, chosen boolean")


def lad_candidates(
    train: DataFrame, valid: DataFrame, features: str = "features", label: str = "label", rates: Sequence[float] = RATES,
    penalties: Sequence[float] = PENALTIES, epochs: int = 20, batch: int = 30,
) -> LadCandidates:
    """Every (learning rate, penalty) fitted under absolute loss, all in the same passes; the best on ``valid`` is chosen.

    An epoch is one pass: each task takes subgradient steps by batches of so many of its rows, from the weights of the
    epoch before, and the tasks' weights are averaged by their rows. Columns and label are standardised for the steps; rows without label are left out.
    """
    settings = list(product(rates, penalties))
    rows = _plain(train, features, label)
    mean, spread = _spread(rows)
    rate, penalty = (np.array(c) for c in zip(*settings))
    weights = np.zeros((len(mean), len(settings)))  # the intercept last

    def epoch(start: np.ndarray, number: int):
        step = rate / number**0.5
        kept = 1 - step * penalty

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, n = start.copy(), 0
            for x, y in _blocks(batches):
                x = np.hstack([(x - mean[:-1]) / spread[:-1], np.ones((len(x), 1))])
                y = (y - mean[-1]) / spread[-1]
                for k in range(0, len(y), batch):
                    part = x[k : k + batch]
                    side = part @ w
                    side -= y[k : k + batch, None]
                    slope = part.T @ np.sign(side, out=side)
                    slope *= step / len(part)
                    w *= kept
                    w -= slope
                n += len(y)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(w.size)), pa.array(w.ravel() * n), pa.array(np.full(w.size, n))], names=["place", "w", "n"])

        return run

    for number in range(1, epochs + 1):
        made = rows.mapInArrow(epoch(weights, number), "place long, w double, n long").groupBy("place").agg((F.sum("w") / F.sum("n")).alias("w"))
        for r in made.collect():  # components x candidates
            weights[r.place // len(settings), r.place % len(settings)] = r.w
    slopes = weights[:-1] / spread[:-1, None] * spread[-1]
    intercepts = weights[-1] * spread[-1] + mean[-1] - mean[:-1] @ slopes
    return LadCandidates(slopes.T, intercepts, settings, _absolute_errors(_plain(valid, features, label), slopes, intercepts))


def _absolute_errors(rows: DataFrame, slopes: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    found = _summed(rows, lambda x, y: np.append(np.abs(x @ slopes + intercepts - y[:, None]).sum(axis=0), len(y)))
    return np.full(len(intercepts), np.nan) if found is None else found[:-1] / found[-1]


@dataclass
class ReluNet:
    """Layers of weights (inputs + 1, outputs), the bias last; rectified between them, log-softmax at the end."""

    layers: list[np.ndarray]
    losses: list[float]

    @classmethod
    def start(cls, sizes: Sequence[int], seed: int = 42) -> "ReluNet":
        """Uniform weights within one over the root of a layer's inputs."""
        rng = np.random.default_rng(seed)
        return cls([rng.uniform(-1, 1, (a + 1, b)) / np.sqrt(a) for a, b in zip(sizes, sizes[1:])], [])

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log probabilities, and what went into each layer (a 1 for the bias included)."""
        inputs = []
        for k, w in enumerate(self.layers):
            inputs.append(np.hstack([x, np.ones((len(x), 1))]))
            x = inputs[-1] @ w
            if k + 1 < len(self.layers):
                x = np.maximum(x, 0)
        x = x - x.max(axis=1, keepdims=True)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True)), inputs

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Summed negative log likelihood of the labels, and its gradient by layer, back from the last one.

        Rows lie across, ``TILE`` at a time: what a tile needs stays in the cache, and no layer is copied for its bias.
        """
        loss, out = 0.0, [np.zeros_like(w) for w in self.layers]
        for k in range(0, len(y), TILE):
            truth = y[k : k + TILE]
            rows, inputs = np.arange(len(truth)), [np.ascontiguousarray(x[k : k + TILE].T)]
            for j, w in enumerate(self.layers):
                z = w[:-1].T @ inputs[-1]
                z += w[-1][:, None]
                if j + 1 < len(self.layers):
                    inputs.append(np.maximum(z, 0, out=z))
            z -= z.max(axis=0)
            back = np.exp(z)
            total = back.sum(axis=0)
            loss += float(np.log(total).sum() - z[truth, rows].sum())
            back /= total
            back[truth, rows] -= 1
            for j in range(len(self.layers) - 1, -1, -1):
                out[j][:-1] += inputs[j] @ back.T
                out[j][-1] += back.sum(axis=1)
                if j:
                    back = self.layers[j][:-1] @ back
                    back *= inputs[j] > 0
        return loss, out

    def transform(self, df: DataFrame, features: str = "features", out: str = "prediction") -> DataFrame:
        net = ReluNet(self.layers, [])

        @F.pandas_udf("double")
        def predict(rows):
            import pandas as pd

            return pd.Series(net.forward(np.stack(rows.to_numpy()))[0].argmax(axis=1).astype(float) if len(rows) else [], dtype=float)

        return df.withColumn(out, predict(vector_to_array(features)))


def fit_relu_net(
    df: DataFrame, sizes: Sequence[int], epochs: int = 100, rate: float = 0.001, features: str = "features", label: str = "label", seed: int = 42
) -> ReluNet:
    """Adam steps on the mean negative log likelihood of all rows; ``losses`` has that of every epoch before its step.

    An epoch is one pass that adds up as many numbers as the network has weights.
    """
    net, rows = ReluNet.start(sizes, seed), _plain(df, features, label)
    shapes = [w.shape for w in net.layers]
    size = sum(a * b for a, b in shapes)
    m, v = np.zeros(size), np.zeros(size)

    def summed(layers: list[np.ndarray]):
        now = ReluNet(layers, [])

        def add(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            loss, found = now.gradients(x, y.astype(np.int64))
            return np.concatenate([g.ravel() for g in found] + [[loss, len(y)]])

        return add

    for step in range(1, epochs + 1):
        got = _summed(rows, summed(net.layers))
        if got is None:
            return net  # no rows
        net.losses.append(got[-2] / got[-1])
        g = got[:-2] / got[-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        at = np.cumsum([0, *(a * b for a, b in shapes)])
        net.layers = [w - move[i:j].reshape(w.shape) for w, i, j in zip(net.layers, at, at[1:])]
    return net
