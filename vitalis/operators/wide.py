"""Principal components of very wide rows (flattened pictures) by a randomised range finder with a tree of QR factors.

No matrix of columns x columns exists. A random block of directions is pulled through the rows; the triangular factor
of the result comes from a tree of QR steps over the tasks, so its orthonormal rows need never be gathered. What is
kept are ``size`` directions of as many components as rows have columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.operators.decompose import Pca

MAX_BYTES = 512 << 20  # of the directions, which travel to the tasks and back
COLUMNS = 8192  # of a block of column sums


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    x = batch.column(0)
    x = x.filter(x.is_valid())
    flat = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(x) * dim:
        raise ValueError(f"all vectors must have {dim} components")
    return flat.reshape(-1, dim)


def _summed(df: DataFrame, vector: str, dim: int, height: int, pull) -> np.ndarray:
    """Sum over all rows of ``pull(rows)``, a (height, dim) matrix, in blocks of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, dim))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                x = _rows(batch.slice(k, 256), dim)
                if len(x):
                    total += pull(x)
        for start in range(0, dim, COLUMNS):
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([total[:, start : start + COLUMNS].tobytes()], pa.binary())], names=["start", "m"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:  # one task's block at a time
            for m in batch.column("m"):
                own = np.frombuffer(m.as_buffer(), "<f8")
                total = own.copy() if total is None else total + own
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["start", "m"])

    made = df.select(vector).mapInArrow(run, "start long, m binary").groupBy("start").applyInArrow(add, "start long, m binary")
    out = np.zeros((height, dim))
    for r in made.toLocalIterator():
        own = np.frombuffer(bytes(r.m), "<f8").reshape(height, -1)
        out[:, r.start : r.start + own.shape[1]] = own
    return out


def tree_qr(df: DataFrame, vector: str, dim: int, size: int, pull) -> np.ndarray:
    """The triangular factor of ``pull(rows)`` (rows x size) over all rows: QR in each task, then of stacked factors in groups, then once more."""

    def factor(parts: list[np.ndarray]) -> bytes:
        return np.linalg.qr(np.vstack(parts), mode="r").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.zeros((0, size))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                x = _rows(batch.slice(k, 256), dim)
                if len(x):
                    now = np.linalg.qr(np.vstack([now, pull(x)]), mode="r")
        if len(now):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([now.tobytes()], pa.binary())], names=["task", "r"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = np.zeros((0, size))
        for batch in batches:
            for r in batch.column("r"):
                now = np.linalg.qr(np.vstack([now, np.frombuffer(r.as_buffer(), "<f8").reshape(-1, size)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([now.tobytes()], pa.binary())], names=["task", "r"])

    groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df.select(vector).mapInArrow(run, "task long, r binary")
    found = leaves.groupBy(F.pmod("task", F.lit(groups))).applyInArrow(merge, "task long, r binary").collect()  # a factor per group
    parts = [np.frombuffer(bytes(r.r), "<f8").reshape(-1, size) for r in found]
    return np.frombuffer(factor(parts), "<f8").reshape(-1, size) if parts else np.zeros((0, size))


def wide_pca(df: DataFrame, vector: str, k: int, oversample: int = 10, power: int = 2, center: bool = True, seed: int = 5) -> Pca:
    """``k`` components of rows of any width, with their variances; ``total_variance`` is exact.

    Each of ``power`` rounds pulls the directions through the rows and back, which sharpens them where variances
    fall slowly; a round is two passes. Rows without a vector are left out. Work arrays are (k + oversample) x columns, at most ``MAX_BYTES``.
    """
    df = df.filter(F.col(vector).isNotNull())
    n, dim = df.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    if not n:
        raise ValueError("no rows")
    size = min(k + oversample, dim, n)
    if size * dim * 8 > MAX_BYTES:
        raise ValueError(f"{size} directions of {dim} columns exceed {MAX_BYTES} bytes")
    moments = _summed(df, vector, dim, 2, lambda x: np.stack([x.sum(axis=0), np.zeros(dim)])) if center else np.zeros((2, dim))
    mean = moments[0] / n
    squares = _summed(df, vector, dim, 1, lambda x: ((x - mean) ** 2).sum(axis=0)[None])[0]
    base = (n - 1) if center and n > 1 else n
    directions = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, size)))[0]
    for step in range(power + 1):
        now = directions
        r = tree_qr(df, vector, dim, size, lambda x: (x - mean) @ now)
        inverse = np.linalg.pinv(r)
        back = _summed(df, vector, dim, size, lambda x: ((x - mean) @ now @ inverse).T @ (x - mean))
        if step < power:
            directions = np.linalg.qr(back.T)[0]
    _, values, axes = np.linalg.svd(back, full_matrices=False)
    k = min(k, len(values))
    signs = np.sign(axes[np.arange(k), np.abs(axes[:k]).argmax(axis=1)])  # largest part positive, as in Pca
    return Pca(axes[:k] * signs[:, None], values[:k] ** 2 / base, float(squares.sum() / base), mean)
