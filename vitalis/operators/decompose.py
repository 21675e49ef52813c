"""Principal components from a distributed Gram matrix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DIM = 4096
PILOT_ROWS = 100  # rows whose mean is taken off before products are summed; any value is right


def _gram(df: DataFrame, vector: str, dim: int, pilot: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, column sums and X'X of the rows less ``pilot``: each task adds up its rows.

    A pilot near the mean keeps the sums small, so that means far from zero don't cancel the variance.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a leading 1 puts count and sums into the same matrix
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            if not all(n in (None, dim) for n in pc.unique(pc.list_value_length(batch.column(0))).to_pylist()):
                raise ValueError(f"all vectors must have {dim} components")
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) - pilot
            x = np.hstack([np.ones((len(x), 1)), x])
            total += x.T @ x
        i, j = np.triu_indices(dim + 1)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    cells = df.select(vector).mapInArrow(add_up, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = cells.toArrow()
    full = np.zeros((dim + 1, dim + 1))
    i, j, v = (rows[c].to_numpy() for c in ("i", "j", "v"))
    full[i, j] = v
    full[j, i] = v
    return int(round(full[0, 0])), full[0, 1:], full[1:, 1:]


@dataclass(frozen=True)
class Pca:
    """Components (one per row), their variances, the total variance and the centre."""

    components: np.ndarray
    variances: np.ndarray
    total_variance: float
    centre: np.ndarray

    @classmethod
    def fit(cls, df: DataFrame, vector: str, variance: float | None = None, k: int | None = None, center: bool = True) -> Pca:
        """Keep ``k`` components, or the fewest whose variance share exceeds ``variance``.

        Without centring the components are the right singular vectors of the rows themselves.
        """
        dim = df.select(F.max(F.size(vector))).first()[0]
        if dim > MAX_DIM:
            raise ValueError(f"{dim} columns exceed {MAX_DIM}")
        pilot = np.zeros(dim)
        if center:
            some = df.select(vector).filter(F.col(vector).isNotNull()).limit(PILOT_ROWS).toArrow()[vector]
            pilot = some.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim).mean(axis=0)
        n, sums, gram = _gram(df, vector, dim, pilot)
        off = sums / n if center else np.zeros(dim)
        centre = pilot + off
        spread = (gram - n * np.outer(off, off)) / ((n - 1) if center else n)
        values, vectors = np.linalg.eigh(spread)
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1].T
        total = float(values.sum())
        if k is None:
            k = int(np.searchsorted(np.cumsum(values) / total, variance, side="right")) + 1 if variance else dim
        k = min(k, dim)
        signs = np.sign(vectors[np.arange(dim), np.abs(vectors).argmax(axis=1)])  # largest part positive
        return cls(vectors[:k] * signs[:k, None], values[:k], total, centre)

    @property
    def k(self) -> int:
        return len(self.components)

    def transform(self, df: DataFrame, vector: str, out: str = "components") -> DataFrame:
        axes, centre = self.components.T, self.centre

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            return pd.Series(list((np.stack(rows.to_numpy()).astype(np.float64) - centre) @ axes))

        return df.withColumn(out, project(vector))


def components_to_columns(df: DataFrame, vector: str, k: int, prefix: str = "pc") -> DataFrame:
    """Each component as a column of its own."""
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, *[F.col(vector)[i].alias(f"{prefix}{i + 1}") for i in range(k)])
