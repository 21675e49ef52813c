"""Column scaling fitted by one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StdScale:
    """Standard scaling with the population deviation; a constant column becomes 0."""

    mean: dict[str, float]
    std: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> StdScale:
        row = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        return cls(
            {c: row[f"m{i}"] for i, c in enumerate(columns)},
            {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)},
        )

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns({c + suffix: (F.col(c) - F.lit(m)) / F.lit(self.std[c]) for c, m in self.mean.items()})

    def inverse(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """Undo the scaling: ``columns`` maps a scaled column to the fitted column it belongs to."""
        return df.withColumns({c: F.col(c) * F.lit(self.std[f]) + F.lit(self.mean[f]) for c, f in columns.items()})


def minmax(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Scale to [0, 1] by the frame's own extremes, or by those of ``fitted_on``.

    A constant column has no range and gives null.
    """
    source = fitted_on if fitted_on is not None else df
    row = source.agg(
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        flat = lo is None or hi == lo
        scaled[c] = F.lit(None).cast("double") if flat else (F.col(c) - F.lit(lo)) / F.lit(float(hi - lo))
    return df.withColumns(scaled)
