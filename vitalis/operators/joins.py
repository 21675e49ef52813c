"""Key-based attachment, ranked look-ups, unions and label partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach(df: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Add output columns to their source rows by key; rows without output stay."""
    return df.join(outputs, key, "left")


def top_k_per(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], k: int, out: str = "rank") -> DataFrame:
    """The first ``k`` rows per group with their rank.

    The rank filter is pushed below the shuffle, so each task sends at most ``k`` rows of a
    group. Without a group the global top is taken first and only ``k`` rows are numbered.
    """
    if not key:
        df = df.orderBy(*order).limit(k)
        window = Window.partitionBy(F.lit(0)).orderBy(*order)
    else:
        window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= k)


def lookup_ranked(hits: DataFrame, rows: DataFrame, hit_id: str, row_id: str) -> DataFrame:
    """The rows of the hits with rank and score, in rank order.

    ``hits`` holds k rows per query; whether it is broadcast is left to its measured size.
    """
    joined = rows.join(hits, F.col(row_id) == F.col(hit_id)).drop(hit_id)
    return joined.orderBy("rank")


def arg_best(df: DataFrame, metric: str, tie: Sequence[str]) -> DataFrame:
    """The row with the largest metric; the first by the tie key."""
    return df.orderBy(F.desc(metric), *tie).limit(1)


def top_features(scores: DataFrame, score: str, feature: str, n: int) -> DataFrame:
    """The ``n`` best features; of equal scores the later feature comes first."""
    return scores.orderBy(F.desc(score), F.desc(feature)).limit(n)


def union_splits(splits: Mapping[str, DataFrame]) -> DataFrame:
    """Stack splits by column name under a ``split`` column; duplicates stay."""
    stacked = None
    for name, df in splits.items():
        tagged = df.withColumn("split", F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    return stacked


def partition_by_label(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (row, matching rule): a row may belong to several named parts or to none."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn("split", F.explode(names))
