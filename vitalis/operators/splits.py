"""Repeatable train/test splits and cross-validation folds.

All of them follow the md5 order of a row key and a seed, so the result does not depend on
partitioning, engine or restart.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.plans import ranks
from vitalis.session import travelling

BUCKETS = 10000


def split(df: DataFrame, key: Sequence[str], fractions: Mapping[str, float], seed: str, out: str = "split") -> DataFrame:
    """Assign each row to a named part by its hash bucket; needs no shuffle.

    Fractions must sum to 1 or less; what is left over becomes null.
    """
    if sum(fractions.values()) > 1 + 1e-9:
        raise ValueError("fractions exceed 1")
    bucket = ranks.hash_fraction_bucket(ranks.hash_key(key, seed), BUCKETS)
    edge, name = 0, None
    for part, share in fractions.items():
        edge += round(share * BUCKETS)
        name = F.when(bucket < edge, part) if name is None else name.when(bucket < edge, part)
    return df.withColumn(out, name)


def split_stratified(
    df: DataFrame, key: Sequence[str], label: str, test_fraction: float, seed: str, out: str = "split"
) -> DataFrame:
    """Exactly ``round(fraction * n)`` test rows within each class (rows of equal key stay together).

    Only the digest at each class's boundary is looked for; the rows themselves don't move.
    """
    size = F.floor(F.lit(float(test_fraction)) * F.col("group_total") + 0.5)
    edges = ranks.hash_edges(df, [label], key, seed, {"_edge": size}).withColumnRenamed(label, "_class")
    joined = df.join(travelling(edges), F.col(label).eqNullSafe(F.col("_class")), "left")
    in_test = F.coalesce(ranks.hash_key(key, seed) <= F.col("_edge"), F.lit(False))
    return joined.withColumn(out, F.when(in_test, "test").otherwise("train")).drop("_class", "_edge")


def split_counts(
    df: DataFrame, key: Sequence[str], sizes: Mapping[str, int | float | None], seed: str, out: str = "split"
) -> DataFrame:
    """Cut the md5 order by sizes: a fraction of all rows, a row count, or ``None`` for the rest.

    Only the digests at the boundaries are looked for; the rows themselves don't move.
    """
    n = F.col("group_total")
    edge, edges, rest = F.lit(0).cast("bigint"), {}, None
    for i, (part, size) in enumerate(sizes.items()):
        if size is None:
            rest = part
            break
        edge = F.least(edge + (F.floor(F.lit(size) * n) if isinstance(size, float) else F.lit(size)), n)
        edges[f"_edge{i}"] = (part, edge)
    if not edges:
        return df.withColumn(out, F.lit(rest))
    found = ranks.hash_edges(df, [], key, seed, {c: e for c, (_, e) in edges.items()})
    digest, name = ranks.hash_key(key, seed), None
    for c, (part, _) in edges.items():
        hit = F.coalesce(digest <= F.col(c), F.lit(False))
        name = F.when(hit, part) if name is None else name.when(hit, part)
    joined = df.join(F.broadcast(found), F.lit(True))  # one row
    return joined.withColumn(out, name.otherwise(F.lit(rest))).drop(*edges)


def kfold(df: DataFrame, key: Sequence[str], label: str, k: int, seed: str, out: str = "fold") -> DataFrame:
    """Stratified fold number 0..k-1: the classes are dealt round to the folds."""
    ranked = ranks.hash_rank(df, [label], key, seed, "_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "group_total")


def logo_folds(df: DataFrame, group: str) -> DataFrame:
    """Leave-one-group-out folds: per held-out group its test and train row counts.

    A row is test in the fold of its own group and train in every other one, so the folds need
    no copy of the rows; ``logo_frames`` gives the two sides of each.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_test"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return sizes.withColumn("n_train", total - F.col("n_test"))


def logo_frames(df: DataFrame, group: str) -> Iterator[tuple[object, DataFrame, DataFrame]]:
    """(held-out group, train rows, test rows) for each group; the names stream to the driver."""
    for (held_out,) in df.select(group).filter(F.col(group).isNotNull()).distinct().orderBy(group).toLocalIterator():
        yield held_out, df.filter(F.col(group) != F.lit(held_out)), df.filter(F.col(group) == F.lit(held_out))


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight N / (K * n_c) per row, so that all classes weigh the same; null for a null label."""
    known = df.filter(F.col(label).isNotNull())
    counts = travelling(known.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n_c")))
    totals = counts.agg(F.struct(F.sum("_n_c").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    joined = df.join(counts, F.col(label) == F.col("_label"), "left")
    return joined.withColumn(out, totals["n"] / (totals["k"] * F.col("_n_c"))).drop("_n_c", "_label")
