"""Column profiles and the data behind descriptive plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.functions.stats import pearson
from vitalis.operators.project import numeric_columns
from vitalis.plans import ranks
from vitalis.session import travelling


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def _missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return c.isNull() | F.isnan(c) if _is_float(df, column) else c.isNull()


def _present(df: DataFrame, column: str) -> Column:
    """The column with NaN turned into null, so that aggregates skip it."""
    return F.nanvl(F.col(column), F.lit(None).cast("double")) if _is_float(df, column) else F.col(column)


def _tall(row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn one wide aggregate row into a row per profiled column."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        *[F.col(f"{i}_{k}").cast(t).alias(k) for k, t in fields.items()],
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


def null_counts(df: DataFrame) -> DataFrame:
    aggs = [F.count_if(_missing(df, c)).alias(f"{i}_n_missing") for i, c in enumerate(df.columns)]
    return _tall(df.agg(*aggs), df.columns, {"n_missing": "bigint"})


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows and non-missing rows."""
    aggs = []
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.lit(1)).alias(f"{i}_n_rows"), F.count_if(~_missing(df, c)).alias(f"{i}_n_present")]
    tall = _tall(df.agg(*aggs), df.columns, {"n_rows": "bigint", "n_present": "bigint"})
    types = dict(df.dtypes)
    kind = None
    for c, t in types.items():
        hit = F.col("column_name") == c
        kind = F.when(hit, t) if kind is None else kind.when(hit, t)
    return tall.withColumn("column_type", kind)


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of numeric columns."""
    columns = list(columns) if columns else numeric_columns(df)
    aggs = []
    for i, c in enumerate(columns):
        v = _present(df, c)
        aggs += [
            F.count(v).alias(f"{i}_n"),
            F.avg(v).alias(f"{i}_mean"),
            F.stddev_samp(v).alias(f"{i}_std"),
            F.min(v).alias(f"{i}_min"),
            F.max(v).alias(f"{i}_max"),
        ]
    moments = _tall(
        df.agg(*aggs),
        columns,
        {"n": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"},
    )
    quartiles = ranks.exact_quantiles(df, [], columns, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    return moments.join(quartiles.withColumnRenamed("metric", "column_name"), "column_name", "left")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values with the order value at which each first appears."""
    return df.groupBy(column).agg(F.min(order).alias("first_seen"))


def group_mean(df: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Mean of every numeric column per group."""
    skip = {*keys, *exclude}
    return df.groupBy(*keys).agg(*[F.avg(_present(df, c)).alias(c) for c in numeric_columns(df) if c not in skip])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def crosstab_wide(df: DataFrame, row: str, column: str, levels: Sequence) -> DataFrame:
    """Counts per (row, column), one output column per level, missing pairs 0.

    Counts are conditional sums, so one aggregation gives the wide table.
    """
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{column}_{v}") for v in levels]
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs, from one aggregation; (x, y, r), both triangles."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        *[pearson(_present(df, a), _present(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*cells)))


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int, weight: Column | None = None
) -> DataFrame:
    """Equal-width counts (or weight sums) of several columns; the last bin is closed.

    One pass finds all extremes, one pass counts. Empty bins are kept with 0.
    """
    columns = list(columns)
    extremes = df.agg(
        *[f(_present(df, c)).cast("double").alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    cells, frames = [], []
    for i, c in enumerate(columns):
        lo, hi = extremes[f"lo{i}"], extremes[f"hi{i}"]
        if lo is None:
            continue
        if hi == lo:  # a constant column gets a unit-wide frame around its value
            lo, hi = lo - 0.5, hi + 0.5
        width = (hi - lo) / bins
        position = F.floor((_present(df, c).cast("double") - F.lit(lo)) / F.lit(width))
        index = F.when(position >= bins, bins - 1).otherwise(position).cast("int")  # a null stays null
        cells.append(F.struct(F.lit(c).alias("column_name"), index.alias("bin")))
        frames.append((c, lo, width))
    measure = weight if weight is not None else F.lit(1).cast("bigint")
    counted = (
        df.select(measure.alias("_w"), F.inline(F.array(*cells)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column_name", "bin")
        .agg(F.sum("_w").alias("n"))
    )
    spark = df.sparkSession
    grid = spark.createDataFrame(
        [(c, b, lo + b * w, lo + (b + 1) * w) for c, lo, w in frames for b in range(bins)],
        "column_name string, bin int, left_edge double, right_edge double",
    )
    kind = counted.schema["n"].dataType
    return grid.join(counted, ["column_name", "bin"], "left").withColumn(
        "n", F.coalesce(F.col("n"), F.lit(0).cast(kind))
    )


def box_stats(df: DataFrame, group: Sequence[str], y: str, weight: Column | None = None) -> DataFrame:
    """Quartiles, whisker ends within 1.5 IQR and outlier count per group.

    Without weights the quartiles interpolate; with weights each is the first value whose
    running weight reaches the share of the group's weight.
    """
    group, probs, names = list(group), [0.25, 0.5, 0.75], ["q1", "median", "q3"]
    rows = df.filter(~_missing(df, y))
    if weight is None:
        boxes = ranks.exact_quantiles(rows, group, [y], probs, names).drop("metric")
    else:
        boxes = ranks.weighted_quantiles(rows, group, y, weight, probs, names)
    # one row for each group travels to the rows, which are added up where they are
    values = rows.select(*group, F.col(y).cast("double").alias("_y"))
    right = boxes
    cond = F.lit(True)
    for g in group:
        right = right.withColumnRenamed(g, f"_g_{g}")
        cond = cond & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_y").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(travelling(right), cond)
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.max(n).alias(n) for n in names],
            F.min(F.when(inside, F.col("_y"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_y"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def trend_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x with the standard errors behind its confidence band."""
    n = F.regr_count(F.col(y), F.col(x))
    fit = df.agg(
        n.alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_avgx(F.col(y), F.col(x)).alias("mean_x"),
        F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
        F.regr_syy(F.col(y), F.col(x)).alias("syy"),
    )
    sigma2 = F.try_divide((1 - F.col("r2")) * F.col("syy"), F.col("n") - 2)
    return fit.select(
        "n",
        "slope",
        "intercept",
        "r2",
        F.sqrt(F.try_divide(sigma2, F.col("sxx"))).alias("slope_se"),
        F.sqrt(sigma2 * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.col("mean_x") ** 2, F.col("sxx")))).alias("intercept_se"),
    )


def scatter_sample(df: DataFrame, columns: Sequence[str], hue: str, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """A bounded, repeatable sample of points for a plot."""
    return (
        df.withColumn("_h", ranks.hash_key(key, seed)).orderBy("_h", *key).limit(n).select(*columns, hue)
    )


def hist2d(df: DataFrame, x: str, y: str, hue: str, bins: int) -> DataFrame:
    """Counts of all points with both coordinates over a bins x bins frame, per hue."""
    df = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    lo_x, hi_x, lo_y, hi_y = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()

    def cell(c: str, lo: float | None, hi: float | None) -> Column:
        if lo is None:  # no point at all
            return F.lit(None).cast("int")
        width = (hi - lo) / bins or 1.0
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")

    return (
        df.groupBy(hue, cell(x, lo_x, hi_x).alias("bin_x"), cell(y, lo_y, hi_y).alias("bin_y"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_counts_numbered(df: DataFrame, column: str) -> DataFrame:
    """Counts per category with the category's number in name order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return ranks.name_rank(counts, column)


def weighted_sum_mean(df: DataFrame, total: str, y: str, condition: Column) -> DataFrame:
    """Sum of one column over all rows, and the mean of another where a condition holds."""
    return df.agg(F.sum(total).alias("total"), F.avg(F.when(condition, _present(df, y))).alias("mean"))
