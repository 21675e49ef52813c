"""Confusion matrices, classification reports and regression errors.

Rows are reduced to (truth, prediction) counts first; everything after that works on a table
of at most classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


MAX_LABELS = 10_000  # a matrix of that side has 100 million cells


def _labels(counts: DataFrame) -> list:
    found = counts.select(F.explode(F.array("truth", "pred")).alias("label")).distinct()
    rows = found.filter(F.col("label").isNotNull()).limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels; is this a label column?")
    return sorted(r[0] for r in rows)


def pair_counts(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion(
    df: DataFrame, truth: str, pred: str, labels: Sequence | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per (truth, pred) over the full label grid, zero cells kept, per fold if ``by``.

    Rows without truth or prediction have cells of their own, with a null on that side.
    """
    counts = pair_counts(df, truth, pred, by)
    labels = list(labels) if labels is not None else _labels(counts)
    base = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    side = F.array(*[F.lit(v) for v in labels])
    grid = base.select(*by, F.explode(side).alias("truth")).select(*by, "truth", F.explode(side).alias("pred"))
    full = grid.join(counts, [*by, "truth", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    return full.unionByName(counts.filter(F.col("truth").isNull() | F.col("pred").isNull()))


def sum_folds(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("truth", "pred").agg(F.sum("n").alias("n"))


def normalize_rows(matrix: DataFrame) -> DataFrame:
    """Share of each true class; a class without rows gives null."""
    total = F.sum("n").over(Window.partitionBy("truth"))
    return matrix.withColumn("share", F.try_divide(F.col("n").cast("double"), total.cast("double")))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Share of the rows with a truth whose prediction equals it; no prediction is a miss."""
    hit = F.coalesce(F.col(truth) == F.col(pred), F.lit(False)).cast("double")
    return df.agg(F.avg(F.when(F.col(truth).isNotNull(), hit)).alias("accuracy"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def per_class(df: DataFrame, truth: str, pred: str, labels: Sequence | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a denominator is 0.

    With ``labels`` only these classes are listed, but rows of other classes still count: a wrong
    prediction is one whether or not its class is listed. Rows without truth don't count; one
    without prediction is a miss.
    """
    counts = pair_counts(df.filter(F.col(truth).isNotNull()), truth, pred)
    kind = counts.schema["truth"].dataType
    listed = counts.sparkSession.createDataFrame([(v,) for v in labels], T.StructType([T.StructField("label", kind)])) if labels is not None else None
    cells = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("label"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0).cast("bigint").alias("hit"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        )
    )
    sums = cells.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    if listed is not None:
        sums = listed.join(sums, "label", "left").fillna(0, ["support", "predicted", "hit"])
    scored = sums.select(
        "label",
        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        "support",
        "predicted",
        "hit",
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(2 * p * r, p + r))


def precision_recall(
    df: DataFrame, truth: str, pred: str, average: str = "binary", positive=1, labels: Sequence | None = None
) -> DataFrame:
    """One row (precision, recall): of the positive class, or the plain mean over classes."""
    if average == "binary":
        t, p = F.col(truth) == F.lit(positive), F.col(pred) == F.lit(positive)
        sums = df.agg(
            F.count_if(t & p).alias("hit"), F.count_if(t).alias("actual"), F.count_if(p).alias("predicted")
        )
        return sums.select(
            _ratio(F.col("hit"), F.col("predicted")).alias("precision"), _ratio(F.col("hit"), F.col("actual")).alias("recall")
        )
    if average != "macro":
        raise ValueError("average must be 'binary' or 'macro'")
    return per_class(df, truth, pred, labels).agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"))


def classification_report(df: DataFrame, truth: str, pred: str, labels: Sequence | None = None) -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted averages.

    If rows have classes that ``labels`` leaves out, the line of the accuracy becomes ``micro avg``
    over the listed classes.
    """
    classes = per_class(df, truth, pred, labels)
    measures = ["precision", "recall", "f1"]
    known = df.filter(F.col(truth).isNotNull())
    others = F.lit(False)
    if labels is not None:
        others = known.agg(F.coalesce(F.bool_or(~F.col(truth).isin(*labels) | ~F.col(pred).isin(*labels)), F.lit(False))).scalar()
    weight = F.col("support") / F.sum("support").over(Window.partitionBy(F.lit(0)))
    shares = classes.withColumn("_share", weight)
    averages = shares.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.sum(F.col(m) * F.col("_share")).alias(f"weighted_{m}") for m in measures],
        F.sum("support").alias("support"),
        _ratio(F.sum("hit"), F.sum("support")).alias("micro_recall"),
        _ratio(F.sum("hit"), F.sum("predicted")).alias("micro_precision"),
        others.alias("others"),
    )
    p, r = F.col("micro_precision"), F.col("micro_recall")
    both = {"precision": p, "recall": r, "f1": _ratio(2 * p * r, p + r)}
    lines = averages.select(
        F.inline(
            F.array(
                F.struct(
                    F.when(F.col("others"), "micro avg").otherwise("accuracy").alias("label"),
                    *[F.when(F.col("others"), both[m]).otherwise(r).alias(m) for m in measures],
                    "support",
                ),
                F.struct(F.lit("macro avg").alias("label"), *[F.col(f"macro_{m}").alias(m) for m in measures], "support"),
                F.struct(F.lit("weighted avg").alias("label"), *[F.col(f"weighted_{m}").alias(m) for m in measures], "support"),
            )
        )
    )
    return classes.select(F.col("label").cast("string").alias("label"), *measures, "support").unionByName(lines)


def regression_metrics(df: DataFrame, y: str, p: str, k: int) -> DataFrame:
    """RMSE, MSE, MAE, R2, adjusted R2 for ``k`` features, and 1 - MSE, from one aggregation."""
    error = F.col(y) - F.col(p)
    sums = df.agg(
        F.count(error).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(F.when(error.isNotNull(), F.col(y))).alias("_spread"),
    )
    r2 = 1 - F.try_divide(F.col("mse"), F.col("_spread"))
    return sums.select(
        "n",
        F.round(F.sqrt("mse"), 3).alias("rmse"),
        "mse",
        "mae",
        r2.alias("r2"),
        (1 - F.try_divide((1 - r2) * (F.col("n") - 1), F.col("n") - k - 1)).alias("adjusted_r2"),
        (1 - F.col("mse")).alias("one_minus_loss"),
    )
