"""Splits, scaling and evaluation over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalis.operators import evaluate, scale, splits
from vitalis.plans.core_queries import rounded
from vitalis.plans.frames import FEATURES, LINE_KEY_SQL, PREDICTIONS_SQL, SENSOR_SQL, keyed_lines, predictions, sensor_samples
from vitalis.plans.registry import query, table

LABELS = ["A", "N", "R"]


@query(
    "split_fraction",
    f"""
    select row_key, case when b < 8000 then 'train' when b < 9000 then 'validation' else 'test' end as split from
      (select row_key, cast(concat('0x', substr(md5(concat_ws('|', row_key, 'split')), 1, 8)) as bigint) % 10000 as b
       from (select {LINE_KEY_SQL} as row_key from lineitem))
    """,
)
def split_fraction(spark, d):
    parts = {"train": 0.8, "validation": 0.1, "test": 0.1}
    return splits.split(keyed_lines(spark, d).select("row_key"), ["row_key"], parts, "split")


_STRATA_SQL = f"""
select row_key, l_returnflag, row_number() over (partition by l_returnflag order by md5(concat_ws('|', row_key, '{{seed}}')), row_key) as rn,
       count(*) over (partition by l_returnflag) as n from (select {LINE_KEY_SQL} as row_key, l_returnflag from lineitem)
"""


@query(
    "split_stratified",
    f"""
    select row_key, l_returnflag, case when rn <= floor(0.25::double * n + 0.5) then 'test' else 'train' end as split
    from ({_STRATA_SQL.format(seed='strata')})
    """,
)
def split_stratified(spark, d):
    rows = keyed_lines(spark, d).select("row_key", "l_returnflag")
    return splits.split_stratified(rows, ["row_key"], "l_returnflag", 0.25, "strata")


@query(
    "split_counts",
    f"""
    select row_key, case when rn <= floor(0.9::double * n) then 'train' when rn <= floor(0.9::double * n) + 3500 then 'test'
           else 'batch' end as split
    from (select row_key, row_number() over (order by md5(concat_ws('|', row_key, 'cut')), row_key) as rn, count(*) over () as n
          from (select {LINE_KEY_SQL} as row_key from lineitem))
    """,
)
def split_counts(spark, d):
    rows = keyed_lines(spark, d).select("row_key")
    return splits.split_counts(rows, ["row_key"], {"train": 0.9, "test": 3500, "batch": None}, "cut")


@query(
    "logo_folds",
    f"""
    select subject, count(*) as n_test, (select count(*) from events) - count(*) as n_train from ({SENSOR_SQL}) group by subject
    """,
)
def logo_folds(spark, d):
    events = table(spark, d, "events").select((F.col("user_id") % 10).alias("subject"))
    return splits.logo_folds(events, "subject")


@query(
    "kfold_stratified",
    f"select row_key, l_returnflag, cast((rn - 1) % 5 as integer) as fold from ({_STRATA_SQL.format(seed='fold')})",
)
def kfold_stratified(spark, d):
    return splits.kfold(keyed_lines(spark, d).select("row_key", "l_returnflag"), ["row_key"], "l_returnflag", 5, "fold")


@query(
    "balanced_weights",
    """
    select o_orderkey, o_orderstatus, round(cast(n as double) / (k * nc), 9) as weight from orders
    join (select o_orderstatus, count(*) as nc from orders group by 1) using (o_orderstatus)
    join (select count(*) as n, count(distinct o_orderstatus) as k from orders) on true
    """,
)
def balanced_weights(spark, d):
    weighted = splits.balanced_weights(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")
    return rounded(weighted, 9, "weight")


def _scaled(form: str) -> str:
    cells = ", ".join(f"round({form.format(c=c)}, 6) + 0.0 as {c}" for c in FEATURES)
    return f"select {LINE_KEY_SQL} as row_key, {cells} from lineitem"


@query("standard_scale", _scaled("({c} - (select avg({c}) from lineitem)) / (select stddev_pop({c}) from lineitem)"))
def standard_scale(spark, d):
    lines = keyed_lines(spark, d).select("row_key", *FEATURES)
    return rounded(scale.StdScale.fit(lines, FEATURES).transform(lines), 6, *FEATURES)


@query(
    "inverse_scale",
    f"select {LINE_KEY_SQL} as row_key, round(l_extendedprice, 4) as truth, round(l_extendedprice * 0.9 + avg(l_extendedprice) over () * 0.1, 4) as predicted from lineitem",
)
def inverse_scale(spark, d):
    lines = keyed_lines(spark, d).select("row_key", "l_extendedprice")
    scaler = scale.StdScale.fit(lines, ["l_extendedprice"])
    scaled = scaler.transform(lines).select(
        "row_key", F.col("l_extendedprice").alias("truth"), (F.col("l_extendedprice") * 0.9).alias("predicted")
    )
    back = scaler.inverse(scaled, {"truth": "l_extendedprice", "predicted": "l_extendedprice"})
    return rounded(back, 4, "truth", "predicted")


@query("minmax_scale", _scaled("({c} - (select min({c}) from lineitem)) / (select max({c}) - min({c}) from lineitem)"))
def minmax_scale(spark, d):
    lines = keyed_lines(spark, d).select("row_key", *FEATURES)
    return rounded(scale.minmax(lines, FEATURES), 6, *FEATURES)


@query(
    "minmax_scale_fitted",
    f"""
    with k as (select {LINE_KEY_SQL} as row_key, l_extendedprice from lineitem),
    s as (select *, cast(concat('0x', substr(md5(concat_ws('|', row_key, 'hold')), 1, 8)) as bigint) % 10000 < 8000 as train from k),
    e as (select min(l_extendedprice) as lo, max(l_extendedprice) - min(l_extendedprice) as w from s where train)
    select row_key, round((l_extendedprice - lo) / w, 6) + 0.0 as l_extendedprice from s, e where not train
    """,
)
def minmax_scale_fitted(spark, d):
    parts = splits.split(
        keyed_lines(spark, d).select("row_key", "l_extendedprice"), ["row_key"], {"train": 0.8, "test": 0.2}, "hold"
    )
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    return rounded(scale.minmax(test, ["l_extendedprice"], fitted_on=train), 6, "l_extendedprice").drop("split")


_GRID_SQL = "(select unnest(['A', 'N', 'R']) as truth) t join (select unnest(['A', 'N', 'R']) as pred) p on true"


@query(
    "confusion_matrix",
    f"""
    select t.truth, p.pred, count(x.truth) as n from {_GRID_SQL}
    left join ({PREDICTIONS_SQL}) x on x.truth = t.truth and x.pred = p.pred group by 1, 2
    """,
)
def confusion_matrix(spark, d):
    return evaluate.confusion(predictions(spark, d), "truth", "pred", LABELS)


@query(
    "confusion_folds",
    f"""
    select t.truth, p.pred, count(x.truth) as n from {_GRID_SQL}
    left join ({PREDICTIONS_SQL}) x on x.truth = t.truth and x.pred = p.pred group by 1, 2
    """,
)
def confusion_folds(spark, d):
    return evaluate.sum_folds(evaluate.confusion(predictions(spark, d), "truth", "pred", LABELS, by=["fold"]))


@query(
    "confusion_normalized",
    f"""
    select truth, pred, n, round(n / sum(n) over (partition by truth), 6) as share
    from (select truth, pred, count(*) as n from ({PREDICTIONS_SQL}) group by 1, 2)
    """,
)
def confusion_normalized(spark, d):
    matrix = evaluate.confusion(predictions(spark, d), "truth", "pred")
    return rounded(evaluate.normalize_rows(matrix), 6, "share")


@query("accuracy", f"select round(avg(cast(truth = pred as double)), 6) as accuracy from ({PREDICTIONS_SQL})")
def accuracy(spark, d):
    return rounded(evaluate.accuracy(predictions(spark, d), "truth", "pred"), 6, "accuracy")


@query(
    "precision_recall_binary",
    f"""
    select round(count(*) filter (truth = 'R' and pred = 'R') / count(*) filter (pred = 'R'), 6) as precision,
           round(count(*) filter (truth = 'R' and pred = 'R') / count(*) filter (truth = 'R'), 6) as recall
    from ({PREDICTIONS_SQL})
    """,
)
def precision_recall_binary(spark, d):
    scored = evaluate.precision_recall(predictions(spark, d), "truth", "pred", "binary", positive="R")
    return rounded(scored, 6, "precision", "recall")


_PER_CLASS_SQL = f"""
select label, coalesce(hit / nullif(predicted, 0), 0) as precision, coalesce(hit / nullif(actual, 0), 0) as recall, actual, hit
from (select label, count(*) filter (truth = label and pred = label) as hit, count(*) filter (truth = label) as actual,
             count(*) filter (pred = label) as predicted
      from ({PREDICTIONS_SQL}), (select unnest(['A', 'N', 'R', 'X']) as label) group by label)
"""


@query(
    "precision_recall_macro",
    f"select round(avg(precision), 6) as precision, round(avg(recall), 6) as recall from ({_PER_CLASS_SQL})",
)
def precision_recall_macro(spark, d):
    # X never occurs: its zero scores count in the mean
    scored = evaluate.precision_recall(predictions(spark, d), "truth", "pred", "macro", labels=[*LABELS, "X"])
    return rounded(scored, 6, "precision", "recall")


@query(
    "classification_report",
    f"""
    with c as (select label, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1,
                      actual as support, hit from ({_PER_CLASS_SQL}) where label <> 'X')
    select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from c
    union all select 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
                     round(sum(hit) / sum(support), 6), cast(sum(support) as bigint) from c
    union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from c
    union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                     round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from c
    """,
)
def classification_report(spark, d):
    report = evaluate.classification_report(predictions(spark, d), "truth", "pred", LABELS)
    return rounded(report, 6, "precision", "recall", "f1")


_SUBSET_SQL = f"""
with c as (select label, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1, support, hit, predicted
  from (select label, hit, actual as support, predicted, coalesce(hit / nullif(predicted, 0), 0) as precision, coalesce(hit / nullif(actual, 0), 0) as recall
    from (select label, count(*) filter (truth = label and pred = label) as hit, count(*) filter (truth = label) as actual,
            count(*) filter (truth is not null and pred = label) as predicted
          from (select truth, nullif(pred, 'N') as pred from ({PREDICTIONS_SQL})), (select unnest(['A', 'R']) as label) group by label))),
m as (select sum(hit) / sum(predicted) as p, sum(hit) / sum(support) as r, cast(sum(support) as bigint) as n from c)
select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from c
union all select 'micro avg', round(p, 6), round(r, 6), round(2 * p * r / (p + r), 6), n from m
union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), cast(sum(support) as bigint) from c
union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from c
"""


@query("classification_report_subset", _SUBSET_SQL)
def classification_report_subset(spark, d):
    """Two of three classes listed, and no prediction where the third was predicted."""
    rows = predictions(spark, d).withColumn("pred", F.expr("nullif(pred, 'N')"))
    report = evaluate.classification_report(rows, "truth", "pred", ["A", "R"])
    return rounded(report, 6, "precision", "recall", "f1")


@query(
    "accuracy_missing",
    f"""
    select round(avg(cast(coalesce(truth = pred, false) as double)), 6) as accuracy
    from (select nullif(truth, 'A') as truth, nullif(pred, 'N') as pred from ({PREDICTIONS_SQL})) where truth is not null
    """,
)
def accuracy_missing(spark, d):
    rows = predictions(spark, d).withColumns({"truth": F.expr("nullif(truth, 'A')"), "pred": F.expr("nullif(pred, 'N')")})
    return rounded(evaluate.accuracy(rows, "truth", "pred"), 6, "accuracy")


@query(
    "regression_metrics",
    """
    with e as (select l_extendedprice as y, l_quantity * 1900 as p from lineitem),
    m as (select count(*) as n, avg((y - p) * (y - p)) as mse, avg(abs(y - p)) as mae, var_pop(y) as v from e)
    select n, round(sqrt(mse), 3) as rmse, round(mse, 2) as mse, round(mae, 4) as mae, round(1 - mse / v, 8) as r2,
           round(1 - (mse / v) * (n - 1) / (n - 1 - 1), 8) as adjusted_r2, round(1 - mse, 2) as one_minus_loss from m
    """,
)
def regression_metrics(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1900).alias("p")
    )
    scored = evaluate.regression_metrics(rows, "y", "p", 1)
    scored = rounded(scored, 2, "mse", "one_minus_loss")
    return rounded(rounded(scored, 4, "mae"), 8, "r2", "adjusted_r2")
