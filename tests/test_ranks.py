"""Distributed ranks and quantiles against single-task windows, with hot groups and heavy ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalis.plans import ranks


@pytest.fixture(scope="module")
def hot(spark):
    """A group with most of the rows and a value that most rows share."""
    rng = np.random.default_rng(3)
    n = 4000
    group = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))
    value = np.where(rng.random(n) < 0.5, 5.0, np.round(rng.normal(0, 10, n), 2))
    pdf = pd.DataFrame({"id": np.arange(n), "g": group, "v": value, "w": rng.integers(1, 5, n).astype(float)})
    pdf.loc[pdf.id % 97 == 0, "g"] = None
    return spark.createDataFrame(pdf).cache()


@pytest.fixture(params=["travelling", "shuffled"], autouse=True)
def join_way(request, monkeypatch):
    """Both ways of bringing offsets to the rows: broadcast below the measured bound, shuffle above it."""
    if request.param == "shuffled":
        monkeypatch.setattr(ranks, "travelling", lambda df: df)


def test_hash_rank_equals_window(hot):
    ranked = ranks.hash_rank(hot, ["g"], ["id"], "s")
    w = Window.partitionBy("g").orderBy(ranks.hash_key(["id"], "s"), "id")
    wrong = ranked.withColumn("want", F.row_number().over(w)).filter("want <> hash_rank")
    assert ranked.count() == hot.count()
    assert wrong.count() == 0


def test_ranges_follow_the_rows_and_results_stay_exact(hot, monkeypatch):
    few = ranks.range_cuts(hot, ["v", "id"], 16)
    monkeypatch.setattr(ranks, "ROWS", 20)
    monkeypatch.setattr(ranks, "HEX_DIGITS", 1)
    many = ranks.range_cuts(hot, ["v", "id"], 16)
    assert len(few["id"]) <= 16 and len(many["id"]) > 150 and len(many["v"]) > 3 * len(few["v"])
    for c in ("id", "v"):  # none but a value of its own range holds many rows
        filled = ranks.add_range(hot, c, many[c], "r").groupBy("r").agg(F.count("*").alias("n"), F.countDistinct(c).alias("values"))
        assert filled.filter("n > 60 and values > 1").isEmpty()
    test_ordered_rank_cuts_repeated_values(hot)
    test_hash_rank_equals_window(hot)
    test_quantiles_equal_numpy(hot)


def test_ordered_rank_cuts_repeated_values(hot):
    ranked = ranks.ordered_rank(hot, ["g"], "v", "id", ranges=16)
    w = Window.partitionBy("g").orderBy("v", "id")
    wrong = ranked.withColumn("want", F.row_number().over(w) - 1).filter("want <> seq")
    assert ranked.count() == hot.count()
    assert wrong.count() == 0


def test_quantiles_equal_numpy(hot):
    got = ranks.exact_quantiles(hot.na.drop(subset=["g"]), ["g"], ["v"], [0.05, 0.5, 0.9], ["a", "b", "c"], ranges=16)
    pdf = hot.toPandas().dropna(subset=["g"])
    for row in got.collect():
        want = np.quantile(pdf[pdf.g == row["g"]].v, [0.05, 0.5, 0.9])
        assert np.allclose([row["a"], row["b"], row["c"]], want)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert ranks.exact_quantiles(df, [], ["v"], [0.5], ["m"]).first()["m"] == 2.0


def test_weighted_quantile_is_first_value_reaching_the_share(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 2.0)], "y double, w double")
    row = ranks.weighted_quantiles(df, [], "y", F.col("w"), [0.25, 0.5, 0.75], ["a", "b", "c"]).first()
    assert (row["a"], row["b"], row["c"]) == (1.0, 2.0, 3.0)


def test_name_rank_orders_by_bytes(spark):
    names = ["Brand#9", "Brand#10", "Brand#1", "Brand#é", "Brand#z", "Brand#"]
    got = ranks.name_rank(spark.createDataFrame([(n,) for n in names], "n string"), "n").collect()
    want = {n: i + 1 for i, n in enumerate(sorted(names, key=lambda s: s.encode()))}
    assert {r["n"]: r["position"] for r in got} == want
