"""Inputs that once lost data: late files, other scripts, nulls, unreadable pictures, label subsets."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis import session
from vitalis.functions import text as tx
from vitalis.operators import evaluate, models, profile, retrieval, splits
from vitalis.sources import files
from vitalis.streaming import index


def test_index_takes_files_with_old_times_and_ignores_what_it_holds(spark, tmp_path):
    folder, path, state = str(tmp_path / "in"), str(tmp_path / "ix"), str(tmp_path / "st")
    schema = "doc_id bigint, text string"
    for number, rows in enumerate([[(1, "one"), (2, "two")], [(2, "two again"), (3, "three")], [(4, "four"), (5, "five"), (1, "one")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        if number == 2:  # three days old when it arrives
            new = max((f for f in (tmp_path / "in").glob("*.parquet")), key=lambda f: f.stat().st_mtime)
            old = new.stat().st_mtime - 3 * 86_400
            os.utime(new, (old, old))
        index.index_stream(index.read_arrivals(spark, folder, spark.createDataFrame([], schema).schema), path, state)
    got = {r["doc_id"]: r["text"] for r in index.read_index(spark, path).collect()}
    assert got == {1: "one", 2: "two", 3: "three", 4: "four", 5: "five"}


def test_terms_of_other_scripts(spark):
    df = spark.createDataFrame([("Fièvre élevée, боль 37_5 ñ",)], "t string")
    assert df.select(tx.terms("t")).first()[0] == ["fièvre", "élevée", "боль", "37_5"]
    made = retrieval.embed(spark.createDataFrame([("боль",)], "text string"), "text", dim=16)
    assert sum(x != 0 for x in made.first()["embedding"]) == 1


def test_nulls_stay_and_count(spark):
    rows = spark.createDataFrame([("A", "A"), ("A", None), (None, "A"), ("R", "R")], "truth string, pred string")
    assert evaluate.accuracy(rows, "truth", "pred").first()[0] == pytest.approx(2 / 3)
    matrix = {(r["truth"], r["pred"]): r["n"] for r in evaluate.confusion(rows, "truth", "pred").collect()}
    assert matrix[None, "A"] == 1 and matrix["A", None] == 1 and sum(matrix.values()) == 4
    weights = splits.balanced_weights(rows, "truth").collect()
    assert len(weights) == 4 and sum(r["weight"] is None for r in weights) == 1
    assert sum(r["weight"] or 0 for r in weights) == pytest.approx(3.0)


def test_report_of_some_labels(spark):
    rows = spark.createDataFrame([("A", "A"), ("A", "R"), ("R", "A"), ("N", "N")], "truth string, pred string")
    got = {r["label"]: r for r in evaluate.classification_report(rows, "truth", "pred", ["A", "N"]).collect()}
    assert (got["A"]["precision"], got["A"]["recall"], got["A"]["support"]) == (0.5, 0.5, 2)
    assert got["micro avg"]["precision"] == pytest.approx(2 / 3) and "accuracy" not in got
    whole = {r["label"]: r for r in evaluate.classification_report(rows, "truth", "pred").collect()}
    assert whole["accuracy"]["f1"] == 0.5 and "micro avg" not in whole


def test_hist2d_without_coordinates(spark):
    df = spark.createDataFrame([(0.0, 0.0, "a"), (10.0, 10.0, "a"), (None, 3.0, "a"), (3.0, None, "a")], "x double, y double, h string")
    assert {(r["bin_x"], r["bin_y"], r["n"]) for r in profile.hist2d(df, "x", "y", "h", 2).collect()} == {(0, 0, 1), (1, 1, 1)}
    assert profile.hist2d(df.limit(0), "x", "y", "h", 2).collect() == []


def test_unreadable_picture_keeps_its_row(spark, tmp_path):
    (tmp_path / "mask").mkdir()
    (tmp_path / "mask" / "broken.png").write_bytes(b"no picture")
    (row,) = files.read_images(spark, str(tmp_path)).collect()
    assert row["image"] is None and row["error"] == "unreadable" and row["label"] == "mask"


def test_resize_by_two_products():
    from vitalis.operators import images

    x = np.random.default_rng(0).random((9, 14, 3))
    rows, columns = images._shares(9, 4), images._shares(14, 5)
    assert np.allclose(images.resize(x, 4, 5), np.einsum("ah,hwc,bw->abc", rows, x, columns))


def test_search_finds_chunks(spark):
    docs = spark.createDataFrame([(1, "apple pear. " * 30), (2, "stone " * 200 + "cherry"), (3, "")], "doc_id long, text string")
    chunks = retrieval.embed(retrieval.chunk(docs, "doc_id", "text", 100, 10), "text")
    asked = spark.createDataFrame([("q", "cherry stone"), ("r", "pear")], "query_id string, text string")
    found = retrieval.chunk_contexts(asked, chunks, 2).collect()
    got = {r["query_id"]: r for r in found}
    assert "cherry" in got["q"]["context"] and "pear" in got["r"]["context"] and got["q"]["n_hits"] == 2


def test_no_shared_folder_is_an_error_on_a_cluster(spark):
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Session())


def test_linear_svc_takes_columns_as_they_are():
    assert models.linear_svc(1.0, 10).getStandardization() is False


def test_more_groups_than_a_thousand(spark):
    df = spark.range(1100).select(F.col("id").alias("g"))
    folds = splits.logo_frames(df, "g")
    assert next(folds)[0] == 0 and sum(1 for _ in folds) == 1099


def test_lowpass_keeps_slow_and_removes_fast_waves(spark):
    from vitalis.operators import signal

    t = np.arange(2560) / 256.0
    slow, fast = np.sin(2 * np.pi * 3 * t), np.sin(2 * np.pi * 60 * t)
    df = spark.createDataFrame([((slow + fast).tolist(),)], "x array<double>")
    got = np.array(df.select(signal.lowpass("x", 256.0)).first()[0])[400:-400]
    assert np.abs(got - slow[400:-400]).max() < 0.1


def test_absolute_loss_ignores_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.random(400) * 10
    y = 2 * x + 1 + rng.normal(0, 0.05, 400)
    y[:60] += 200
    df = models.assemble(spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, label double"), ["x"])
    lad, ols = models.fit_lad(df), models.fit_linear(df)
    assert abs(lad.coefficients[0] - 2) < 0.05 and abs(lad.intercept - 1) < 0.3
    assert models.mean_absolute_error(lad, df) < 0.9 * models.mean_absolute_error(ols, df)


def test_components_of_rows_far_from_zero(spark):
    from vitalis.operators.decompose import Pca

    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3)) * [3.0, 1.0, 0.5]
    near, far = (Pca.fit(spark.createDataFrame([(r.tolist(),) for r in x + shift], "v array<double>"), "v") for shift in (0.0, 1e8))
    assert np.allclose(near.variances, far.variances, rtol=1e-5)
    mixed = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    with pytest.raises(Exception, match="components|reshape"):
        Pca.fit(mixed, "v")
