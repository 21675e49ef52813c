"""Filters, spectra, windows and streams."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.operators import signal

FS = 256.0
T = np.arange(2560) / FS


def test_filter_response():
    b, a = signal.butter_lowpass(FS)

    def gain(hz):
        z = np.exp(-2j * np.pi * hz / FS * np.arange(4))
        return abs((b @ z) / (a @ z))

    assert gain(0) == pytest.approx(1) and gain(12) == pytest.approx(np.sqrt(0.5)) and gain(128) < 1e-12


def test_sines_kept_and_removed():
    slow, fast = np.sin(2 * np.pi * 3 * T), np.sin(2 * np.pi * 60 * T)
    out = signal.lowpass_rows(np.vstack([slow, fast, np.full_like(slow, 4.2), slow + fast]), FS)
    middle = slice(200, -200)
    assert np.allclose(out[0][middle], slow[middle], atol=1e-3)
    assert np.abs(out[1][middle]).max() < 1e-3
    assert np.allclose(out[2], 4.2)
    assert np.allclose(out[3], out[0] + out[1])


def test_short_window_is_refused():
    with pytest.raises(ValueError):
        signal.lowpass_rows(np.zeros((1, signal.PAD)), FS)


def test_spectrum_of_a_sine():
    frequency, share = signal.spectrum_rows(np.sin(2 * np.pi * 2.5 * T)[None, :], FS, signal.SPECTRUM_LENGTH)
    assert frequency[0] == pytest.approx(2.5) and share[0] > 0.95


def test_window_that_ends_exactly_is_left_out(spark):
    df = spark.range(8).select(F.col("id").alias("seq"), F.lit(8).cast("bigint").alias("n"))
    assert signal.count_windows(df, "seq", "n", 4, 4).select("window").distinct().count() == 1
    assert signal.count_windows(df, "seq", "n", 4, 4, include_last=True).select("window").distinct().count() == 2
    over = signal.count_windows(df, "seq", "n", 4, 2).groupBy("window").count().collect()
    assert {(r[0], r[1]) for r in over} == {(0, 4), (1, 4)}


def test_trailing_nulls(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, 2.0), (1, 3, None), (1, 4, None)], "k int, seq int, v double")
    assert signal.trim_trailing_nulls(df, ["k"], "seq", ["v"]).count() == 3


def test_featurize_on_a_sine(spark):
    rows = [(1, i, 2561, float(np.sin(2 * np.pi * 2.5 * i / FS)), float(i)) for i in range(2561)]
    df = spark.createDataFrame(rows, "k int, seq bigint, n bigint, accx double, accy double")
    (row,) = signal.featurize(df, ["k"], "seq", "n", FS, 2560, 2560).collect()
    assert row["dominant_frequency_x"] == pytest.approx(2.5) and row["energy_23_x"] > 0.95
    assert row["std_x"] == pytest.approx(np.sqrt(0.5), abs=0.01)


def test_index_stream_adds_only_new_documents(spark, tmp_path):
    from vitalis.operators.retrieval import chunk
    from vitalis.streaming import index

    folder, path, state = str(tmp_path / "in"), str(tmp_path / "ix"), str(tmp_path / "st")
    first = spark.createDataFrame([(1, "a b c " * 400), (2, "short")], "doc_id bigint, text string")
    second = spark.createDataFrame([(2, "short"), (3, "later")], "doc_id bigint, text string")
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(folder)
        index.index_stream(index.read_arrivals(spark, folder, first.schema), path, state)
    got = index.read_index(spark, path)
    whole = spark.createDataFrame([(1, "a b c " * 400), (2, "short"), (3, "later")], "doc_id bigint, text string")
    columns = ["doc_id", "chunk_no", "start_index", "text"]
    want = chunk(whole, "doc_id", "text", 1000, 200).select(*columns)
    assert got.select(*columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_window_features_have_the_5th_percentile(spark):
    from vitalis.streaming import features

    rows = [("u", f"2024-01-01 00:00:{k:02d}", float(k * k), 1.0 * k) for k in range(40)]
    df = spark.createDataFrame(rows, "user string, t string, x double, y double").withColumn("t", F.to_timestamp("t"))
    (r,) = features.window_features_stream(df, ["user"], "t", "x", "y", "1 hour", "1 minute").collect()
    assert r["p05_x"] == pytest.approx(np.percentile([k * k for k in range(40)], 5))
