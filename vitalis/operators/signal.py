"""Windows over sensor samples, zero-phase low-pass filtering and window features.

A window holds a fixed number of samples, so gathering one window is always small, however
many samples an entity has. The Python part works on batches of windows as matrices.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.functions.stats import pearson
from vitalis.session import keep_apart

# fixed values: filter order and cut-off in Hz, spectrum length, frequency ranges in Hz
ORDER, CUTOFF_HZ, SPECTRUM_LENGTH = 3, 12.0, 2046
DOMINANT_RANGE, BAND = (0.25, 12.0), (2.0, 3.0)
PAD = 3 * (ORDER + 1)


def trim_trailing_nulls(df: DataFrame, key: Sequence[str], seq: str, columns: Sequence[str]) -> DataFrame:
    """Drop the rows after the last one of each entity with any value; gaps before it stay."""
    any_value = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    last = df.groupBy(*key).agg(F.max(F.when(any_value, F.col(seq))).alias("_last"))
    return df.join(last, list(key)).filter(F.col(seq) <= F.col("_last")).drop("_last")


def count_windows(
    df: DataFrame, seq: str, n_samples: str, length: int, shift: int, include_last: bool = False
) -> DataFrame:
    """Add ``window`` (number) to each sample, once per window it lies in.

    Windows start at 0, shift, 2*shift, ... while start < n - length: a window that ends exactly
    with the last sample is left out unless ``include_last``. ``n_samples`` is the entity's total.
    """
    s = F.col(seq)
    if shift == length:
        numbered = df.withColumn("window", F.floor(s / length))
    else:
        first = F.greatest(F.ceil((s - length + 1) / shift), F.lit(0).cast("bigint"))
        last = F.floor(s / shift)
        inside = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        numbered = df.withColumn("window", F.explode(inside))
    start, end = F.col("window") * shift, F.col(n_samples) - length
    return numbered.filter(start <= end if include_last else start < end)


def window_time_features(df: DataFrame, key: Sequence[str], x: str, y: str) -> DataFrame:
    """Mean, population deviation, 5th percentile, correlation with y, and energy of x per window."""
    n = F.count(x)
    return df.groupBy(*key, "window").agg(
        F.avg(x).alias("mean_x"),
        F.stddev_pop(x).alias("std_x"),
        F.percentile(x, 0.05).alias("p5_x"),
        pearson(x, y).alias("corr_xy"),
        (F.var_pop(x) * n).alias("energy_x"),
    )


def window_arrays(df: DataFrame, key: Sequence[str], seq: str, channels: Sequence[str]) -> DataFrame:
    """One row per window with each channel as an array in sample order."""
    samples = F.array_sort(F.collect_list(F.struct(seq, *channels)))
    narrow = df.select(*key, "window", seq, *channels)
    rows = keep_apart(narrow, *key, "window").groupBy(*key, "window").agg(samples.alias("_s"))
    return rows.select(*key, "window", *[F.col("_s")[c].alias(c) for c in channels])


def butter_lowpass(fs: float, cutoff: float = CUTOFF_HZ, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Digital Butterworth low-pass coefficients by the bilinear transform."""
    edge = np.tan(np.pi * cutoff / fs)  # pre-warped, in units of twice the rate
    angles = np.pi * (2 * np.arange(order) + order + 1) / (2 * order)
    poles = edge * np.exp(1j * angles)
    z_poles = (1 + poles) / (1 - poles)
    a = np.real(np.poly(z_poles))
    b = np.poly(-np.ones(order))
    return b * (a.sum() / b.sum()), a  # gain 1 at frequency 0


def _settled(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Filter memory after an endless constant input of 1."""
    tail = b[1:] - a[1:] * (b.sum() / a.sum())
    return np.cumsum(tail[::-1])[::-1]


def _run(b: np.ndarray, a: np.ndarray, x: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """Filter the rows of ``x``, each started as if its first value had gone on for ever."""
    memory = settled[:, None] * x[:, 0]
    y = np.empty_like(x)
    for i in range(x.shape[1]):
        y[:, i] = b[0] * x[:, i] + memory[0]
        shifted = np.vstack([memory[1:], np.zeros((1, len(x)))])
        memory = shifted + b[1:, None] * x[:, i] - a[1:, None] * y[:, i]
    return y


def lowpass_rows(x: np.ndarray, fs: float) -> np.ndarray:
    """Zero-phase low-pass of each row: forward, then backward, over an odd extension of the ends."""
    if x.shape[1] <= PAD:
        raise ValueError(f"a window needs more than {PAD} samples to be filtered")
    b, a = butter_lowpass(fs)
    settled = _settled(b, a)
    left = 2 * x[:, :1] - x[:, PAD:0:-1]
    right = 2 * x[:, -1:] - x[:, -2 : -PAD - 2 : -1]
    padded = np.hstack([left, x, right])
    forward = _run(b, a, padded, settled)
    both = _run(b, a, forward[:, ::-1], settled)[:, ::-1]
    return both[:, PAD:-PAD]


def spectrum_rows(x: np.ndarray, fs: float, pad_to: int) -> tuple[np.ndarray, np.ndarray]:
    """Dominant frequency and share of energy in the band, for each row."""
    n = max(x.shape[1], pad_to)
    freqs = np.fft.rfftfreq(n, 1 / fs)
    size = np.abs(np.fft.rfft(x - x.mean(axis=1, keepdims=True), n, axis=1))
    low = (freqs >= DOMINANT_RANGE[0]) & (freqs <= DOMINANT_RANGE[1])
    band = (freqs >= BAND[0]) & (freqs <= BAND[1])
    energy = size**2
    with np.errstate(invalid="ignore"):
        share = energy[:, band].sum(axis=1) / energy.sum(axis=1)
    return freqs[low][np.argmax(size[:, low], axis=1)], share


def _by_length(series: pd.Series):
    """Positions of the rows of each array length, so that equal windows form one matrix."""
    lengths = series.map(len).to_numpy()
    for n in np.unique(lengths):
        yield np.nonzero(lengths == n)[0]


def _stack(series: pd.Series, at: np.ndarray) -> np.ndarray:
    return np.stack([np.asarray(series.iloc[i], dtype=np.float64) for i in at])


def lowpass(channel: Column | str, fs: float) -> Column:
    """Low-pass an array column of window samples."""

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        out: list = [None] * len(x)
        for at in _by_length(x):
            for i, row in zip(at, lowpass_rows(_stack(x, at), fs)):
                out[i] = row
        return pd.Series(out)

    return run(channel)


def spectral_features(channel: Column | str, fs: float, pad_to: int = SPECTRUM_LENGTH) -> Column:
    """(dominant_frequency_x, energy_23_x) of an array column of window samples."""

    @F.pandas_udf("dominant_frequency_x double, energy_23_x double")
    def run(x: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(x), 2))
        for at in _by_length(x):
            out[at, 0], out[at, 1] = spectrum_rows(_stack(x, at), fs, pad_to)
        return pd.DataFrame(out, columns=["dominant_frequency_x", "energy_23_x"])

    return run(channel)


FEATURE_NAMES = ["mean_x", "std_x", "p5_x", "corr_xy", "energy_x", "dominant_frequency_x", "energy_23_x"]


def window_features(x: Column | str, y: Column | str, fs: float, pad_to: int = SPECTRUM_LENGTH) -> Column:
    """The seven features of filtered windows, as a struct."""

    @F.pandas_udf(", ".join(f"{n} double" for n in FEATURE_NAMES))
    def run(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(xs), len(FEATURE_NAMES)))
        for at in _by_length(xs):
            fx, fy = lowpass_rows(_stack(xs, at), fs), lowpass_rows(_stack(ys, at), fs)
            dx, dy = fx - fx.mean(axis=1, keepdims=True), fy - fy.mean(axis=1, keepdims=True)
            energy = (dx**2).sum(axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                corr = (dx * dy).sum(axis=1) / np.sqrt(energy * (dy**2).sum(axis=1))
            dominant, share = spectrum_rows(fx, fs, pad_to)
            out[at] = np.column_stack(
                [fx.mean(axis=1), fx.std(axis=1), np.percentile(fx, 5, axis=1), corr, energy, dominant, share]
            )
        return pd.DataFrame(out, columns=FEATURE_NAMES)

    return run(x, y)


def featurize(
    df: DataFrame, key: Sequence[str], seq: str, n_samples: str, fs: float, length: int, shift: int,
    pad_to: int = SPECTRUM_LENGTH,
) -> DataFrame:
    """Feature table (key..., window, seven features) of samples with channels accx and accy."""
    windows = window_arrays(count_windows(df, seq, n_samples, length, shift), key, seq, ["accx", "accy"])
    made = windows.withColumn("_f", window_features("accx", "accy", fs, pad_to))
    return made.select(*key, "window", *[F.col(f"_f.{n}").alias(n) for n in FEATURE_NAMES])
