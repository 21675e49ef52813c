"""Windows of a fixed number of samples over a stream that may bring samples late.

Entities are dealt to a fixed number of buckets by a hash of their key. A bucket keeps one table of samples as state: of
each entity those of the window being filled, and those the watermark hasn't passed yet, whose order may still change. Once it
passes them they are numbered in time order, and every window of ``length`` samples that starts at a multiple of ``shift``
leaves as soon as one sample more is known. All entities of a bucket advance together, so the calls don't grow with their number.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vitalis.operators.signal import FEATURE_NAMES, SPECTRUM_LENGTH, window_features

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1024  # part of the state's layout: a checkpoint goes on with the same number only
_WRITTEN = 4096  # windows that leave at once


class CountWindows(StatefulProcessor):
    """Emits (key..., window, xs, ys). State of a bucket: its entities' samples, each with the number of its entity's first one."""

    def __init__(self, key: Sequence[str], ts: str, order: str, x: str, y: str, length: int, shift: int) -> None:
        self.columns, self.key, self.length, self.shift = (ts, order, x, y), list(key), length, shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "samples binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ts, order, x, y = self.columns
        passed, new = timerValues.getCurrentWatermarkInMs() * 1000, []
        for part in rows:
            at = part[ts].to_numpy().astype("datetime64[us]").astype("int64")
            own = pd.DataFrame({**{f"k{i}": part[k] for i, k in enumerate(self.key)}, "at": at, "number": part[order], "x": part[x], "y": part[y], "seq": 0})
            new.append(own[at > passed])  # what is too late has no place any more
        yield from self._advance(new, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass

    def _advance(self, new: list[pd.DataFrame], passed: int) -> Iterator[pd.DataFrame]:
        kept = self.held.get()
        old = [pa.ipc.open_stream(kept[0]).read_all().to_pandas()] if kept is not None else []
        parts = [p for p in (*old, *new) if len(p)]
        if not parts:
            return
        samples = pd.concat(parts, ignore_index=True)
        entity = samples.groupby([f"k{i}" for i in range(len(self.key))], sort=False).ngroup().to_numpy()
        order = np.lexsort((samples["number"], samples["at"], entity))
        samples, entity = samples.iloc[order], entity[order]
        at, seq = samples["at"].to_numpy(), samples["seq"].to_numpy()
        first = np.flatnonzero(np.r_[True, entity[1:] != entity[:-1]])  # of each entity
        size = np.diff(np.r_[first, len(entity)])
        known = np.add.reduceat((at <= passed).astype(np.int64), first)
        seq = np.maximum.reduceat(seq, first)
        windows = np.maximum(0, -((self.length - known) // self.shift))  # as many as leave a sample beyond their end
        yield from self._emitted(samples, first, seq, windows)
        gone = windows * self.shift
        left = np.arange(len(entity)) - np.repeat(first, size) >= np.repeat(gone, size)
        rest = samples[left].assign(seq=np.repeat(seq + gone, size)[left])
        sink = pa.BufferOutputStream()
        table = pa.Table.from_pandas(rest, preserve_index=False)
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(),))
        ready = (first + gone + self.length)[size - gone > self.length]  # the sample whose passing lets an entity's next window go
        if len(ready):
            self.handle.registerTimer(int(at[ready].min()) // 1000 + 1)

    def _emitted(self, samples: pd.DataFrame, first: np.ndarray, seq: np.ndarray, windows: np.ndarray) -> Iterator[pd.DataFrame]:
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        start, number = np.repeat(first, windows) + nth * self.shift, np.repeat(seq // self.shift, windows) + nth
        x, y = (samples[c].to_numpy(dtype=np.float64) for c in ("x", "y"))
        for lo in range(0, len(start), _WRITTEN):
            own = start[lo : lo + _WRITTEN]
            place = own[:, None] + np.arange(self.length)
            keys = {k: samples[f"k{i}"].iloc[own].to_numpy() for i, k in enumerate(self.key)}
            yield pd.DataFrame({**keys, "window": number[lo : lo + _WRITTEN], "xs": list(x[place]), "ys": list(y[place])})


def count_window_features(
    samples: DataFrame, key: Sequence[str], ts: str, order: str, x: str, y: str, fs: float, length: int, shift: int, delay: str,
    pad_to: int = SPECTRUM_LENGTH,
) -> DataFrame:
    """The seven features of every window of ``length`` samples each ``shift`` samples, as ``signal.featurize`` gives them.

    Samples come in any order up to ``delay`` behind the latest; later ones are left out. ``order`` (bigint) decides between
    equal times. Windows longer apart than they are long (``shift`` > ``length``) are not supported. Samples without key or time are left out.
    The session's state store must be RocksDB (``PROVIDER``).
    """
    if not 0 < shift <= length:
        raise ValueError("shift lies between 1 and length")
    kinds = [samples.schema[k] for k in key]
    schema = T.StructType([*kinds, T.StructField("window", T.LongType()), *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("xs", "ys"))])
    slim = samples.select(*key, F.col(ts).cast("timestamp").alias(ts), F.col(order).cast("bigint").alias(order), *(F.col(c).cast("double").alias(c) for c in (x, y)))
    for c in (*key, ts):
        slim = slim.filter(F.col(c).isNotNull())
    dealt = slim.withWatermark(ts, delay).withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS)))
    made = dealt.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=CountWindows(key, ts, order, x, y, length, shift), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    featured = made.withColumn("_f", window_features("xs", "ys", fs, pad_to))
    return featured.select(*key, "window", *[F.col(f"_f.{n}").alias(n) for n in FEATURE_NAMES])


def replay(samples: DataFrame, folder: str, ts: str, order: str, slices: int) -> str:
    """Write ``samples`` as files in time slices, each sample up to one slice late; the delay that covers this."""
    low, high = samples.agg(F.min(ts), F.max(ts)).first()
    span = (high - low) / slices + datetime.timedelta(seconds=1)
    place = F.floor((F.unix_micros(ts) - F.lit(int(low.timestamp() * 1_000_000))) / F.lit(int(span.total_seconds() * 1_000_000)))
    dealt = samples.withColumn("_file", place + F.pmod(F.xxhash64(order), F.lit(2)))
    for n in range(slices + 2):
        dealt.filter(F.col("_file") == n).drop("_file").coalesce(1).write.mode("append").parquet(folder)
    return f"{int(2 * span.total_seconds()) + 1} seconds"
