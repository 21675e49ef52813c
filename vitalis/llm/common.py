"""What several operators share: written stages, words of Arrow texts, and hashes of words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.session import scratch_path

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ODD = np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings that hold inside the block and are put back after it."""
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(df: DataFrame, path: str) -> None:
    """Write a stage; its shuffle files are dropped once the stage is on shared storage."""
    with settings(df.sparkSession, **{CLEANUP: "true"}):
        df.write.parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared folder and read it back."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, name: str, rows: int = 1000) -> DataFrame:
    """A stage whose Python steps get so many rows at a time: whole texts travel in batches of a few megabytes."""
    with settings(df.sparkSession, **{"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        return stage(df, name)


def lean(run):
    """A step over batches that gives the memory it freed back to the system when it ends; workers live on from task to task."""

    @wraps(run)
    def inner(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return inner


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column | str) -> Column:
    """Number of words, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the n + 1 offsets of its rows."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of a text column without nulls, or of one longer text."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        past = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, past - at)
        at = past


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and the n + 1 places where each row's words begin."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (the finishing steps of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base squared ... modulo 2**64."""
    out = np.ones(max(1, n), dtype=np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * out[done - 1] * base
        done += step
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, taken from one running sum.

    Each byte goes through a random table first; the base is odd, so that dividing by the power
    at a word's place is exact modulo 2**64.
    """
    rng = np.random.default_rng(seed)
    table = rng.integers(1, 2**64, 256, dtype=np.uint64, endpoint=False) | np.uint64(1)
    base = np.uint64(int(rng.integers(2**62, 2**63)) * 2 + 1)
    inverse = np.uint64(pow(int(base), -1, 2**64))
    out = np.empty(len(starts), dtype=np.uint64)
    chunk = 1 << 22  # bytes hashed with one run of powers
    first = 0
    while first < len(starts):
        low = starts[first]
        past = max(first + 1, int(np.searchsorted(ends, low + chunk, side="right")))
        span = data[low : ends[past - 1]]
        sums = np.zeros(len(span) + 1, dtype=np.uint64)
        np.cumsum(table[span] * _powers(base, len(span)), out=sums[1:])
        s, e = starts[first:past] - low, ends[first:past] - low
        back = _powers(inverse, len(span))
        out[first:past] = (sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64)
        first = past
    return mix(out)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on (places too near the end are left out)."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    total, have, run, out = len(words) - size + 1, 0, words, None
    step = 1
    while True:  # put windows of 1, 2, 4 ... words together as the bits of ``size`` say
        if size & step:
            part = run[have : have + total]
            out = mix(part + _ODD) if out is None else mix(out * _ODD + part)
            have += step
        step *= 2
        if step > size:
            return out
        half = step // 2
        run = mix(run[:-half] * _ODD + run[half:]) if half < len(run) else run[:0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1 of every i, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def fresh_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns can't clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))
