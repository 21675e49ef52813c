"""Packed arrays that groups of rows send each other, and where a document is at home."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import width


def groups_for(docs: DataFrame) -> int:
    """How many groups share the packed arrays: as many as keep one within a task's memory.

    The number follows the input's splits, so that a group's load stays the same as data grows.
    """
    return max(width(docs.sparkSession), 4 * docs.rdd.getNumPartitions())


def squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes (all lowest bytes first), compressed, after width and count."""
    size = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, size).T
    raw = np.ascontiguousarray(planes).tobytes()
    head = np.array([size, len(raw)], "<i8").tobytes()
    return head + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unsqueeze(data: bytes, kind: str) -> np.ndarray:
    size, n = np.frombuffer(data, "<i8", count=2)
    raw = pa.Codec("zstd").decompress(data[16:], int(n), asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(int(size), -1).T
    return np.ascontiguousarray(planes).view(kind).reshape(-1)


def ints(values: np.ndarray) -> bytes:
    """Small numbers in 2 bytes each if they all fit, else in 4, after a byte that says so."""
    kind = "<u2" if not len(values) or values.max() < 65_536 else "<u4"
    return kind[-1].encode() + values.astype(kind).tobytes()


def read_ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u" + data[:1].decode(), offset=1).astype(np.int64)


def home_of(doc, n: int):
    """The group of a document for the way back; the same rule on columns and arrays."""
    if isinstance(doc, Column):
        return F.pmod(doc.bitwiseXOR(F.shiftright(doc, 17)), F.lit(n)).cast("int")
    return np.mod(doc ^ (doc >> 17), n)
