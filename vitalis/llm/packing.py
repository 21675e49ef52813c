"""Packing token ids into sequences of bounded length, online and with few open windows.

Each partition keeps a fixed number of open windows. A piece goes to the window it fills best;
where it fits none, the fullest window is filled up with the piece's head and emitted. What is
still open at the end of the partitions is packed once more by fewer tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, lean, slices, small_batches
from vitalis.llm.tokens import SLICE, Encoder, with_end

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
)
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Windows:
    """Open windows of one task. ``rows`` takes the pieces of emitted windows."""

    def __init__(self, size: int, most: int, first: int, least_head: int):
        self.size, self.most, self.least_head = size, most, least_head
        self.gaps: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.held: dict[int, list[tuple]] = {}
        self.next, self.rows = first, []

    def _emit(self, window: int, keep_ids: bool = False) -> None:
        at = 0
        for doc, start, ids, total in self.held.pop(window):
            data = ids.astype("<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(data), total, window, at, data if keep_ids else None))
            at += len(ids)

    def _put(self, k: int, piece: tuple) -> None:
        gap, window = self.gaps.pop(k)
        self.held[window].append(piece)
        left = gap - len(piece[2])
        if left:
            insort(self.gaps, (left, window))
        else:
            self._emit(window)

    def add(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            k = bisect_left(self.gaps, (min(len(ids), self.size), -1))
            if len(ids) < self.size and k < len(self.gaps):  # best fit
                self._put(k, (doc, start, ids, total))
                return
            if len(ids) < self.size and len(self.gaps) < self.most:
                self.gaps.append((self.size, self.next))  # the largest gap there can be
                self.held[self.next] = []
                self.next += 1
                continue
            head = min(self.gaps[0][0], len(ids)) if len(ids) < self.size and self.gaps else self.size
            if len(ids) >= self.size:  # a whole sequence of its own
                self.held[self.next] = [(doc, start, ids[:head], total)]
                self._emit(self.next)
                self.next += 1
            elif head >= self.least_head:
                self._put(0, (doc, start, ids[:head], total))
            else:  # too small a gap for a piece: the fullest window goes out with padding
                self._emit(self.gaps.pop(0)[1])
                continue
            start, ids = start + head, ids[head:]

    def close(self, keep_ids: bool) -> None:
        for _, window in self.gaps:
            self._emit(window, keep_ids)
        self.gaps = []

    def taken(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)
            self.rows = []


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, size: int = 2048, open_windows: int = 64, least_head: int = 8,
    merge: int = 32, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` ids.

    A document's ids with one ``end_id`` are cut where they fill a sequence; pieces under
    ``least_head`` ids are not cut off. Each task keeps ``open_windows`` windows; those still open
    at its end carry their ids on, and every ``merge`` tasks' windows are packed again by one.
    A null or empty text is one end id; equal rows are packed each by itself; a null id stays
    null; an empty table gives no piece. Other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))

    @lean
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        windows = Windows(size, open_windows, TaskContext.get().partitionId() << 36, least_head)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, offsets = with_end(*encoder.encode(part.column(1)), end_id)
                for doc, a, b in zip(part.column(0).to_pylist(), offsets[:-1], offsets[1:]):
                    windows.add(doc, 0, ids[a:b], int(b - a))
                yield from windows.taken(4096)
        windows.close(keep_ids=True)
        yield from windows.taken()

    def again(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, open_windows, (1 << 62) + (key[0].as_py() << 36), least_head)
        for batch in batches:
            rows = (batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))
            for doc, start, ids, total in zip(*rows):
                windows.add(doc, start, np.frombuffer(ids, dtype="<u4"), total)
            yield from windows.taken(4096)
        windows.close(keep_ids=False)
        yield from windows.taken()

    placed = small_batches(slim.mapInArrow(first, PIECES), "pieces")
    whole = placed.filter("ids IS NULL")
    group = F.shiftright("sequence_id", 36) / merge
    open_ = placed.filter("ids IS NOT NULL").withColumn("_group", group.cast("long"))
    return whole.unionByName(open_.groupBy("_group").applyInArrow(again, PIECES)).drop("ids")
