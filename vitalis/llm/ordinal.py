"""Grades of documents by an ordinal cumulative-link model over hashed text features.

One weight vector is shared by all grades: P(grade >= k) = sigmoid(score - threshold_k), with
thresholds in ascending order. The expected grade and the tail probability select documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, lean, lower_ascii, mix, slices, small_batches, text_bytes, word_bounds, word_hashes

BITS = 20
_SLICE = 1 << 20  # bytes of text whose features are found at once; they take some hundred bytes each
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_HEAD = 5  # bytes of a word's head
_STRENGTH = 3  # value of a trait's feature, where a word's is 1
#: Shares of words with a trait are cut at these values; each trait and cut is a feature.
_CUTS = np.array([0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text (no nulls): slots, and the n + 1 places where texts begin.

    Features are the distinct words without edge punctuation and case, their first bytes, and steps of the shares of
    words that end in punctuation runs, are in capitals, hold no letter, or repeat.
    """
    data, offsets = text_bytes(texts)
    starts, ends, first = word_bounds(data, offsets)
    n = len(texts)
    if not len(starts):
        return np.zeros(0, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    place = np.arange(len(data))
    last = np.maximum.accumulate(np.where(_LETTER[data], place, -1))
    following = np.minimum.accumulate(np.where(_LETTER[data], place, len(data))[::-1])[::-1]
    a, b = np.maximum(starts, following[starts]), np.minimum(ends, last[ends - 1] + 1)
    bare = a >= b
    a, b = np.where(bare, starts, a), np.where(bare, ends, b)
    lower = lower_ascii(data)
    words = word_hashes(lower, a, b, seed=3)
    heads = np.minimum(a + _HEAD, b)
    heads = word_hashes(lower, a, heads, seed=5)
    row = np.repeat(np.arange(n), np.diff(first))
    count = np.maximum(np.diff(first), 1)
    length, tail = letters[ends] - letters[starts], ends - b
    traits = [tail == 1, tail == 2, tail >= 3, (uppers[ends] - uppers[starts] == length) & (length > 1), bare]
    key = words ^ mix(row.astype(np.uint64) + np.uint64(1))
    _, where = np.unique(key, return_index=True)
    shares = [np.bincount(row, weights=t, minlength=n) / count for t in traits]
    shares.append(1 - np.bincount(row[where], minlength=n) / count)
    _, with_head = np.unique(heads ^ mix(row.astype(np.uint64) + np.uint64(1)), return_index=True)
    rows = [row[where], row[with_head]]
    slots = [(h >> np.uint64(64 - BITS)).astype(np.int64) for h in (words[where], heads[with_head])]
    for t, share in enumerate(shares):
        for c, cut in enumerate(_CUTS):
            on = np.repeat(np.flatnonzero((share >= cut) & (np.diff(first) > 0)), _STRENGTH)
            rows.append(on)
            slots.append(np.full(len(on), int(mix(np.array([100 * t + c + 7], dtype=np.uint64))[0] >> np.uint64(64 - BITS))))
    rows, slots = np.concatenate(rows), np.concatenate(slots)
    order = np.argsort(rows, kind="stable")
    return slots[order], np.searchsorted(rows[order], np.arange(n + 1))


@dataclass
class Ordinal:
    """Fitted weights by slot and the ascending thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K - 1, a row for each text."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[slots])])
        return _sigmoid((total[first[1:]] - total[first[:-1]])[:, None] - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _runs(n: int, length: int = 1 << 20) -> Iterator[slice]:
    return (slice(k, k + length) for k in range(0, n, length))


def fit_arrays(
    slots: np.ndarray, first: np.ndarray, grades: np.ndarray, classes: int, epochs: int = 150, ridge: float = 6e-4,
    least_docs: int = 4, rate: float = 0.1,
) -> Ordinal:
    """Maximum likelihood with a ridge penalty, by full-batch Adam steps.

    Slots in fewer than ``least_docs`` texts keep weight 0.
    """
    # small integers and short runs keep the driver's share of the work to some hundred megabytes
    seen = np.zeros(1 << BITS, dtype=np.int64)
    for part in _runs(len(slots)):
        seen += np.bincount(slots[part], minlength=1 << BITS)
    common = seen >= least_docs
    keep = common[slots]
    used = np.flatnonzero(common)
    column = (np.cumsum(common, dtype=np.int32) - 1)[slots[keep]]
    rows = np.repeat(np.arange(len(grades), dtype=np.int32), np.diff(first))[keep]
    del keep, seen
    size, n = len(used), len(grades)
    share = np.array([np.clip((grades >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, classes)])
    theta = np.sort(np.log((1 - share) / share))
    gaps = np.log(np.maximum(np.diff(theta), 1e-2))
    x = np.concatenate([np.zeros(size), theta[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    pos = np.arange(n)
    for step in range(1, epochs + 1):
        w, theta = x[:size], np.concatenate([x[size : size + 1], x[size] + np.cumsum(np.exp(x[size + 1 :]))])
        score = np.zeros(n)
        for part in _runs(len(rows)):
            score += np.bincount(rows[part], weights=w[column[part]], minlength=n)
        tail = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - theta), np.zeros((n, 1))], axis=1)
        p = np.maximum(tail[pos, grades] - tail[pos, grades + 1], 1e-12)
        slope = tail * (1 - tail)  # zero at both ends
        low, high = slope[pos, grades] / p, slope[pos, grades + 1] / p
        by_score = -(low - high) / n
        by_theta = np.array([((low * (grades == k)).sum() - (high * (grades == k - 1)).sum()) / n for k in range(1, classes)])
        g = np.empty_like(x)
        g[:size] = ridge * w
        for part in _runs(len(rows)):
            g[:size] += np.bincount(column[part], weights=by_score[rows[part]], minlength=size)
        g[size] = by_theta.sum()
        for j in range(classes - 2):
            g[size + 1 + j] = by_theta[j + 1 :].sum() * np.exp(x[size + 1 + j])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        now = rate * (1 - (step - 1) / epochs)
        x = x - now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = x[:size]
    return Ordinal(weights, np.concatenate([x[size : size + 1], x[size] + np.cumsum(np.exp(x[size + 1 :]))]))


def fit(
    docs: DataFrame, ratings: DataFrame, grade: Column, classes: int, most: int = 20_000, most_slots: int = 16_000_000,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
) -> Ordinal:
    """Fit on at most ``most`` rated documents with at most ``most_slots`` features together (64 MB): those with the
    smallest seeded hash of their id; one with more features than are left over is passed by.

    ``grade`` is an expression over the columns of ``ratings`` with values 0 .. classes - 1. Rows
    without grade, id or document add nothing; an id that occurs more than once has its lowest grade
    and its smallest text. Without any rated document every score is 0 and the tails are 1/2.
    """
    rated = ratings.select(F.col(id_col).cast("long").alias("id"), grade.cast("int").alias("grade"))
    rated = rated.dropna().filter(F.col("grade").between(0, classes - 1)).groupBy("id").agg(F.min("grade").alias("grade"))
    rated = rated.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most)
    texts = fresh_columns(docs, id=id_col, text=text_col)
    texts = texts.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(rated), "id")  # at most ``most`` rows of 12 bytes
    joined = joined.groupBy("id").agg(F.min("grade").alias("grade"), F.min("text").alias("text"))  # repeats go before anything is collected

    @lean
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                slots, first = features(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(slots.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("grade"), lists], names=["id", "grade", "slots"])

    made = small_batches(joined.mapInArrow(sample, "id long, grade int, slots array<int>"), "rated-features")
    sizes = made.select("id", F.size("slots").alias("n"), F.xxhash64("id", F.lit(seed)).alias("h")).toArrow()  # at most ``most`` rows
    left, passed = most_slots, []
    for r in sorted(sizes.to_pylist(), key=lambda r: (r["h"], r["id"])):
        if r["n"] <= left:
            left -= r["n"]
        else:
            passed.append(r["id"])
    if passed:
        made = made.join(F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in passed], "id long")), "id", "left_anti")
    table = made.toArrow().sort_by("id")
    if not table.num_rows:
        return Ordinal(np.zeros(1 << BITS), np.zeros(classes - 1))
    lists = table["slots"].combine_chunks()
    first = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))])
    grades = np.asarray(table["grade"], dtype=np.int64)
    del table
    return fit_arrays(np.asarray(lists.flatten()), first, grades, classes)


def grade(
    docs: DataFrame, model: Ordinal, at_least: int, id_col: str = "doc_id", text_col: str = "text",
    keep: list[str] | None = None, least_tail: float | None = None,
) -> DataFrame:
    """Each document with ``expected_grade`` and ``tail_probability`` = P(grade >= at_least).

    ``keep`` names further columns to carry; with ``least_tail`` only rows of at least that tail
    probability are returned. A null text counts as empty: its score is 0. Rows that repeat are
    graded each by itself; null ids stay; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    carried = list(dict.fromkeys([id_col, *(keep or [])]))
    read = text_col if text_col in carried else "__text"  # a text that is carried travels once
    schema = docs.select(*(F.col(f"`{c}`") for c in carried)).schema
    schema = schema.add("expected_grade", "double").add("tail_probability", "double")
    held = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))  # 4 MB

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Ordinal(held.value[0].astype(np.float64), held.value[1])
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(read).fill_null(""), pa.array(np.arange(batch.num_rows))], names=["text", "at"])
            for own in slices(texts, "text", _SLICE):
                part = batch.slice(own.column("at")[0].as_py(), own.num_rows)
                tails = fitted.tails(*features(own.column("text")))
                chosen = tails[:, at_least - 1]
                out = [part.column(c) for c in carried] + [pa.array(tails.sum(axis=1)), pa.array(chosen)]
                out = pa.RecordBatch.from_arrays(out, names=[*carried, "expected_grade", "tail_probability"])
                yield out if least_tail is None else out.filter(pa.array(chosen >= least_tail))

    source = docs.select(*(F.col(f"`{c}`") for c in carried), *([] if text_col in carried else [F.col(f"`{text_col}`").alias(read)]))
    return source.mapInArrow(score, schema)
