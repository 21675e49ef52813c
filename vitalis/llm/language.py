"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Letters are taken in lower case, everything between them as one blank. N-grams of 1 to 4 of these
characters are hashed into slots; slots are counted by language in one pass, and the table of log
probabilities travels to the tasks, which score texts in batches of sparse counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, mix, slices

ORDERS = 4  # n-grams of 1 to so many characters
BITS = 16  # of a slot's number; fewer with many languages
CELLS = 1 << 23  # of the table of log probabilities at most (languages x slots)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20  # bytes of text that are cut into n-grams at once
_BLANK = 32


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    table = np.zeros(0x110000, dtype=bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def ngrams(texts: list[str], bits: int = BITS, orders: int = ORDERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all n-grams, the text each belongs to, and which texts have a letter.

    An n-gram lies in one text and holds at least one letter; a text's ends count as blanks.
    """
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype=np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[points]
    has = np.zeros(len(texts), dtype=bool)
    has[row[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the blank after a letter stands for all up to the next one
    keep[:1] = len(keep) > 0
    keep[1:] |= row[1:] != row[:-1]  # and every text begins with one
    letter, row = letter[keep], row[keep]
    points = np.where(letter, points[keep], _BLANK).astype(np.uint64)
    slots, rows = [], []
    held = np.zeros(0, dtype=np.uint64)
    for n in range(1, orders + 1):
        total = len(points) - n + 1
        if total <= 0:
            break
        held = mix(points + _ODD) if n == 1 else mix(held[:total] * _ODD + points[n - 1 :])
        inside = letter if n == 1 else row[:total] == row[n - 1 :]
        if n == 2:
            inside = inside & (letter[:-1] | letter[1:])  # a text's first blank may stand before another
        slots.append((held[inside] >> np.uint64(64 - bits)).astype(np.int32))
        rows.append(row[:total][inside])
    if not slots:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), has
    return np.concatenate(slots), np.concatenate(rows), has


def parts(texts: list[str], most: int = _SLICE) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) in turn; a very long text comes by itself in parts of ``most`` characters, so that
    the arrays stay small. An n-gram across two parts is not counted."""
    if sum(map(len, texts)) <= 2 * most:
        yield 0, texts
        return
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text)), most):
            yield k, [text[at : at + most]]


@dataclass
class Languages:
    """Learned languages, their log shares, and log probabilities by (slot, language)."""

    names: list[str]
    priors: np.ndarray
    table: np.ndarray
    bits: int

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Place of the likeliest language (-1 for none) and its probability.

        The n-grams of the orders cover the same characters, so each order's evidence counts by its share.
        """
        if not self.names:
            return np.full(len(texts), -1), np.zeros(len(texts))
        logs, has = np.zeros((len(texts), len(self.names))), np.zeros(len(texts), dtype=bool)
        for at, part in parts(texts):
            slots, rows, some = ngrams(part, self.bits)
            own = slice(at, at + len(part))
            has[own] |= some
            for k in range(len(self.names)):
                logs[own, k] += np.bincount(rows, weights=self.table[k][slots], minlength=len(part))
        logs = self.priors + logs / ORDERS
        best = logs.argmax(axis=1)
        score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        return np.where(has, best, -1), np.where(has, score, 0.0)


def log_table(counts: np.ndarray, smoothing: float = 0.1) -> np.ndarray:
    """Log probabilities of slots in each language, from counts by (language, slot)."""
    made = counts + smoothing
    return np.log(made / made.sum(axis=1, keepdims=True)).astype(np.float32)


def learn(docs: DataFrame, chosen: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Counts over all rows with a text and a language for which ``chosen`` (over ``id``) holds.

    The table has at most ``CELLS`` cells: with more than 128 languages slots get fewer bits; more
    than 8,192 languages are an error. Counts of a task are summed before they are shuffled, and the driver gets
    one sum per language and slot. A table without such rows gives no languages.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col, lang=lang_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), "text", F.col("lang").cast("string").alias("lang"))
    slim = slim.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    slim = slim.filter(chosen) if chosen is not None else slim
    shares = slim.groupBy("lang").count().orderBy("lang").limit(8193).collect()
    if len(shares) > 8192:
        raise ValueError("more than 8,192 languages")
    if not shares:
        return Languages([], np.zeros(0), np.zeros((0, 1 << BITS), dtype=np.float32), BITS)
    names = [r["lang"] for r in shares]
    place = {n: k for k, n in enumerate(names)}
    bits = min(BITS, int(np.log2(CELLS / len(names))))
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), size), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                lang = np.array([place[n] for n in part.column("lang").to_pylist()], dtype=np.int64)
                for at, texts in parts(part.column("text").to_pylist()):
                    slots, rows, _ = ngrams(texts, bits)
                    own = lang[rows + at]
                    for k in np.unique(own):
                        total[k] += np.bincount(slots[own == k], minlength=size)
        lang, slot = np.nonzero(total)
        for k in range(0, len(lang), 1 << 16):
            cut = slice(k, k + (1 << 16))
            columns = [pa.array(lang[cut], pa.int32()), pa.array(slot[cut], pa.int32()), pa.array(total[lang[cut], slot[cut]])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "slot", "n"])

    summed = slim.select("text", "lang").mapInArrow(count, "lang int, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    got = summed.toArrow()  # at most CELLS rows
    counts = np.zeros((len(names), size))
    counts[np.asarray(got["lang"]), np.asarray(got["slot"])] = np.asarray(got["n"])
    priors = np.array([r["count"] for r in shares], dtype=float)
    return Languages(names, np.log(priors / priors.sum()), log_table(counts), bits)


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text", none: str = "und") -> DataFrame:
    """Each document's likeliest language and its probability among the learned ones.

    A null or empty text or one without a letter gets ``none`` and 0, as every text does if nothing
    was learned. Whole texts are scored. Rows that repeat, share an id or have none are scored each by itself; an empty
    table gives an empty result; other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most CELLS numbers of 4 bytes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        names = np.array([*fitted.names, none], dtype=object)
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                best, probability = fitted.predict(part.column("text").to_pylist())
                columns = [part.column("id"), pa.array(names[best], pa.string()), pa.array(probability, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "lang_pred", "score"])

    return slim.mapInArrow(score, "id long, lang_pred string, score double").select(F.col("id").alias(id_col), "lang_pred", "score")
