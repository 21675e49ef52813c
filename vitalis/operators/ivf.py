"""Approximate search by an inverted file with residual product codes.

Vectors are dealt to the cells of a k-means partition, a folder each. What a vector differs from its cell's
centre by is coded in parts, each part by its nearest codeword. A query visits the cells of its nearest
centres, adds up code scores from small tables, and scores the best of them exactly. How many
cells to visit is raised until the recall measured on vectors of the index itself is reached; visiting all
cells and refining all rows is the exact search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.operators import vectors
from vitalis.operators.vectors import top_k_per
from vitalis.session import scratch_path

BLOCK, TILE = 4096, 256  # rows of a cell, queries of a cell that meet at once
STEP, PLACED = 1024, 16_384  # rows that meet all centres at once, (query, cell) rows handed on at once
_SEED = 23


def lloyd(x: np.ndarray, k: int, steps: int = 10, seed: int = 1) -> np.ndarray:
    """k-means centres; a centre that loses all its points moves to a random one."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = nearest(x, centres, 1)[:, 0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, weights=x[:, d], minlength=len(centres)) for d in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), len(centres))])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` centres nearest to each row, nearest first; ``STEP`` rows meet the centres at once."""
    squares, out = (centres**2).sum(axis=1), np.zeros((len(x), min(n, len(centres))), np.int64)
    for k in range(0, len(x), STEP):
        far = squares - 2 * x[k : k + STEP] @ centres.T
        out[k : k + STEP] = far.argmin(axis=1)[:, None] if n == 1 else np.argsort(far, axis=1, kind="stable")[:, :n]
    return out


@dataclass(frozen=True)
class Codebook:
    """Cell centres, and for each part of the components its codewords."""

    centres: np.ndarray
    parts: list[np.ndarray]  # columns of each part
    words: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, part: int = 8, words: int = 256) -> "Codebook":
        centres = lloyd(x, cells)
        rest = x - centres[nearest(x, centres, 1)[:, 0]]
        parts = np.array_split(np.arange(x.shape[1]), max(1, x.shape[1] // part))
        return cls(centres, parts, [lloyd(rest[:, p], words, seed=2 + k) for k, p in enumerate(parts)])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = nearest(x, self.centres, 1)[:, 0]
        rest = x - self.centres[cell]
        return cell, np.stack([nearest(rest[:, p], w, 1)[:, 0] for p, w in zip(self.parts, self.words)], axis=1).astype(np.uint8)

    def scores(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Inner product of one query with the coded vectors of a cell, from a table of each part."""
        total = np.full(len(codes), float(q @ self.centres[cell]))
        for k, (p, w) in enumerate(zip(self.parts, self.words)):
            total += (w @ q[p])[codes[:, k]]
        return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("embedding").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)


_VALID = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(embedding, x -> x <> 0)"


class IvfIndex:
    """An index of (id bigint, embedding array) rows by inner product of unit vectors.

    Rows whose vector is null, zero or holds null or non-finite components are left out. Centres and codewords are fitted on at
    most ``sample`` rows, those of the smallest seeded hash of their id; every row is indexed.
    """

    def __init__(self, spark: SparkSession, path: str, book: Codebook, probes: int = 1, refine: int = 8, recall: float | None = None) -> None:
        self.spark, self.path, self.book = spark, path, book
        self.probes, self.refine, self.recall = probes, refine, recall

    @classmethod
    def build(cls, rows: DataFrame, path: str | None = None, cells: int | None = None, sample: int = 20_000) -> "IvfIndex":
        """Fit on the sample and write one folder per cell. ``cells`` is the root of the row count by default, 1,024 at most."""
        spark = rows.sparkSession
        rows = rows.select(F.col("id").cast("bigint").alias("id"), "embedding").filter("id IS NOT NULL").filter(_VALID)
        picked = rows.orderBy(F.xxhash64("id", F.lit(_SEED)), "id").limit(sample).toArrow()
        if not picked.num_rows:
            raise ValueError("nothing to index")
        x = _unit(_rows(picked.combine_chunks().to_batches()[0]))
        book = Codebook.fit(x, cells or int(np.clip(round(rows.count() ** 0.5), 1, 1024)))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cell, codes = book.encode(_unit(_rows(batch)))
                    columns = [pa.array(cell, pa.int32()), batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column("embedding")]
                    yield pa.RecordBatch.from_arrays(columns, names=["cell", "id", "codes", "embedding"])

        kind = dict(rows.dtypes)["embedding"]
        coded = rows.mapInArrow(code, f"cell int, id bigint, codes binary, embedding {kind}")
        path = path or scratch_path(spark, "ivf")
        coded.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)  # large cells get several files
        return cls(spark, path, book)

    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def _blocks(self) -> DataFrame:
        """Rows of one cell packed together."""

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n, cell = [], 0, None  # rows of one cell: a file has no other, so the next cell closes the one before

            def close() -> pa.RecordBatch:
                own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                row = [cell, np.asarray(own.column("id")).astype("<i8").tobytes(), b"".join(own.column("codes").to_pylist()), _unit(_rows(own)).tobytes()]
                return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["cell", "ids", "codes", "rows"])

            for batch in batches:
                cells, at = np.asarray(batch.column("cell")), 0
                while at < len(cells):
                    if n and (n == BLOCK or cells[at] != cell):
                        yield close()
                        held, n = [], 0
                    cell = int(cells[at])
                    same = cells[at : at + BLOCK - n] == cell
                    run = len(same) if same.all() else int(same.argmin())
                    held.append(batch.slice(at, run))
                    n, at = n + run, at + run
            if n:
                yield close()

        return self.vectors().select("cell", "id", "codes", "embedding").mapInArrow(pack, "cell bigint, ids binary, codes binary, rows binary")

    def _asked(self, queries: DataFrame, probes: int) -> DataFrame:
        """Each query under the cells it visits, packed by cell; a cell that very many visit comes in several tiles."""
        book = self.book

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, PLACED // probes)
            for whole in batches:
                for k in range(0, whole.num_rows, step):
                    batch = whole.slice(k, step)
                    q = _unit(_rows(batch))
                    cells = nearest(q, book.centres, probes)
                    at = np.repeat(np.arange(len(q)), cells.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells.ravel(), pa.int64()), batch.column("query_id").take(pa.array(at)), pa.array([q[k].tobytes() for k in at], pa.binary())],
                        names=["cell", "query_id", "q"],
                    )

        placed = queries.filter(_VALID).select(F.col("query_id").cast("bigint").alias("query_id"), "embedding")
        placed = placed.mapInArrow(place, "cell bigint, query_id bigint, q binary")
        tile = F.pmod(F.xxhash64("query_id"), F.ceil(F.col("n") / TILE)).cast("int")
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))  # a row per cell
        dealt = placed.join(F.broadcast(sizes), "cell").withColumn("tile", tile)
        return dealt.groupBy("cell", "tile").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))  # about TILE queries

    def search(self, queries: DataFrame, k: int, skip_same: bool = False, probes: int | None = None, refine: int | None = None, digits: int = 9) -> DataFrame:
        """(query_id, rank, id, score): the ``k`` best rows found, exact scores, ties to the smaller id."""
        book, most = self.book, k + skip_same
        probes, refine = min(probes or self.probes, len(book.centres)), refine or self.refine

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):  # one block at a time leaves the batch
                    row = batch.slice(at, 1).to_pylist()[0]
                    ids = np.frombuffer(row["ids"], "<i8")
                    codes, rows = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1), np.frombuffer(row["rows"], "<f8").reshape(len(ids), -1)
                    out = []
                    for asked in row["asked"]:
                        q = np.frombuffer(asked["q"], "<f8")
                        near = book.scores(q, row["cell"], codes)
                        keep = np.arange(len(ids)) if len(ids) <= refine * most else np.argpartition(-near, refine * most)[: refine * most]
                        if skip_same:
                            keep = keep[ids[keep] != asked["query_id"]]
                        exact = np.round(rows[keep] @ q, digits)
                        best = np.lexsort((ids[keep], -exact))[:k]
                        out.append((np.full(len(best), asked["query_id"]), ids[keep][best], exact[best]))
                    columns = [np.concatenate(c) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])], names=["query_id", "id", "score"])

        met = self._asked(queries, probes).join(self._blocks().hint("shuffle_merge"), "cell").drop("tile")
        hits = met.mapInArrow(score, "query_id bigint, id bigint, score double")
        return top_k_per(hits, ["query_id"], [F.desc("score"), "id"], k)

    def tune(self, k: int, target: float = 0.95, held_out: int = 128) -> "IvfIndex":
        """The index with enough probes: doubled until rows of the index, taken as queries, find ``target`` of
        their true neighbours; at all cells the refined rows are doubled instead. ``recall`` is what was measured."""
        rows = self.vectors().select("id", "embedding")
        asked = rows.orderBy(F.xxhash64("id", F.lit(_SEED + 1)), "id").limit(held_out).select(F.col("id").alias("query_id"), "embedding")
        asked = self.spark.createDataFrame(asked.toArrow(), asked.schema)
        unit = vectors.l2_normalize("embedding").alias("embedding")
        truth = vectors.search(asked.select("query_id", unit), rows.select("id", unit), k, skip_same=True).select("query_id", "id").toPandas()
        probes, refine, cells = self.probes, self.refine, len(self.book.centres)
        while True:
            found = self.search(asked, k, True, probes, refine).select("query_id", "id").toPandas()
            recall = len(pd.merge(found, truth)) / max(1, len(truth))
            if recall >= target or (probes >= cells and refine > 4096):
                return IvfIndex(self.spark, self.path, self.book, min(probes, cells), refine, recall)
            probes, refine = (2 * probes, refine) if probes < cells else (probes, 2 * refine)


def recall_of(found: DataFrame, exact: DataFrame) -> float | None:
    """Share of the exact hits, by (query_id, id), that were found."""
    hits = exact.select("query_id", "id").join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return hits.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
