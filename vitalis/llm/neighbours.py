"""Nearest neighbours by inner product: a block matrix join over int8 codes with error bounds.

Vectors are coded as one scale and int8 components and packed into tiles. A tile of queries and a
tile of candidates meet as a matrix product of codes, whose error is bounded by the norms of what
rounding lost. Only pairs whose upper bound reaches the k-th lower bound of their query are
computed again, in double precision from the original components, and merged by heaps.
Equal vectors are folded into one first, with as many of their ids as an answer can hold.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, settings, stage, width

QUERY_TILE, CANDIDATE_TILE = 512, 4096
TILE_BYTES = 16 << 20  # of a tile's components; long vectors come in smaller tiles
RUN = 1 << 21  # components of survivors that are multiplied at once
_EXACT = 1024  # products of so many code pairs add up exactly in float32

_TILE = "tile int, n int, dim int, sizes binary, ids binary, codes binary, scales binary, norms binary, errors binary, vectors binary"
_TILES = pa.schema(
    [("tile", pa.int32()), ("n", pa.int32()), ("dim", pa.int32())]
    + [(c, pa.binary()) for c in ("sizes", "ids", "codes", "scales", "norms", "errors", "vectors")]
)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part; of rows that share an id the least vector."""
    slim = fresh_columns(vectors, id=id_col, vector=vector_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return slim.filter(F.col("id").isNotNull() & finite & some).groupBy("id").agg(F.min("vector").alias("vector"))


def folded(rows: DataFrame, most: int) -> DataFrame:
    """(hash, vector, ids): each distinct vector once, with the ``most`` smallest of its ids in ascending order.

    Tasks leave out what is beyond the limit before they shuffle, so a vector that very many rows share costs little.
    """
    hashed = rows.withColumn("hash", F.xxhash64("vector"))
    order = Window.partitionBy("hash", "vector").orderBy("id")
    first = hashed.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most)
    return first.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most ``most`` ids


def _tiles(size: int):
    """Pack a partition's distinct vectors of equal dimension into tiles of at most ``size``."""

    def close(number: int, ids: list[list[int]], rows: list[np.ndarray]) -> pa.RecordBatch:
        x = np.stack(rows)
        scale = np.abs(x).max(axis=1) / 127
        scale[scale == 0] = np.finfo(float).tiny  # components too small to divide
        codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
        lost = np.linalg.norm(x - codes * scale[:, None], axis=1)
        sizes, flat = np.array([len(i) for i in ids], "<i8"), np.array([i for own in ids for i in own], "<i8")
        whole = [sizes, flat, codes, scale, np.linalg.norm(x, axis=1), lost, x.astype("<f8")]
        row = [[number], [len(ids)], [x.shape[1]]] + [[a.tobytes()] for a in whole]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _TILES)], schema=_TILES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[list[int]], list[np.ndarray]]] = {}
        number = TaskContext.get().partitionId() << 16
        for batch in batches:
            flat, at = np.asarray(batch.column("vector").flatten()), np.r_[0, np.cumsum(batch.column("vector").value_lengths())]
            for k, own in enumerate(batch.column("ids").to_pylist()):
                dim = int(at[k + 1] - at[k])
                ids, rows = held.setdefault(dim, ([], []))
                ids.append(own)
                rows.append(flat[at[k] : at[k + 1]])
                if len(ids) == max(1, min(size, TILE_BYTES // (8 * dim))):
                    yield close(number, *held.pop(dim))
                    number += 1
        for ids, rows in held.values():
            yield close(number, ids, rows)
            number += 1

    return run


class _Tile:
    def __init__(self, row: dict, side: str):
        n, dim = row[f"{side}n"], row["dim"]
        get = lambda c, kind: np.frombuffer(row[side + c], kind)
        sizes = get("sizes", "<i8")
        self.ids = np.split(get("ids", "<i8"), np.cumsum(sizes)[:-1])  # of each vector
        self.codes = get("codes", np.int8).reshape(n, dim)
        self.scales, self.norms, self.errors = get("scales", "f8"), get("norms", "f8"), get("errors", "f8")
        self.vectors = get("vectors", "<f8").reshape(n, dim)


def _code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 codes, through float32 matrix products."""
    parts = [a[:, s : s + _EXACT].astype(np.float32) @ b[:, s : s + _EXACT].astype(np.float32).T for s in range(0, a.shape[1], _EXACT)]
    return parts[0] if len(parts) == 1 else np.sum([p.astype(np.float64) for p in parts], axis=0)


def nearest_in_tiles(q: _Tile, c: _Tile, k: int, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query place, candidate place and exact score of every pair that may be among the k nearest, in runs of bounded size.

    ``floor`` is a lower bound of each query's k-th score so far and is raised in place; what the caller raises between
    runs counts too.
    """
    near = _code_products(q.codes, c.codes) * q.scales[:, None] * c.scales
    # q.c - q'.c' = q'.(c - c') + (q - q').c, so both products of norms bound the difference
    coded = np.linalg.norm(q.codes.astype(float), axis=1) * q.scales
    error = coded[:, None] * c.errors + q.errors[:, None] * c.norms
    error = error * (1 + 1e-9) + 1e-9 * q.norms[:, None] * c.norms  # rounding of this arithmetic itself
    if len(c.ids) >= k:
        np.maximum(floor, np.partition(near - error, len(c.ids) - k, axis=1)[:, len(c.ids) - k], out=floor)
    rows, cols = np.nonzero(near + error >= floor[:, None])
    high = (near + error)[rows, cols]
    step = max(1, RUN // max(1, q.vectors.shape[1]))
    for start in range(0, len(rows), step):
        part = slice(start, start + step)
        fits = high[part] >= floor[rows[part]]
        i, j = rows[part][fits], cols[part][fits]
        yield i, j, np.cumsum(q.vectors[i] * c.vectors[j], axis=1)[:, -1]  # added from left to right, as SQL would


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Each query's k candidates of largest inner product, nearest first, ties to the smaller id.

    Queries are the rows where ``is_query`` (over ``id``) holds; candidates are all rows but the
    query's own. Rows whose vector is null, zero, or holds null or non-finite components, and rows
    without id, take no part; vectors of different dimension don't meet. With fewer candidates all
    are returned; an empty table gives an empty result; other columns don't matter.
    """
    spark, most = vectors.sparkSession, k + 1  # a query's own id is among the nearest and goes at the end
    rows = usable(vectors, id_col, vector_col)
    rows = stage(rows.withColumn("query", F.coalesce(is_query, F.lit(False))), "vectors")
    distinct = stage(folded(rows.select("id", "vector"), most), "distinct-vectors")
    queries = rows.filter("query").select(F.col("id").alias("query_id"), "vector", F.xxhash64("vector").alias("hash"))
    queries = queries.join(distinct.select("hash", "vector", F.element_at("ids", 1).alias("head")), ["hash", "vector"])
    queries = stage(queries.select("query_id", "head"), "queries")  # the smallest id of equal vectors stands for them
    asked = distinct.join(queries.select("head").distinct(), F.element_at("ids", 1) == F.col("head"), "left_semi")
    tiles = distinct.select("ids", "vector").mapInArrow(_tiles(CANDIDATE_TILE), _TILE)
    asked = asked.select(F.slice("ids", 1, 1).alias("ids"), "vector").coalesce(max(2, width(spark) // 4))
    asked = asked.mapInArrow(_tiles(QUERY_TILE), _TILE).drop("tile")
    asked = asked.select(*(F.col(c).alias(f"q_{c}") if c != "dim" else F.col(c) for c in asked.columns))
    stripes = max(1, width(spark))  # candidate tiles are dealt to so many stripes, and every query tile visits each
    left = tiles.withColumn("stripe", F.pmod(F.xxhash64("tile", F.length("ids")), F.lit(stripes))).drop("tile")
    right = asked.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long"))))
    met = right.join(left.hint("shuffle_merge"), ["stripe", "dim"])  # a query tile meets the stripe's tiles in a row

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, floor = None, np.zeros(0)
        heaps: dict[int, list[tuple[float, int]]] = {}

        def drain() -> Iterator[pa.RecordBatch]:
            ids = [i for i, heap in heaps.items() for _ in heap]
            found = [x for heap in heaps.values() for x in heap]
            yield pa.RecordBatch.from_pydict(
                {"head": pa.array(ids, pa.int64()), "vec_id": pa.array([-i for _, i in found], pa.int64()),
                 "score": pa.array([s for s, _ in found], pa.float64())}
            )
            heaps.clear()

        for batch in batches:
            for place in range(batch.num_rows):
                (row,) = batch.slice(place, 1).to_pylist()
                q, c = _Tile(row, "q_"), _Tile(row, "")
                if row["q_ids"] != now:  # the next query tile
                    yield from drain()
                    now, floor = row["q_ids"], np.full(len(q.ids), -np.inf)
                heads = [int(i[0]) for i in q.ids]
                for places, others, scores in nearest_in_tiles(q, c, most, floor):
                    for i, j, s in zip(places.tolist(), others.tolist(), scores.tolist()):
                        heap = heaps.setdefault(heads[i], [])
                        for other in c.ids[j].tolist():
                            if len(heap) < most:
                                heapq.heappush(heap, (s, -other))
                            elif (s, -other) > heap[0]:
                                heapq.heapreplace(heap, (s, -other))
                            else:
                                break  # later ids of equal vectors stand behind this one
                        if len(heap) == most:
                            floor[i] = max(floor[i], heap[0][0])
        yield from drain()

    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):  # pairs of tiles are large rows
        found = stage(met.mapInArrow(score, "head long, vec_id long, score double"), "tile-neighbours")
    order = Window.partitionBy("head").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most)
    lists = ranked.groupBy("head").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))  # k + 1 each
    answers = queries.join(lists, "head")
    others = F.slice(F.filter("near", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    answers = answers.select("query_id", F.posexplode(others).alias("place", "e"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), F.col("e.vec_id").alias(id_col), F.col("e.score").alias("score"))
