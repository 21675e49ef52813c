"""Hard negatives by inner product: buckets of like length with sorted lists of coordinates.

Rows are dealt into buckets of similar length. A bucket lists, for every coordinate, its rows in the order
of that coordinate of their unit vectors. A score that an anchor still needs bounds the angle to any row of
the bucket, and so the range that each coordinate of such a row can have. The ranges of the anchor's
largest (focus) coordinates are cut out of the lists; rows that lie in all of them are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, settings, stage, width

BUCKET, TILE = 4096, 256  # rows of a bucket, anchors of a tile
BYTES = 16 << 20  # of a bucket's or tile's components; fewer rows where vectors are long
FOCUS = 6  # coordinates of an anchor whose ranges are intersected
LIMIT = 1 << 26  # components beyond it count as it

_BUCKET = "bucket long, n int, dim int, ids binary, labels binary, rows binary, orders binary"
_TILE = "n int, dim int, ids binary, labels binary, rows binary, asked binary"


def whole(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null if any component is null or not finite."""
    vector = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    near = lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x * scale))
    return F.when(fine, F.transform(vector, lambda x: F.floor(near(x)).cast("int")))


def _room(dim: int, most: int) -> int:
    return max(1, min(most, BYTES // (8 * max(1, dim))))


def _packed(most: int, pack, schema: str):
    """Partition's rows of equal dimension, packed by ``pack(number, dim, rows)`` in groups of at most ``most``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            vectors = batch.column("vector")
            flat, at = np.asarray(vectors.flatten()), np.r_[0, np.cumsum(vectors.value_lengths())].tolist()
            others = [batch.column(c).to_pylist() for c in batch.schema.names if c not in ("vector", "length")]
            for k, rest in enumerate(zip(*others)):
                dim = at[k + 1] - at[k]
                rows = held.setdefault(dim, [])
                rows.append((*rest, flat[at[k] : at[k + 1]]))
                if len(rows) == _room(dim, most):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, pack(number, dim, held.pop(dim))))], schema=kinds)
                    number += 1
        for dim, rows in held.items():
            yield pa.RecordBatch.from_pylist([dict(zip(names, pack(number, dim, rows)))], schema=kinds)
            number += 1

    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])
    return run


def _pack_bucket(number: int, dim: int, rows: list[tuple]) -> tuple:
    ids, labels, vectors = zip(*rows)
    x = np.stack(vectors).astype("<i4").reshape(len(rows), dim)
    orders = np.argsort(_units(x), axis=0, kind="stable").T.astype("<u2")
    return number, len(rows), dim, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), x.tobytes(), orders.tobytes()


def _pack_tile(number: int, dim: int, rows: list[tuple]) -> tuple:
    """``asked`` holds how many positives each anchor has, then their (id, score)."""
    ids, labels, positives, vectors = zip(*rows)
    asked = [len(p or []) for p in positives] + [v for p in positives for e in p or [] for v in (e["id"], e["score"])]
    x = np.stack(vectors).astype("<i4").reshape(len(rows), dim)
    return len(rows), dim, np.array(ids, "<i8").tobytes(), np.array(labels, "<i8").tobytes(), x.tobytes(), np.array(asked, "<i8").tobytes()


def _units(x: np.ndarray) -> np.ndarray:
    """Rows over their lengths; zero rows stay zero."""
    length = np.linalg.norm(x.astype(np.float64), axis=1)
    return x / np.where(length > 0, length, 1)[:, None]


class Bucket:
    """Rows with, for every coordinate, their order and its sorted values."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, orders: np.ndarray) -> None:
        self.ids, self.labels, self.rows, self.orders = ids, labels, rows.astype(np.float64), orders
        self.longest = float(np.linalg.norm(self.rows, axis=1).max(initial=0))
        self.largest = float(np.abs(self.rows).max(initial=0))
        self.sorted = np.take_along_axis(_units(rows).T, orders.astype(np.int64), axis=1)

    def within(self, anchor: "Anchor", needed: float) -> np.ndarray | None:
        """Places of rows whose score may be ``needed`` or more; None for all of them."""
        if needed <= 0 or not anchor.length:  # short rows are as good as any
            return None
        cosine = needed / (anchor.length * self.longest) if self.longest else np.inf
        if cosine > 1 + 1e-9:
            return np.zeros(0, dtype=np.int64)
        angle = np.arccos(min(1.0, cosine))
        low = np.cos(np.minimum(np.pi, anchor.angles + angle)) - 1e-9  # allows for rounding
        high = np.cos(np.maximum(0.0, anchor.angles - angle)) + 1e-9
        n, hits, used = len(self.ids), None, 0
        for f, a, b in zip(anchor.focus, low, high):
            begin, past = np.searchsorted(self.sorted[f], (a, b))
            if past - begin == n:
                continue  # every row is feasible here
            if hits is None:
                hits = np.zeros(n, dtype=np.uint8)
            hits[self.orders[f][begin:past]] += 1
            used += 1
        return None if hits is None else np.flatnonzero(hits == used)

    def scores(self, anchor: "Anchor", places: np.ndarray | None) -> np.ndarray:
        """Exact inner products with the rows at ``places``, as whole numbers."""
        rows = self.rows if places is None else self.rows[places]
        if anchor.largest * self.largest * max(1, rows.shape[1]) < 2.0**53:  # doubles hold every sum
            return (rows @ anchor.vector.astype(np.float64)).astype(np.int64)
        return rows.astype(np.int64) @ anchor.vector


class Anchor:
    def __init__(self, id_: int, label: int, vector: np.ndarray, positives: list[tuple[int, int]]) -> None:
        self.id, self.label, self.vector, self.positives = id_, label, vector.astype(np.int64), positives
        self.length, self.largest = float(np.linalg.norm(vector.astype(np.float64))), float(np.abs(vector).max(initial=0))
        unit = vector / self.length if self.length else vector.astype(np.float64)
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(unit[self.focus], -1, 1))
        self.found: list[tuple[np.ndarray, np.ndarray]] = []  # best scores and ids, per positive or one

    def best(self, k: int, j: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge into the ``k`` best of list ``j``: higher scores first, ties by smaller id."""
        old_scores, old_ids = self.found[j]
        if len(old_scores) == k and len(scores):
            fits = scores >= old_scores[-1]
            scores, ids = scores[fits], ids[fits]
        if not len(scores):
            return
        if len(scores) > 8 * k:  # what is below the k-th score goes before the sort
            fits = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, ids = scores[fits], ids[fits]
        scores, ids = np.r_[old_scores, scores], np.r_[old_ids, ids]
        order = np.lexsort((ids, -scores))[:k]
        self.found[j] = scores[order], ids[order]


def _none() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)


def seek_positives(anchor: Anchor, bucket: Bucket, k: int) -> None:
    """Raise the anchor's ``k`` best rows of its own label by those of a bucket."""
    if not anchor.found:
        anchor.found = [_none()]
    scores = anchor.found[0][0]
    places = bucket.within(anchor, float(scores[-1]) if len(scores) == k else -np.inf)
    ids, labels = (bucket.ids, bucket.labels) if places is None else (bucket.ids[places], bucket.labels[places])
    fits = (labels == anchor.label) & (ids != anchor.id)
    if fits.any():
        anchor.best(k, 0, bucket.scores(anchor, places)[fits], ids[fits])


def seek_negatives(anchor: Anchor, bucket: Bucket, k: int, least: int) -> None:
    """Raise, for each positive, the ``k`` best rows of other labels that score between ``least`` hundredths of it and it."""
    if not anchor.found:
        anchor.found = [_none() for _ in anchor.positives]
    asked = [(j, s) for j, (_, s) in enumerate(anchor.positives) if s >= 0]  # none lies between for a score below zero
    needed = [max(-(-least * s // 100), int(anchor.found[j][0][-1]) if len(anchor.found[j][0]) == k else 0) for j, s in asked]
    if not asked:
        return
    places = bucket.within(anchor, float(min(needed)))
    ids, labels = (bucket.ids, bucket.labels) if places is None else (bucket.ids[places], bucket.labels[places])
    fits = labels != anchor.label
    if not fits.any():
        return
    scores, ids = bucket.scores(anchor, places)[fits], ids[fits]
    for (j, s), low in zip(asked, needed):
        between = (scores >= low) & (scores <= s)
        if between.any():
            anchor.best(k, j, scores[between], ids[between])


def _anchors(row: dict) -> list[Anchor]:
    n, dim = row["q_n"], row["dim"]
    ids, labels = np.frombuffer(row["q_ids"], "<i8").tolist(), np.frombuffer(row["q_labels"], "<i8").tolist()
    vectors, asked = np.frombuffer(row["q_rows"], "<i4").reshape(n, dim), np.frombuffer(row["asked"], "<i8")
    pairs, ends = asked[n:].reshape(-1, 2).tolist(), np.cumsum(asked[:n]).tolist()
    return [Anchor(i, label, v, [tuple(p) for p in pairs[b:e]]) for i, label, v, b, e in zip(ids, labels, vectors, [0, *ends], ends)]


def _bucket(row: dict) -> Bucket:
    n, dim = row["n"], row["dim"]
    rows, orders = np.frombuffer(row["rows"], "<i4").reshape(n, dim), np.frombuffer(row["orders"], "<u2").reshape(dim, n)
    return Bucket(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), rows, orders)


def _search(buckets: DataFrame, anchors: DataFrame, seek, name: str) -> DataFrame:
    """(anchor, positive, positive_score, id, score): each tile of anchors visits every stripe of buckets."""
    spark = buckets.sparkSession
    stripes = max(1, width(spark))
    tiles = anchors.mapInArrow(_packed(TILE, _pack_tile, _TILE), _TILE)
    tiles = tiles.select("dim", "asked", *(F.col(c).alias(f"q_{c}") for c in ("n", "ids", "labels", "rows")))
    tiles = tiles.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    left = buckets.withColumn("stripe", F.pmod(F.xxhash64("bucket"), F.lit(stripes)).cast("int"))
    met = tiles.join(left.hint("shuffle_merge"), ["stripe", "dim"])
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "positive", "positive_score", "id", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def drain() -> Iterator[pa.RecordBatch]:
            for a in held:
                for j, (scores, ids) in enumerate(a.found):
                    positive, s = a.positives[j] if a.positives else (0, 0)
                    columns = [np.full(len(ids), a.id), np.full(len(ids), positive), np.full(len(ids), s), ids, scores]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if row["q_ids"] != now:
                    yield from drain()
                    now, held = row["q_ids"], _anchors(row)
                bucket = _bucket(row)
                for a in held:
                    seek(a, bucket)
        yield from drain()

    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}):  # pairs of a tile and a bucket are large rows
        return stage(met.mapInArrow(run, "anchor long, positive long, positive_score long, id long, score long"), name)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, id_col: str = "vec_id",
    vector_col: str = "vector", label_col: str = "label",
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels that
    score at least ``least`` hundredths of the positive and no more than it.

    ``vector_col`` holds whole numbers (see ``whole``), ``is_anchor`` is over ``id``. A score is the inner product
    with the anchor; higher ones come first, ties by smaller id. Rows with a null id, label or vector, or a null component
    take no part; of rows that share an id one counts, the one of least vector and label. Rows of other
    dimensions than the anchor's don't meet it. All positives or negatives are returned where there are
    fewer, none for a positive of negative score; an empty table gives an empty result; other columns don't matter.
    """
    spark = rows.sparkSession
    slim = fresh_columns(rows, id=id_col, label=label_col, vector=vector_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<int>").alias("vector"))
    slim = slim.filter("id IS NOT NULL AND label IS NOT NULL").filter(F.forall("vector", lambda x: x.isNotNull()))
    one = slim.groupBy("id").agg(F.min(F.struct("vector", "label")).alias("r")).select("id", "r.label", "r.vector")
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    one = stage(one.withColumn("length", length).withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), "negatives-rows")
    by_length = one.select("id", "label", "vector", "length").repartitionByRange(width(spark), F.desc("length"), F.xxhash64("id"))
    buckets = by_length.sortWithinPartitions(F.desc("length")).mapInArrow(_packed(BUCKET, _pack_bucket, _BUCKET), _BUCKET)
    buckets = stage(buckets, "negatives-buckets")

    anchors = one.filter("anchor").select("id", "label", "vector").coalesce(max(1, width(spark) // 8))
    asked = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")
    first = _search(buckets, anchors.select("id", "label", asked.alias("positives"), "vector"), lambda a, b: seek_positives(a, b, positives), "positives")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = first.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= positives)
    first = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("p"))  # at most ``positives``
    listed = F.transform("p", lambda e: F.struct(e["id"].alias("id"), e["score"].alias("score")))
    anchors = anchors.join(first.select(F.col("anchor").alias("id"), listed.alias("positives")), "id")
    anchors = stage(anchors.select("id", "label", "positives", "vector"), "negatives-anchors").coalesce(max(1, width(spark) // 8))

    found = _search(buckets, anchors, lambda a, b: seek_negatives(a, b, negatives, least), "negatives")
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
