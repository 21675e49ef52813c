"""Near duplicates by b-bit MinHash, confirmed on full shingle sets.

Of each document's minima only the two low bits are kept, packed into four longs. Documents that
agree on all minima of a band are candidates; the share of equal low bits, corrected for chance
agreement, tells which are worth comparing in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import (
    fresh_columns, lean, lower_ascii, mix, ragged, small_batches, stage, text_bytes, window_hashes, word_bounds, word_hashes,
)
from vitalis.llm.components import components
from vitalis.llm.exchange import groups_for

SHINGLE = 5
PERCENT = 75  # least similarity
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Estimates this far (in similarity) below the threshold are not compared in full. The estimate's
#: deviation at the threshold is 0.046, so that less than one link in ten million is lost.
MARGIN = 0.25
_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 2**63, MINIMA, dtype=np.uint64)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text (no nulls), ascending, and where each text's begin."""
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    count = np.diff(first)
    rows, hashes = [], []
    for size in range(1, SHINGLE + 1):
        own = np.flatnonzero(count >= SHINGLE if size == SHINGLE else count == size)
        if len(own):
            windows = window_hashes(words, size)
            n = count[own] - size + 1
            rows.append(np.repeat(own, n))
            hashes.append(mix(windows[ragged(first[own], n)] + np.uint64(size)))
    if not rows:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])]
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(texts) + 1))


def _reduce(how: np.ufunc, values: np.ndarray, first: np.ndarray, empty: int = 0) -> np.ndarray:
    """``how`` over each row's values; rows without any get ``empty``."""
    n = np.diff(first)
    out = np.full(len(n), empty, dtype=values.dtype)
    if len(values):
        out[n > 0] = how.reduceat(values, first[:-1][n > 0])
    return out


@lean
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n", "set1", "set2", "bands", "bits"]
    for batch in batches:
        for k in range(0, batch.num_rows, 1000):
            part = batch.slice(k, 1000)
            value, first = shingles(part.column("text"))
            set1, set2 = _reduce(np.add, mix(value), first), _reduce(np.bitwise_xor, mix(value * _A[0] + _B[0]), first)
            minima = np.stack([_reduce(np.minimum, value * a + b, first) for a, b in zip(_A, _B)], axis=1)
            bands = np.full((part.num_rows, BANDS), 0, dtype=np.uint64)
            for r in range(ROWS):
                bands = mix(bands * np.uint64(31) + minima[:, r::ROWS])
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
            # A product's low bits depend on few bits of the value; its finished hash gives the kept ones.
            low = (mix(minima) & np.uint64(3)).reshape(part.num_rows, 4, 32) << (2 * np.arange(32, dtype=np.uint64))
            bits = np.bitwise_or.reduce(low, axis=2)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1).view(np.int64)), x.shape[1]).cast(pa.list_(pa.int64()))
                for x in (np.ascontiguousarray(bands), np.ascontiguousarray(bits))
            ]
            sizes = pa.array(np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), sizes, pa.array(set1.view(np.int64)), pa.array(set2.view(np.int64)), *lists], names=names
            )


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed low bits: the share of equal slots, less what chance makes equal."""
    even = F.lit(0x5555555555555555)
    differ = sum(
        (F.bit_count((d := a[i].bitwiseXOR(b[i])).bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(even)) for i in range(4)),
        F.lit(0),
    )
    return (1 - differ / MINIMA - 0.25) / 0.75


def _near(x: Column, y: Column) -> Column:
    """Whether set sizes and packed bits leave it open that two sets are similar enough."""
    sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * PERCENT
    return sizes & (estimate(x["bits"], y["bits"]) >= PERCENT / 100 - MARGIN)


def _close(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) worth comparing in full."""
    x = signs.select(F.col("id").alias("a"), F.col("sign").alias("sx"))
    y = signs.select(F.col("id").alias("b"), F.col("sign").alias("sy"))
    return pairs.join(x, "a").join(y, "b").filter(_near(F.col("sx"), F.col("sy"))).select("a", "b").distinct()


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The packed shingle sets of the wanted ids."""

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                value, first = shingles(part.column("text"))
                packed = [value[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(packed, pa.binary())], names=["id", "set"])

    return docs.join(wanted, "id", "left_semi").mapInArrow(pack, "id long, set binary")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    second = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "sa", "sb").mapInArrow(confirm, "a long, b long")


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`estimate` of every row of ``a`` with every row of ``b``."""
    even = np.uint64(0x5555555555555555)
    differ = np.zeros((len(a), len(b)), dtype=np.int16)
    for i in range(a.shape[1]):
        d = a[:, None, i] ^ b[None, :, i]
        differ += np.bitwise_count((d | (d >> np.uint64(1))) & even).astype(np.int16)
    return (0.75 - differ / MINIMA) / 0.75


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every set of ``a`` with every set of ``b``."""
    values = np.concatenate([*a, *b])
    known, index, seen = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1  # what only one set holds is in no intersection
    sizes = np.array([len(x) for x in (*a, *b)])
    row, on = np.repeat(np.arange(len(sizes)), sizes), seen[index] > 1
    row, column = row[on], column[index[on]]
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for low in range(0, int((seen > 1).sum()), _COLUMNS):
        here = (column >= low) & (column < low + _COLUMNS)
        part = np.zeros((len(sizes), _COLUMNS), dtype=np.float32)
        part[row[here], column[here] - low] = 1
        out += part[: len(a)] @ part[len(a) :].T
    return out


_COLUMNS = 2048  # shingles of one matrix product
_CELL = 1024  # documents on a side of one


def _cell_links(ids: np.ndarray, component: np.ndarray, bits: np.ndarray, sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """Links that join different components of a cell: each joins what earlier ones left apart.

    ``side`` is 0 and 1 for the two blocks that meet, or all 0 where a block meets itself.
    """
    left, right = (np.flatnonzero(side == k) for k in ((0, 1) if side.any() else (0, 0)))
    open_ = (component[left][:, None] != component[right]) & (_estimates(bits[left], bits[right]) >= PERCENT / 100 - MARGIN)
    left, right = left[open_.any(axis=1)], right[open_.any(axis=0)]
    if not len(left):
        return []
    sizes = np.array([len(x) for x in sets])
    both = _common([sets[k] for k in left], [sets[k] for k in right])
    near = 100 * both >= PERCENT * (sizes[left][:, None] + sizes[right] - both)
    near &= component[left][:, None] != component[right]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(near)):
        a, b = root(int(component[left[i]])), root(int(component[right[j]]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(ids[left[i]]), int(ids[right[j]])))
    return out


def _across(placed: DataFrame, sets: DataFrame, groups: int) -> DataFrame:
    """Links between documents that share a band bucket but not yet a component.

    A bucket's documents meet as blocks of bounded size: estimates from packed bits tell which are
    worth comparing, their intersections come from matrix products, and only links that join
    components leave the task, never all pairs.
    """
    counts = placed.groupBy("band").agg(F.ceil(F.count("*") / _CELL).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = placed.join(counts, "band").withColumn("own", own).withColumn("other", other).join(sets, "id")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = ((F.col("own") == high) & (low != high)).cast("int")
    cut = cut.select("band", low.alias("low"), high.alias("high"), side.alias("side"), "id", "component", "bits", "set")
    cut = cut.withColumn("group", F.pmod(F.xxhash64("band", "low", "high"), F.lit(groups)))

    def meet(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("band", "ascending"), ("low", "ascending"), ("high", "ascending")])
        cell = np.stack([np.asarray(table[c]) for c in ("band", "low", "high")], axis=1)
        first = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)])
        columns = [np.asarray(table[c]) for c in ("id", "component", "side")]
        bits = np.asarray(table["bits"].combine_chunks().flatten()).view(np.uint64).reshape(len(cell), -1)
        packed, found = table["set"].combine_chunks(), []
        for a, b in zip(first, np.r_[first[1:], len(cell)]):
            ids, component, side = (c[a:b] for c in columns)
            if (component != component[0]).any():
                own = [np.frombuffer(packed[k].as_buffer(), dtype=np.uint64) for k in range(a, b)]
                found += _cell_links(ids, component, bits[a:b], own, side)
        pairs = np.array(sorted(set(found)), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return cut.groupBy("group").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per id: n_shingles, component_id (smallest id that links reach) and kept (it is that id).

    Documents of equal shingle sets form a class, and only its smallest id goes on. In every band
    bucket each document is compared with the bucket's smallest; after the components of those
    links, documents of one bucket but different components are compared too. So no link between
    different sets within a bucket is lost, and a bucket of thousands of copies makes no pairs
    within it.

    Null and empty texts have no shingles, are linked with nothing and kept. Rows that share an id
    are one document with the links of each, and its largest n_shingles. A row without id has no
    component and is kept. An empty table gives an empty result; other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col)
    slim = slim.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    kinds = "id long, n long, set1 long, set2 long, bands array<long>, bits array<long>"
    signed = small_batches(slim.mapInArrow(_signatures, kinds), "signatures")
    present = signed.filter("n > 0 AND id IS NOT NULL")
    classes = present.groupBy("set1", "set2", "n").agg(F.min("id").alias("rep"))
    member = stage(present.select("id", "set1", "set2", "n").join(classes, ["set1", "set2", "n"]).select("id", "rep", "set1", "set2", "n"), "members")
    text = ["id", "set1", "set2", "n"]  # an id may have several texts, each with its own bands
    reps = present.join(member.filter("id = rep").select(*text).distinct(), text, "left_semi")
    reps = reps.dropDuplicates(text).select("id", "n", "bits", "bands")
    rows = reps.select("id", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.min("id").alias("head"), F.max("id").alias("last"))
    rows = stage(rows.join(buckets.filter("head < last").select("band", "head"), "band"), "buckets")
    signs = reps.select("id", F.struct("n", "bits").alias("sign"))
    sets = stage(_sets(slim.filter("id IS NOT NULL"), rows.select("id").distinct()), "sets")
    stars = rows.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    stars = stage(_close(stars, signs), "star-pairs")
    links = stage(_linked(stars, sets), "star-links")
    found = components(links)
    placed = rows.select("band", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(mixed.filter("low < high").select("band"), "band").join(signs, "id")
    placed = stage(placed.select("band", "id", "component", "sign.bits"), "mixed-buckets")
    more = _across(placed, sets, groups_for(docs))
    shared = member.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    repeated = member.join(shared.select("id"), "id", "left_semi").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    whole = components(links.unionByName(more).unionByName(repeated))
    of_rep = member.select("id", "rep").distinct().join(whole.withColumnRenamed("node", "rep"), "rep", "left")
    of_id = of_rep.groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    sized = signed.groupBy("id").agg(F.max("n").alias("n_shingles"))
    lone = signed.filter("id IS NULL").select("id", F.col("n").alias("n_shingles"))
    out = sized.filter("id IS NOT NULL").join(of_id, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    out = out.unionByName(lone.withColumn("component_id", F.lit(None).cast("long")))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", kept.alias("kept"))
