"""Ranks, running sums and exact quantiles that no single task has to see whole.

``row_number() over (partition by g ...)`` and ``percentile`` send all rows of a group to one
task. Here the order is first cut into ranges; counts per (group, range) give each range its
offset, and only the inside of one range is sorted by one task. A group holding most of the
table is therefore spread over as many tasks as there are ranges.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.session import travelling

HEX_DIGITS = 3  # at least 16**3 ranges of the md5 order
RANGES = 256  # at least so many ranges of a numeric order
ROWS = 1 << 20  # rows of a range, beyond which there are more ranges
_FINER = 4096  # each of the first ranges is cut into so many at most


def hash_key(key: Sequence[str], seed: str) -> Column:
    """Hex md5 of the key columns and a seed: the same on every engine and partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(seed)))


def hash_fraction_bucket(digest: Column, buckets: int = 10000) -> Column:
    """Map an md5 hex string to ``0..buckets-1`` by its first 32 bits."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def _offsets(df: DataFrame, group: list[str], ranges: list[str], weight: Column) -> DataFrame:
    """Per (group, range): the weight of all earlier ranges, and of the whole group."""
    counts = df.groupBy(*group, *ranges).agg(F.sum(weight).alias("_w"))
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = by_group.orderBy(*ranges).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *group,
        *ranges,
        F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_w").over(by_group).alias("group_total"),
    )


def _join_offsets(
    df: DataFrame,
    offsets: DataFrame,
    group: list[str],
    ranges: list[str],
    carry: Sequence[str] = ("_before", "group_total"),
) -> DataFrame:
    on = [*ranges, *group]
    renamed = travelling(offsets.select(*[F.col(c).alias(f"_o_{c}") for c in on], *carry))
    cond = F.lit(True)
    for c in ranges:
        cond = cond & (F.col(c) == F.col(f"_o_{c}"))
    for c in group:  # a group may be the null group
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return df.join(renamed, cond).drop(*[f"_o_{c}" for c in on])


def hash_rank(
    df: DataFrame, group: Sequence[str], key: Sequence[str], seed: str, out: str = "hash_rank"
) -> DataFrame:
    """Rank (from 1) of each row of its group in md5 order, plus ``group_total``."""
    group, key = list(group), list(key)
    digits = max(HEX_DIGITS, math.ceil(math.log(max(1, df.count()) / ROWS, 16)))
    cut = df.withColumn("_h", hash_key(key, seed))
    cut = cut.withColumn("_r", F.substring("_h", 1, digits))
    offsets = _offsets(cut, group, ["_r"], F.lit(1))
    inside = Window.partitionBy(*group, "_r").orderBy("_h", *key)
    ranked = cut.withColumn("_n", F.row_number().over(inside))
    return (
        _join_offsets(ranked, offsets, group, ["_r"])
        .withColumn(out, F.col("_before") + F.col("_n"))
        .drop("_h", "_r", "_n", "_before")
    )


def hash_edges(
    df: DataFrame, group: Sequence[str], key: Sequence[str], seed: str, edges: Mapping[str, Column]
) -> DataFrame:
    """Per group and edge the md5 of its row of that rank in md5 order, null for rank 0 or none.

    ``edges`` are ranks as expressions over ``group_total``. Counts by prefix tell in which of
    65,536 ranges a rank lies; only that range's rows are ranked, so the table itself never moves.
    """
    names = list(group)
    group = [f"_g{i}" for i in range(len(names))]
    cut = df.select(*(F.col(n).alias(g) for n, g in zip(names, group)), hash_key(key, seed).alias("_h"))
    cut = cut.withColumn("_r", F.substring("_h", 1, 4))
    counts = cut.groupBy(*group, "_r").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    counts = counts.withColumn("group_total", F.sum("_n").over(whole))
    earlier = F.coalesce(F.sum("_n").over(whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("_before", earlier)
    wanted = F.explode(F.array(*(F.struct(F.lit(n).alias("edge"), e.cast("bigint").alias("rank")) for n, e in edges.items())))
    places = counts.select(*group, "_r", "_n", "_before", wanted.alias("_e")).select("*", "_e.edge", "_e.rank")
    # one row for each group and edge
    places = travelling(places.filter((F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_before") + F.col("_n"))))
    own = [F.col(f"_p.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in [*group, "_r"]]
    near = cut.alias("_c").join(places.alias("_p"), functools.reduce(lambda a, b: a & b, own))
    near = near.select(*(F.col(f"_c.{c}").alias(c) for c in [*group, "_r"]), "_h", "edge", (F.col("rank") - F.col("_before")).alias("_want"))
    place = F.row_number().over(Window.partitionBy(*group, "_r", "edge").orderBy("_h"))
    found = near.withColumn("_place", place).filter("_place = _want")
    at = [F.max(F.when(F.col("edge") == n, F.col("_h"))).alias(n) for n in edges]
    return (found.groupBy(*group).agg(*at) if group else found.agg(*at)).withColumnsRenamed(dict(zip(group, names)))


def as_number(df: DataFrame, column: str) -> Column:
    """A double in the same order as a numeric, date or timestamp column."""
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):  # no zone: count seconds from the fields themselves
        day = F.unix_date(c.cast("date")).cast("double") * 86400
        return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def range_cuts(df: DataFrame, columns: Sequence[str], ranges: int = RANGES) -> dict[str, list[float]]:
    """Approximate equal-mass cut points of numeric columns.

    One pass cuts into ``ranges``; if that leaves more than ``ROWS`` rows to a range, a second one
    cuts each of these again, so that the number of ranges follows the rows. The cut points only
    balance the work; results built on them are exact. A value that fills several ranges alone is
    isolated in a range of its own.
    """
    steps = [i / ranges for i in range(1, ranges)]
    numbers = df.select(*[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    row = numbers.agg(
        F.count(F.lit(1)), *[F.percentile_approx(c, steps, 20 * ranges).alias(c) for c in numbers.columns]
    ).first()
    finer = min(_FINER, math.ceil(row[0] / (ranges * ROWS)))
    cuts = {}
    for i, c in enumerate(columns):
        found = [v for v in (row[i + 1] or []) if v is not None and not math.isnan(v)]
        cuts[c] = _isolated(found)
        if finer > 1:
            cuts[c] = sorted({*cuts[c], *_isolated(_finer_cuts(numbers.select(f"c{i}"), cuts[c], finer))})
    return cuts


def _isolated(found: list[float]) -> list[float]:
    """Sorted cut points with a repeated one as a range of its own."""
    repeated = {a for a, b in zip(found, found[1:]) if a == b}
    return sorted(set(found) | {math.nextafter(v, math.inf) for v in repeated})


def _finer_cuts(numbers: DataFrame, cuts: list[float], finer: int) -> list[float]:
    """Cut points inside each range between ``cuts``, at most ``finer`` - 1 for one."""
    (name,) = numbers.columns
    steps = [i / finer for i in range(1, finer)]
    cut = add_range(numbers.filter(F.col(name).isNotNull() & ~F.isnan(name)), name, cuts, "_r")
    inner = cut.groupBy("_r").agg(F.percentile_approx(name, steps, 20 * finer).alias("_c")).select(F.explode("_c").alias("_c"))
    return sorted(v for v in inner.toArrow()["_c"].to_pylist() if math.isfinite(v))


def add_range(df: DataFrame, column: str, cuts: list[float], out: str) -> DataFrame:
    """The index of the cut range a numeric or timestamp column falls in."""
    splits = [-math.inf, *[c for c in cuts if math.isfinite(c)], math.inf]
    if len(splits) < 3:
        splits = [-math.inf, 0.0, math.inf]
    as_double = f"_d_{out}"
    cut = df.withColumn(as_double, as_number(df, column))
    cut = Bucketizer(splits=splits, inputCol=as_double, outputCol=out, handleInvalid="keep").transform(cut)
    return cut.withColumn(out, F.col(out).cast("int")).drop(as_double)


def ordered_rank(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    key: str,
    out: str = "seq",
    ranges: int = RANGES,
) -> DataFrame:
    """Rank from 0 of each row of its group by (``order``, ``key``), both numeric or timestamp.

    Also adds ``group_total``. An ``order`` value that repeats too often for one task is cut
    again by ``key``.
    """
    group = list(group)
    cuts = range_cuts(df, [order, key], ranges)
    cut = add_range(df, order, cuts[order], "_r1")
    known = set(cuts[order])
    repeated = [c for c in cuts[order] if math.nextafter(c, math.inf) in known]
    if repeated:
        cut = add_range(cut, key, cuts[key], "_r2")
        is_repeated = as_number(df, order).isin(repeated)
        cut = cut.withColumn("_r2", F.when(is_repeated, F.col("_r2")).otherwise(F.lit(0)))
    else:
        cut = cut.withColumn("_r2", F.lit(0))
    offsets = _offsets(cut, group, ["_r1", "_r2"], F.lit(1))
    inside = Window.partitionBy(*group, "_r1", "_r2").orderBy(order, key)
    ranked = cut.withColumn("_n", F.row_number().over(inside))
    return (
        _join_offsets(ranked, offsets, group, ["_r1", "_r2"])
        .withColumn(out, F.col("_before") + F.col("_n") - 1)
        .drop("_r1", "_r2", "_n", "_before")
    )


def _long_values(df: DataFrame, group: list[str], columns: list[str], weight: Column | None, ranges: int) -> DataFrame:
    """(group, metric, value, its range, weight) of all present values."""
    cuts = range_cuts(df, columns, ranges)
    cut = df.withColumn("_weight", weight if weight is not None else F.lit(1).cast("bigint"))
    for i, c in enumerate(columns):
        cut = add_range(cut, c, cuts[c], f"_range{i}")
    cells = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"), F.col(f"_range{i}").alias("_r"))
        for i, c in enumerate(columns)
    ]
    long = cut.select(*group, "_weight", F.inline(F.array(*cells)))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def first_reaching(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    thresholds: Mapping[str, Callable[[Column], Column]],
    weight: Column | None = None,
    ranges: int = RANGES,
) -> DataFrame:
    """Per (group, metric) and threshold the first value whose running weight reaches it.

    ``thresholds`` maps an output name to a function of the group's total weight. The weights of
    the ranges say which of them hold an answer; only the rows of those few ranges are shuffled,
    and they collapse to distinct values before they are sorted.
    """
    group, columns = list(group), list(columns)
    long = _long_values(df, group, columns, weight, ranges)
    by = [*group, "metric"]
    sums = long.groupBy(*by, "_r").agg(F.sum("_weight").alias("_w"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumns(
        {"_before": F.coalesce(F.sum("_w").over(earlier), F.lit(0)), "_total": F.sum("_w").over(whole)}
    )
    holds = F.lit(False)
    for reach in thresholds.values():
        t = reach(F.col("_total"))
        holds = holds | ((F.col("_before") < t) & (t <= F.col("_before") + F.col("_w")))
    targets = placed.filter(holds).drop("_w")
    # the few targets travel, and all other rows stay where they are
    values = _join_offsets(long, targets, by, ["_r"], carry=["_before", "_total"])
    values = values.groupBy(*by, "_r", "value", "_before", "_total").agg(F.sum("_weight").alias("_w"))
    inside = Window.partitionBy(*by, "_r").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = values.withColumn("_running", F.col("_before") + F.sum("_w").over(inside))
    return running.groupBy(*by).agg(
        F.max("_total").alias("total"),
        *[
            F.min(F.when(F.col("_running") >= reach(F.col("_total")), F.col("value"))).alias(name)
            for name, reach in thresholds.items()
        ],
    )


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float],
    names: Sequence[str],
    ranges: int = RANGES,
) -> DataFrame:
    """Linearly interpolated quantiles per (group, metric), one column per probability."""

    def position(p: float, total: Column) -> Column:
        return F.lit(float(p)) * (total - 1)

    thresholds = {}
    for p, name in zip(probabilities, names):
        thresholds[f"_lo_{name}"] = lambda total, p=p: F.floor(position(p, total)) + 1
        thresholds[f"_hi_{name}"] = lambda total, p=p: F.ceil(position(p, total)) + 1
    found = first_reaching(df, group, columns, thresholds, ranges=ranges)

    def between(p: float, name: str) -> Column:
        share = position(p, F.col("total")) - F.floor(position(p, F.col("total")))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * share).alias(name)

    return found.select(*group, "metric", *[between(p, n) for p, n in zip(probabilities, names)])


def weighted_quantiles(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    weight: Column,
    probabilities: Sequence[float],
    names: Sequence[str],
    ranges: int = RANGES,
) -> DataFrame:
    """Per group the first value whose running weight reaches ``p`` times the total weight."""
    thresholds = {n: (lambda total, p=p: F.lit(float(p)) * total) for p, n in zip(probabilities, names)}
    return first_reaching(df, group, [column], thresholds, weight, ranges).drop("metric", "total")


def name_rank(df: DataFrame, column: str, out: str = "position") -> DataFrame:
    """Rank from 1 of the rows of a table of distinct names, in binary string order.

    The bytes after the prefix all names share give a number in the same order; it only cuts
    the ranges, the names themselves order the inside.
    """
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    shared = 0
    for a, b in zip(lo or "", hi or ""):
        if a != b:
            break
        shared += 1
    rest = F.hex(F.encode(F.substring(F.col(column), shared + 1, 6), "UTF-8"))
    number = F.conv(F.rpad(F.substring(rest, 1, 12), 12, "0"), 16, 10).cast("double")
    numbered = df.withColumn("_number", number)
    cut = add_range(numbered, "_number", range_cuts(numbered, ["_number"])["_number"], "_r")
    offsets = _offsets(cut, [], ["_r"], F.lit(1))
    inside = Window.partitionBy("_r").orderBy(column)
    ranked = cut.withColumn("_n", F.row_number().over(inside))
    return (
        _join_offsets(ranked, offsets, [], ["_r"])
        .withColumn(out, F.col("_before") + F.col("_n"))
        .drop("_number", "_r", "_n", "_before", "group_total")
    )
