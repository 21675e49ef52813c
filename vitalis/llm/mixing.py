"""Mixing sources to target weights by fitting whole documents into each source's word budget."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis.llm.common import fresh_columns, stage, width, word_count

BUCKETS = 256  # hash buckets within documents of one source and size; only one of them is ranked


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, near: int = 1 << 15) -> np.ndarray:
    """How many documents of each size to take, so that their sum comes as near ``budget`` as it can.

    Every size gives its share of documents first and the largest sizes fill up, until little more
    than ``near`` words are left; a bounded-knapsack table over the documents not yet taken fills
    the rest. The sum is above the budget only where one document more comes nearer to it.
    """
    take = np.zeros(len(sizes), dtype=np.int64)
    whole = int((sizes * counts).sum())
    if whole == 0 or budget <= 0:
        return take
    if budget >= whole:
        return np.where(sizes > 0, counts, 0)
    take = np.where(sizes > 0, np.floor(counts * (max(0, budget - near) / whole)).astype(np.int64), 0)
    left = budget - int((take * sizes).sum())
    for k in np.argsort(-sizes, kind="stable"):
        if left <= near:
            break
        if sizes[k] > 0:
            more = min(int(counts[k] - take[k]), (left - near) // int(sizes[k]))
            take[k] += more
            left -= more * int(sizes[k])
    reach = np.zeros(left + 1, dtype=bool)
    reach[0] = True
    made_by = np.full(left + 1, -1, dtype=np.int64)
    items: list[tuple[int, int]] = []
    for k in np.flatnonzero((sizes > 0) & (sizes <= left) & (counts > take)):
        free, power = min(int(counts[k] - take[k]), left // int(sizes[k])), 1
        while free and not reach[left]:
            amount = min(power, free)
            step = amount * int(sizes[k])
            if step <= left:
                new = reach[: left + 1 - step] & ~reach[step:]
                at = np.flatnonzero(new) + step
                made_by[at] = len(items)
                reach[at] = True
                items.append((int(k), amount))
            free, power = free - amount, 2 * power
        if reach[left]:
            break
    at = int(np.flatnonzero(reach)[-1])
    gap = left - at
    while at:
        k, amount = items[made_by[at]]
        take[k] += amount
        at -= amount * int(sizes[k])
    over = np.where((sizes > gap) & (counts > take), sizes, np.iinfo(np.int64).max)
    if gap and over.min() < 2 * gap:  # one document more comes nearer than none
        take[over.argmin()] += 1
    return take


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Per source its size, and a target that stops at ``most`` times it; the rest is reshared.

    Sources by code point, null last, weigh ``weights``, repeating. The level at which the capped
    sum meets the goal is found by a few small aggregates; only sums visit the driver.
    """
    last = F.col("source").isNull()
    dealt = sizes.repartitionByRange(width(sizes.sparkSession), last, "source")
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()), "sources")
    before, seen = [0], 0
    for row in dealt.groupBy("part").count().orderBy("part").collect():  # one row for each partition
        before += [seen] * (row["part"] + 1 - len(before)) + [seen + row["count"]]
        seen += row["count"]
    place = F.row_number().over(Window.partitionBy("part").orderBy(last, "source")) - 1
    rank = place + F.element_at(F.array(*(F.lit(b) for b in before)), F.col("part") + 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(rank, F.lit(len(weights))) + 1)
    table = stage(dealt.select("key", "source", "source_size", weight.alias("weight")), "weighted")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    goal, level, capped = share * total, 0.0, -1
    while True:
        above = F.col("weight") * level >= most * F.col("source_size") if capped >= 0 else F.lit(False)
        row = table.agg(
            F.sum(above.cast("int")), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if row[0] is None or row[0] == capped or not row[2]:
            break
        capped, level = row[0], (goal - most * (row[1] or 0)) / row[2]
    target = F.least(most * F.col("source_size"), F.lit(level) * F.col("weight")) if row[2] else most * F.col("source_size")
    return table.withColumn("target", target.cast("double"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document its words, its source's words and target, and the words the mix takes of it.

    Whole documents are taken: each floor(target / source size) times, and the rest of the budget
    by :func:`fit_budget` over the documents' exact sizes. Which documents of a size are taken
    follows a seeded hash of their id. Rows that repeat are documents of their own; a null id or
    source is a value like others; null and empty texts have size 0 and nothing is taken of them;
    an empty table gives an empty result. Other columns don't matter.
    """
    slim = fresh_columns(docs, id=id_col, text=text_col, source=source_col)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    order = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed))
    slim = slim.select("id", key.alias("key"), "source", word_count("text").alias("size"), order.alias("order"))
    slim = stage(slim.withColumn("bucket", F.pmod("order", F.lit(BUCKETS)).cast("int")), "sizes")
    buckets = slim.groupBy("key", "size", "bucket").agg(F.count("*").alias("n"))
    sources = slim.groupBy("key").agg(F.sum("size").alias("source_size"), F.first("source").alias("source"))
    goals = targets(sources, weights, share, most)
    counts = slim.groupBy("key", "size").agg(F.count("*").alias("n"))

    def choose(counted: pd.DataFrame, goal: pd.DataFrame) -> pd.DataFrame:
        counted = counted.sort_values("size", ignore_index=True)
        if counted.empty or goal.empty:
            return pd.DataFrame({c: [] for c in ("key", "size", "passes", "more", "source_size", "target")})
        whole, target = int(goal["source_size"][0]), float(goal["target"][0])
        passes = int(np.floor(target / whole + 1e-12)) if whole else 0
        more = fit_budget(counted["size"].to_numpy(), counted["n"].to_numpy(), int(round(target - passes * whole)))
        return counted[["key", "size"]].assign(passes=passes, more=more, source_size=whole, target=target)

    plan = counts.groupBy("key").cogroup(goals.select("key", "source_size", "target").groupBy("key"))
    plan = plan.applyInPandas(choose, "key string, size long, passes int, more long, source_size long, target double")
    before = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    quota = buckets.withColumn("earlier", earlier).join(plan, ["key", "size"])
    quota = quota.withColumn("quota", F.greatest(F.lit(0), F.least("n", F.col("more") - F.col("earlier")))).drop("n", "earlier", "more")
    place = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("order", "id"))
    chosen = slim.join(quota, ["key", "size", "bucket"]).withColumn("copies", F.col("passes") + (place <= F.col("quota")).cast("int"))
    return chosen.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        F.when(F.col("size") > 0, F.col("copies")).otherwise(0).alias("copies"), F.col("source").alias(source_col),
    )
