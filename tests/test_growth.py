"""What was changed so that work grows no faster than the input: the same results by the cheaper way."""

from unittest.mock import patch

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitalis.operators import boosting, models, retrieval, textprep, vectors
from vitalis.session import durable
from vitalis.streaming.count_windows import CountWindows


def test_binned_gbt_is_the_gbt_of_all_rows(spark):
    rng = np.random.default_rng(4)
    x = np.c_[rng.integers(0, 12, 600) / 4, rng.integers(0, 5, 600), np.full(600, 3.0)]
    y = ((x[:, 0] > 1) ^ (x[:, 1] > 2) ^ (rng.random(600) < 0.1)).astype(float)
    df = spark.createDataFrame([(k, *map(float, v), float(t)) for k, (v, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")
    df = models.assemble(df, ["a", "b", "c"]).cache()
    plain = models.fit_gbt(df, 0.5, rounds=8, depth=3)
    binned = models.fit_gbt(df, 0.5, rounds=8, depth=3, most_rows=100)
    assert isinstance(binned, models.BinnedGbt) and not isinstance(plain, models.BinnedGbt)
    assert [len(c) for c in binned.cuts] == [11, 4, 0]
    p, b = ([r.probability[1] for r in m.transform(df).orderBy("id").select("probability").collect()] for m in (plain, binned))
    assert b == pytest.approx(p, abs=1e-9) and len(set(p)) > 10
    assert binned.transform(df).columns == plain.transform(df).columns


def test_binned_gbt_takes_quantiles_and_leaves_rows_apart_that_hardly_agree(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=400)
    df = spark.createDataFrame([(float(v), float(v > 0.2)) for v in x], "a double, label double")
    df = models.assemble(df, ["a"]).cache()
    model = models.fit_gbt(df, 0.5, rounds=5, depth=2, most_rows=100)
    assert isinstance(model, models.BinnedGbt) and len(model.cuts[0]) == 31
    assert model.transform(df).filter("prediction = label").count() > 380
    wide = spark.createDataFrame([([float(v) for v in r], float(r[0] > 0)) for r in rng.normal(size=(300, 8))], "x array<double>, label double")
    assert not isinstance(models.fit_gbt(models.assemble(wide, ["x"]), rounds=2, depth=2, most_rows=100), models.BinnedGbt)


class _Handle:
    """One bucket's state and timers, as far as a processor asks for them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_a_call_advances_all_entities_of_a_bucket():
    rows = [(who, 1000 * k, k, float(who * 100 + k)) for who in range(300) for k in range(3 + who % 9)]
    part = pd.DataFrame(rows, columns=["who", "ms", "n", "x"]).sample(frac=1, random_state=1)
    part["ts"] = pd.to_datetime(part["ms"], unit="ms")
    part["y"] = -part["x"]
    windows, handle = CountWindows(["who"], "ts", "n", "x", "y", 4, 2), _Handle()
    windows.init(handle)
    first = [*windows.handleInputRows((0,), iter([part[part["n"] < 5], part[part["n"] >= 5]]), _Watermark(-1))]
    assert not first and handle.calls == 1 and len(handle.timers) == 1
    out = pd.concat(windows.handleExpiredTimer((0,), _Watermark(20_000), None))
    want = {(who, w): [float(who * 100 + 2 * w + i) for i in range(4)] for who in range(300) for w in range(9) if 2 * w + 4 < 3 + who % 9}
    assert {(r.who, r.window): list(r.xs) for r in out.itertuples()} == want and len(out) == len(want)
    assert all(list(-r.ys) == list(r.xs) for r in out.itertuples()) and handle.calls == 2
    late = part[part["n"] == 0].assign(ts=pd.to_datetime(1, unit="ms"))
    assert not [*windows.handleInputRows((0,), iter([late]), _Watermark(20_000))]


@pytest.mark.parametrize("depth", [3, 7])
def test_trees_are_worked_out_as_step_by_step(depth):
    rng = np.random.default_rng(depth)
    bins, trees = rng.integers(0, 32, (500, 4)).astype(np.uint8), boosting.Trees.empty(3, depth)
    inner = slice(1, 1 << depth)
    trees.feature[:, inner] = rng.integers(-1, 4, trees.feature[:, inner].shape)
    trees.cut[:, inner], trees.value[:] = rng.integers(0, 31, trees.cut[:, inner].shape), rng.normal(size=trees.value.shape)
    trees.feature[:, 1:8] = rng.integers(0, 4, (3, 7))
    got = boosting._advance(np.zeros((500, 3), np.float32), bins, [trees])
    for row, own in enumerate(bins):
        for m in range(3):
            at = 1
            while trees.feature[m, at] >= 0:
                at = 2 * at + int(own[trees.feature[m, at]] > trees.cut[m, at])
            assert got[row, m] == trees.value[m, at] and trees.places(m, bins.T.copy(), depth)[row] == at


def test_bins_are_spread_over_the_cores(spark):
    df = spark.createDataFrame([(k, [float(k % 7)], float(k % 2)) for k in range(500)], "id long, x array<double>, label double").coalesce(1)
    df = durable(df)  # one file, which one task would read
    rows = boosting.binned(models.assemble(df, ["x"]), "features", "label", ["id"], [np.arange(6.0)])
    assert rows.rdd.getNumPartitions() >= 8
    assert sorted(boosting._matrix(b, "u1")[0, 0] for b in [boosting._packed(np.array([[k]], np.uint8)) for k in range(3)]) == [0, 1, 2]


def test_sparse_vectors_travel_packed_and_find_the_same(spark):
    words = ["red", "blue", "green", "pear", "plum", "fig"]
    rng = np.random.default_rng(3)
    texts = [(k, " ".join(rng.choice(words, 1 + k % 5))) for k in range(200)] + [(900, None), (901, "none")]
    docs = spark.createDataFrame(texts, "id long, text string")
    asked = docs.filter("id % 9 = 0").select(F.col("id").cast("string").alias("query_id"), "text")
    model = textprep.TfIdf.fit(docs, "text", (1, 2), (), 0.9, 20)
    dense = [model.vectors(asked, "query_id", "text"), model.vectors(docs, "id", "text")]
    for limit in (2048, 3):  # queries travel, then both sides meet in blocks
        with patch.object(vectors, "BLOCK_ROWS", 64):
            got = retrieval.search_text(asked, docs, model, 7, max_travelling=limit)
            want = vectors.search(*dense, 7, max_travelling=limit)
        rows = [sorted(map(tuple, f.collect())) for f in (got, want)]
        assert rows[0] == rows[1] and len(rows[0]) == 7 * len({r[0] for r in rows[0]}) > 100
    packed = model.packed(docs, "id", "text")
    assert dict(packed.dtypes)["embedding"] == "binary" and packed.count() == model.vectors(docs, "id", "text").count()


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_best_of_a_block_as_by_sorting_all(metric):
    rng = np.random.default_rng(9)
    q, v = rng.integers(0, 3, (20, 4)).astype(float), rng.integers(0, 3, (300, 4)) + rng.choice([0, 1e-12], (300, 4))
    v[150:] = rng.normal(size=(150, 4))
    ids = rng.permutation(300)
    for k in (1, 3, 40, 400):
        a, i, s = vectors._block_top(q, np.arange(20), v, ids, k, metric, False, 9)
        for j in range(20):
            raw = q[j] @ v.T if metric == "ip" else -((q[j] - v) ** 2).sum(1)
            want = sorted(zip(-np.round(raw, 9), ids))[:k]
            assert sorted(i[a == j]) == sorted(n for _, n in want) and np.sort(-s[a == j]) == pytest.approx([w for w, _ in want], abs=1e-8)


def test_chunks_leave_a_task_in_batches_of_bounded_size():
    import pyarrow as pa

    texts = ["", *("word %d of a long text. " % k * 9_000 for k in range(30)), "short"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    made = list(retrieval.chunk_batches(iter([batch]), ["doc_id", "chunk_no", "start_index", "text"], 1000, 200))
    assert len(made) > 3 and max(sum(map(len, b.column(3).to_pylist())) for b in made) <= retrieval.CHUNK_CHARS + 1000
    want = [(d, n, a, t[a:b]) for d, t in enumerate(texts) for n, (a, b) in enumerate(retrieval.chunk_spans(t, 1000, 200))]
    assert [tuple(r.values()) for b in made for r in b.to_pylist()] == want
