"""The inverted file against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vitalis.operators import ivf, vectors


def vector_frame(spark, x, name="id"):
    return spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], f"{name} bigint, embedding array<float>")


def plain(x, k):
    u = x.astype(np.float32).astype(float)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    scores = np.round(u @ u.T, 9)
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), -scores[i])) if j != i][:k] for i in range(len(x))}


def clusters(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(12, dim))[rng.integers(12, size=n)] + rng.normal(size=(n, dim)) * 0.4


def test_tuned_recall_holds_on_all_rows(spark):
    x = clusters(900, 16)
    df = vector_frame(spark, x).repartition(5)
    index = ivf.IvfIndex.build(df, cells=30).tune(10, target=0.95)
    assert index.recall >= 0.95 and index.probes < 30
    want = plain(x, 10)
    got = {}
    for r in index.search(vector_frame(spark, x, "query_id"), 10, skip_same=True).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * 10 * len(x)


def test_all_cells_and_rows_are_the_exact_search(spark, monkeypatch):
    x = clusters(300, 10, 5)
    x[50:150] = x[50]  # a third is one vector
    monkeypatch.setattr(ivf, "BLOCK", 16)
    monkeypatch.setattr(ivf, "TILE", 8)
    index = ivf.IvfIndex.build(vector_frame(spark, x).repartition(3), cells=9)
    got = {}
    for r in index.search(vector_frame(spark, x, "query_id"), 7, True, probes=9, refine=300).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == plain(x, 7)


def test_every_valid_row_is_indexed_under_its_cell(spark):
    x = clusters(400, 8)
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0, None] * 4), (None, [1.0] * 8)]
    df = vector_frame(spark, x).unionByName(spark.createDataFrame(odd, "id bigint, embedding array<float>"))
    index = ivf.IvfIndex.build(df, sample=50, cells=6)
    rows = index.vectors().select("id", "cell", "codes").collect()
    assert {r.id for r in rows} == set(range(400))
    u = x.astype(np.float32).astype(float)
    cell, codes = index.book.encode(u / np.linalg.norm(u, axis=1, keepdims=True))
    assert all(r.cell == cell[r.id] and bytes(r.codes) == codes[r.id].tobytes() for r in rows)
    assert index.search(vector_frame(spark, x[:0], "query_id"), 3).collect() == []
    with pytest.raises(ValueError, match="nothing"):
        ivf.IvfIndex.build(df.limit(0))


def test_code_scores_are_near_the_products():
    x = clusters(2000, 16)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    book = ivf.Codebook.fit(u, 20)
    cell, codes = book.encode(u)
    own = cell == cell[0]
    error = np.abs(book.scores(u[7], cell[0], codes[own]) - u[own] @ u[7])
    plain_error = np.abs(book.centres[cell[0]] @ u[7] - u[own] @ u[7])
    assert error.mean() < 0.05 and error.mean() < 0.5 * plain_error.mean()


@pytest.mark.parametrize("name", ["vector_topk_ivf", "vector_topk_lsh"])
def test_registered_searches_reach_their_recall(spark, name):
    d = "/root/testdata/sf0.01"
    queries = entry.queries()
    assert ivf.recall_of(queries[name](spark, d), queries["vector_topk"](spark, d)) >= 0.9


def test_what_meets_the_centres_at_once_is_bounded(spark, monkeypatch):
    import tracemalloc

    rng = np.random.default_rng(2)
    x, centres = rng.normal(size=(20_000, 8)), rng.normal(size=(512, 8))
    tracemalloc.start()
    near = ivf.nearest(x, centres, 1), ivf.nearest(x, centres, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20  # 82 MB for every row against every centre
    want = np.argsort((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1, kind="stable")
    assert (near[0] == want[:, :1]).all() and (near[1] == want[:, :3]).all()

    x = clusters(300, 10, 5)
    monkeypatch.setattr(ivf, "BLOCK", 7)
    monkeypatch.setattr(ivf, "PLACED", 20)
    index = ivf.IvfIndex.build(vector_frame(spark, x).repartition(3), cells=9)
    blocks = index._blocks().select("cell", (F.length("ids") / 8).alias("n")).collect()
    assert max(r.n for r in blocks) == 7 and sum(r.n for r in blocks) == 300
    got = {}
    for r in index.search(vector_frame(spark, x, "query_id"), 7, True, probes=9, refine=300).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got == plain(x, 7)
