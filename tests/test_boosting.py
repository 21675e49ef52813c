"""Many boosted models side by side, against one model grown by trying every split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.operators import boosting, models

COLUMNS = ["a", "b", "c"]


def points(n=160, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(size=n) * 0.3 > 0).astype(int)
    return x, y


def frame_of(spark, x, y, folds=4):
    rows = [(k, k % folds, *map(float, v), float(t)) for k, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, label double")
    return models.assemble(df, COLUMNS).select("id", "fold", "features", "label")


def plain_tree(x, g, h, cuts, depth, s, node=1):
    """{node: (feature, value) or leaf value} by trying every cut of every feature."""
    leaf = -g.sum() / (h.sum() + s.shrink) * s.learning_rate
    worth = lambda a, b: a**2 / (b + s.shrink)
    best = (1e-6, None)
    for f, points_ in enumerate(cuts):
        for c, value in enumerate(points_):
            left = x[:, f] <= value
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if hl < s.least_weight or hr < s.least_weight:
                continue
            gain = 0.5 * (worth(gl, hl) + worth(gr, hr) - worth(g.sum(), h.sum()))
            if gain > best[0] * (1 + 1e-6):
                best = (gain, (f, value, left))
    if depth == 0 or best[1] is None:
        return ("leaf", leaf)
    f, value, left = best[1]
    sides = [plain_tree(x[m], g[m], h[m], cuts, depth - 1, s) for m in (left, ~left)]
    if best[0] < s.gamma and all(side[0] == "leaf" for side in sides):
        return ("leaf", leaf)
    return ("split", f, value, *sides)


def plain_value(tree, row):
    while tree[0] == "split":
        tree = tree[3] if row[tree[1]] <= tree[2] else tree[4]
    return tree[1]


def plain_margins(x, y, cuts, s, rounds, fit_on):
    margins = np.zeros(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margins))
        g, h = p - y, p * (1 - p)
        tree = plain_tree(x[fit_on], g[fit_on], h[fit_on], cuts, s.depth, s)
        margins = margins + [plain_value(tree, row) for row in x]
    return margins


SETTINGS = [
    boosting.Setting(0.3, 2), boosting.Setting(0.1, 3, gamma=2.0), boosting.Setting(0.5, 1, held_out=1),
    boosting.Setting(0.2, 3, shrink=0.1, least_weight=4.0, held_out=2),
]


def bins_of(x, cuts):
    return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)


def test_models_side_by_side_equal_separate_ones(spark):
    x, y = points()
    df = frame_of(spark, x, y)
    cuts = boosting.cut_points(df, "features", 12)
    rows = boosting.binned(df.repartition(3), "features", "label", ["id"], cuts, "fold")
    fitted = boosting.fit_boosted(rows, SETTINGS, 7, cuts, stages=[2])  # margins are written once between
    got = fitted.margins(bins_of(x, cuts))
    for m, s in enumerate(SETTINGS):
        fit_on = np.arange(len(x)) % 4 != s.held_out
        want = plain_margins(x, y, cuts, s, 7, fit_on)
        assert got[:, m] == pytest.approx(want, abs=1e-3)
        early = plain_margins(x, y, cuts, s, 2, fit_on)  # staged: the first rounds are the model of so many rounds
        assert fitted.margins(bins_of(x, cuts), rounds=2)[:, m] == pytest.approx(early, abs=1e-3)
        if s.held_out >= 0:
            for r, margins in ((2, early), (7, want)):
                right = ((margins > 0) == (y == 1))[~fit_on].sum()
                assert fitted.staged[r][m].tolist() == [right, (~fit_on).sum()]


def test_rounds_of_a_longer_fit_are_the_shorter_fit(spark):
    x, y = points(120, 8)
    df = frame_of(spark, x, y)
    cuts = boosting.cut_points(df, "features", 16)
    rows = boosting.binned(df, "features", "label", ["id"], cuts, "fold")
    settings = [boosting.Setting(0.3, 3, row_share=0.7, column_share=0.6, held_out=0)]
    long, short = (boosting.fit_boosted(rows, settings, n, cuts, stages=[4]) for n in (8, 4))
    assert (long.staged[4] == short.staged[4]).all()
    assert (long.margins(bins_of(x, cuts), 4) == short.margins(bins_of(x, cuts))).all()
    seen = {tuple(sorted(set(t.feature[0][t.feature[0] >= 0].tolist()))) for t in long.rounds}
    assert all(len(f) <= 1 for f in seen) and len(seen) > 1  # 0.6 of three columns is one, drawn anew each round


def test_grid_table_and_refit(spark):
    x, y = points(200, 2)
    df = frame_of(spark, x, y)
    best, table = boosting.boosted_grid(df, ["id"], "fold", 4, {"depth": [1, 3], "gamma": [0, 50]}, rounds=6, stages=[3])
    scores = {(r.depth, r.gamma, r.rounds): r.accuracy for r in table.collect()}
    assert len(scores) == 8 and all(0 <= v <= 1 for v in scores.values())
    top = max((v, -k) for k, v in enumerate(scores[d, g, 6] for d in (1, 3) for g in (0, 50)))
    assert (best.settings[0].depth, best.settings[0].gamma) == [(1, 0), (1, 50), (3, 0), (3, 50)][-top[1]]
    scored = best.transform(df)
    assert scored.columns == ["id", "fold", "label", "probability"]
    assert scored.filter("(probability > 0.5) = (label = 1)").count() > 0.8 * 200


def test_cuts_and_rows_without_label(spark):
    x, y = points(50, 1)
    df = frame_of(spark, x, y).unionByName(frame_of(spark, x[:5], y[:5]).withColumn("label", F.lit(None).cast("double")))
    cuts = boosting.cut_points(df, "features", 4)
    assert all(len(c) <= 3 and (np.diff(c) > 0).all() for c in cuts)
    rows = boosting.binned(df, "features", "label", ["id"], cuts)
    assert rows.count() == 50
    got = {r.key: list(r.bins) for r in rows.collect()}
    keys = {r.k: r.id for r in df.select(F.xxhash64("id").alias("k"), "id").collect()}
    assert all(got[k] == bins_of(x[[i]], cuts)[0].tolist() for k, i in keys.items())
    fitted = boosting.fit_boosted(rows.filter("false"), [boosting.Setting(depth=2)], 2, cuts)
    assert not fitted.margins(bins_of(x, cuts)).any()
    with pytest.raises(ValueError, match="depth"):
        boosting.fit_boosted(rows, [boosting.Setting(depth=11)], 1, cuts)


def test_row_shares_follow_the_key():
    u = boosting.uniform(np.arange(20_000), 7)
    assert 0 <= u.min() and u.max() < 1 and abs((u < 0.6).mean() - 0.6) < 0.02
    assert (u == boosting.uniform(np.arange(20_000), 7)).all() and abs(np.corrcoef(u, boosting.uniform(np.arange(20_000), 8))[0, 1]) < 0.05


def test_models_grown_alone_are_those_of_passes_over_the_rows(spark, monkeypatch):
    x, y = points(300, 4)
    df = frame_of(spark, x, y)
    cuts = boosting.cut_points(df, "features", 12)
    rows = boosting.binned(df, "features", "label", ["id"], cuts, "fold")
    shares = [dict(gamma=g, row_share=r, column_share=c) for g in (0.0, 1.5) for r in (0.6, 1.0) for c in (0.4, 0.7, 1.0)]
    settings = [boosting.Setting(0.3, 1 + k % 4, held_out=h, **s) for k, s in enumerate(shares) for h in (0, 2, -1)]
    alone = boosting.fit_boosted(rows, settings, 6, cuts, stages=[2, 4])
    with monkeypatch.context() as m:
        m.setattr(boosting, "TRAVELLING", -1)
        passes = boosting.fit_boosted(rows, settings, 6, cuts, stages=[2, 4])
    for a, b in zip(alone.rounds, passes.rounds, strict=True):
        assert (a.feature == b.feature).all() and (a.cut == b.cut)[a.feature >= 0].all()
    assert alone.margins(bins_of(x, cuts)) == pytest.approx(passes.margins(bins_of(x, cuts)), abs=1e-4)
    assert {r: v.tolist() for r, v in alone.staged.items()} == {r: v.tolist() for r, v in passes.staged.items()}
    own, data = settings[3], _columns(rows)
    want, counted = boosting._Grower(*data, own.held_out, own.row_share, 12).fit([own], np.ones((6, 1, 3), bool), 42, [6])
    for name, value in (("_BLOCK", 64), ("_CELLS", 16)):  # rows in parts, features one by one
        monkeypatch.setattr(boosting, name, value)
        got, again = boosting._Grower(*data, own.held_out, own.row_share, 12).fit([own], np.ones((6, 1, 3), bool), 42, [6])
        assert all((g.feature == w.feature).all() and g.value == pytest.approx(w.value, abs=1e-5) for g, w in zip(got, want, strict=True))
        assert counted[6].tolist() == again[6].tolist() and counted[6].sum() > 0


def _columns(rows):
    table = rows.toArrow().combine_chunks()
    return *(table[c].to_numpy() for c in ("key", "fold", "label")), boosting._matrix(table["bins"].chunk(0), "u1")


def test_a_grid_takes_no_pass_for_each_level(spark):
    x, y = points(200, 6)
    df = frame_of(spark, x, y)
    tracker, group = spark.sparkContext.statusTracker(), "boosted-alone"
    cuts = boosting.cut_points(df, "features", 12)
    rows = boosting.binned(df, "features", "label", ["id"], cuts, "fold")
    spark.sparkContext.setJobGroup(group, group)
    try:
        boosting.fit_boosted(rows, [boosting.Setting(0.1, 4)] * 3, 30, cuts)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(tracker.getJobIdsForGroup(group)) <= 6  # 120 levels
