"""Boosted trees, many models side by side: a grid of settings and all folds advance together.

Features are cut into bins once and written. A level of one tree of every model is one pass: tasks add
up gradients by (model, node, feature, bin), one group per model sums what the tasks found and names the best
split of each node. Leaf values follow from the same sums, so a round takes as many passes as trees are deep,
however many models there are. Margins are written again every few rounds; between, the newest trees are
added on the fly. Margins after any number of rounds score the model of that many rounds, without a fit of its own.

Bins that take little room, which is measured, travel to all tasks instead, and each task grows some models alone,
round by round: the same trees from the same sums, without a pass over a table for each level.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.session import configured, durable, spread

WRITE_EVERY = 5  # rounds between two writes of the margins
_BRANCHES = 40  # splits up to which a tree is worked out as a whole, beyond it row by row
_MARGINS = 4 << 20  # of the rows that are worked on at once
DEEPEST = 10
TRAVELLING = 128 << 20  # bytes of keys, folds, labels and bins up to which they go to every task
_BLOCK = 1 << 16  # rows whose sums are taken at once
_CELLS = 1 << 16  # of the sums by node and pair of bins; features are paired as long as no more are needed
_HELD = 64 << 20  # bytes of margins of the models that one task grows
_HISTOGRAMS = "model int, hist binary"
_SPLITS = "model int, node int, feature int, cut int, gain double, left double, right double, own double"


@dataclass(frozen=True)
class Setting:
    """One model: ``gamma`` is the least gain of a split, the shares are those of rows and columns a tree sees."""

    learning_rate: float = 0.3
    depth: int = 6
    gamma: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    shrink: float = 1.0  # penalty on squared leaf values
    least_weight: float = 1.0  # of the rows on either side of a split
    held_out: int = -1  # fold that the model doesn't see; -1 for none


@dataclass
class Trees:
    """One round's tree of every model, as heaps: node k has children 2k and 2k + 1, the root is 1."""

    feature: np.ndarray  # (model, node), -1 where a row stops
    cut: np.ndarray  # bins up to it go left
    value: np.ndarray

    @classmethod
    def empty(cls, models: int, depth: int) -> "Trees":
        size = 2 << depth
        return cls(np.full((models, size), -1, np.int16), np.zeros((models, size), np.int16), np.zeros((models, size), np.float32))

    def places(self, model: int, by_feature: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row after so many steps down one model's tree; ``by_feature`` has the bins as (feature, row)."""
        rows, f = np.arange(by_feature.shape[1]), self.feature[model]
        flat, start = by_feature.reshape(-1), np.maximum(f, 0).astype(np.int64) * by_feature.shape[1]
        node = np.arange(len(f))
        cut, onward = np.where(f >= 0, self.cut[model], 255), np.where(f >= 0, 2 * node, node)  # no bin lies beyond 255
        at = np.ones(len(rows), dtype=np.int64)
        for _ in range(levels):
            at = onward.take(at) + (flat.take(start.take(at) + rows) > cut.take(at))
        return at

    def values(self, model: int, by_feature: np.ndarray) -> np.ndarray | np.float32:
        """What one model's tree adds to each row."""
        f, cut, value = self.feature[model], self.cut[model], self.value[model]
        if (f >= 0).sum() > _BRANCHES:
            return value.take(self.places(model, by_feature, len(f).bit_length() - 2))

        def below(node: int):
            return value[node] if f[node] < 0 else np.where(by_feature[f[node]] > cut[node], below(2 * node + 1), below(2 * node))

        return below(1)


def _advance(margins: np.ndarray, bins: np.ndarray, newest: list[Trees]) -> np.ndarray:
    """The margins (row, model) after the newest trees."""
    by_feature, by_model = np.ascontiguousarray(bins.T), margins.T.copy(order="C")
    for trees in newest:
        for m in range(len(by_model)):
            by_model[m] += trees.values(m, by_feature)
    return np.ascontiguousarray(by_model.T)


def uniform(key: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) from a row's key and a seed; the same on every run."""
    h = key.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, odd in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    return (h >> np.uint64(11)) / float(1 << 53)


def cut_points(df: DataFrame, features: str, bins: int, accuracy: int = 10_000) -> list[np.ndarray]:
    """Up to ``bins`` - 1 values of each feature that cut its rows into shares of like size."""
    values = df.select(F.posexplode(vector_to_array(features)).alias("f", "x"))
    shares = [k / bins for k in range(1, bins)]
    found = values.groupBy("f").agg(F.percentile_approx("x", shares, accuracy).alias("cuts")).collect()  # a row per feature
    return [np.unique(r.cuts) for r in sorted(found, key=lambda r: r.f)]


def binned(df: DataFrame, features: str, label: str, key: Sequence[str], cuts: Sequence[np.ndarray], fold: str | None = None) -> DataFrame:
    """(key, fold, label, bins): a bin is the number of cut points below a value. Written once, read by every pass."""
    rows = spread(df.filter(F.col(label).isNotNull())).select(
        F.xxhash64(*key).alias("key"), (F.col(fold).cast("int") if fold else F.lit(-2)).alias("fold"), F.col(label).cast("int").alias("label"),
        vector_to_array(features).alias("x"),
    )
    return durable(rows.mapInArrow(_to_bins([np.asarray(c) for c in cuts]), "key long, fold int, label int, bins binary"))


def _to_bins(cuts: Sequence[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(cuts))
            b = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1).astype(np.uint8)
            columns = [batch.column(c) for c in ("key", "fold", "label")] + [_packed(b)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fold", "label", "bins"])

    return run


@dataclass
class Boosted:
    """Fitted models: their settings, cut points and one ``Trees`` per round; ``staged`` has validation counts by rounds."""

    settings: list[Setting]
    cuts: list[np.ndarray]
    rounds: list[Trees] = field(default_factory=list)
    staged: dict[int, np.ndarray] = field(default_factory=dict)  # rounds -> (model, right and all)

    def margins(self, bins: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.zeros((len(bins), len(self.settings)), dtype=np.float32)
        return _advance(out, bins, self.rounds[:rounds])

    def only(self, model: int) -> "Boosted":
        """One of the models by itself."""
        one = slice(model, model + 1)
        kept = [Trees(t.feature[one], t.cut[one], t.value[one]) for t in self.rounds]
        return Boosted([self.settings[model]], self.cuts, kept, {r: s[one] for r, s in self.staged.items()})

    def transform(self, df: DataFrame, features: str = "features", rounds: int | None = None) -> DataFrame:
        """The rows with ``probability`` of label 1 by the first model, after all or the first ``rounds`` rounds."""
        fitted = self.only(0)
        names = [c for c in df.columns if c != "_x"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.asarray(batch.column("_x").flatten()).reshape(batch.num_rows, len(fitted.cuts))
                b = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(fitted.cuts)], axis=1)
                p = 1 / (1 + np.exp(-fitted.margins(b, rounds)[:, 0].astype(np.float64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(p)], names=[*names, "probability"])

        plain = [c for c in names if c != features]  # vectors don't travel through Arrow
        names = plain
        made = df.select(*plain, vector_to_array(features).alias("_x"))
        return made.mapInArrow(run, made.drop("_x").schema.add("probability", "double"))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """A binary column of rows of one length as a matrix, where it lies."""
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


def _packed(matrix: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(matrix)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.itemsize * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _slices(batches: Iterator[pa.RecordBatch], models: int) -> Iterator[pa.RecordBatch]:
    rows = max(256, min(16384, _MARGINS // models))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _batch(batch: pa.RecordBatch, models: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    key, fold, label = (np.asarray(batch.column(c)) for c in ("key", "fold", "label"))
    bins = _matrix(batch.column("bins"), "u1")
    known = "margins" in batch.schema.names
    margins = _matrix(batch.column("margins"), "<f4") if known else np.zeros((len(bins), models), dtype=np.float32)
    return key, fold, label, bins, margins


def _histograms(held: np.ndarray, share: np.ndarray, depth: np.ndarray, newest: list[Trees], now: Trees, level: int, width: int, seed: int):
    """Per task and model that grows on, sums of gradients and their slopes by (node of the level, feature, bin)."""
    models, nodes = len(held), 1 << level
    growing = np.flatnonzero(depth > level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in _slices(batches, models):
            key, fold, label, bins, margins = _batch(batch, models)
            by_feature, by_model, drawn = np.ascontiguousarray(bins.T), margins.T.copy(order="C"), uniform(key, seed)
            if total is None:
                total = np.zeros((len(growing), nodes, len(by_feature), width, 2))
            for place, m in enumerate(growing):
                margin = by_model[m]
                for trees in newest:
                    margin += trees.values(m, by_feature)
                at = now.places(m, by_feature, level) - nodes
                seen = np.flatnonzero((fold != held[m]) & (drawn < share[m]) & (at >= 0))
                p = 1 / (1 + np.exp(-margin[seen]))
                first = at[seen] * width
                weights = p - label[seen], p * (1 - p)
                for f, own in enumerate(by_feature):
                    spot = first + own[seen]
                    for k in (0, 1):
                        total[place, :, f, :, k] += np.bincount(spot, weights[k], minlength=nodes * width).reshape(nodes, width)
        if total is not None:
            busy = np.flatnonzero(total[..., 1].any(axis=(1, 2, 3)))
            packed = pa.array([total[k].astype("<f4").tobytes() for k in busy], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(growing[busy], pa.int32()), packed], names=["model", "hist"])

    return run


def _best_splits(settings: list[Setting], allowed: np.ndarray, level: int, width: int):
    """Sum a model's histograms and name each node's best split; a node without any is a leaf."""
    nodes = 1 << level

    def run(table: pa.Table) -> pa.Table:
        m = table["model"][0].as_py()
        total = sum(np.frombuffer(h, "<f4").astype(np.float64) for h in table["hist"].to_pylist()).reshape(nodes, -1, width, 2)
        k, f, cut, gain, left, right, own = _best(total, settings[m], allowed[m])
        columns = [np.full(len(k), m), nodes + k, f, cut, gain, left, right, own]
        names, kinds = [c.split()[0] for c in _SPLITS.split(", ")], [pa.int32()] * 4 + [pa.float64()] * 4
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return run


def _best(total: np.ndarray, s: Setting, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
    """From sums by (node, feature, bin) each node's best split: node, feature or -1, cut, gain and the leaf values left, right and here.

    A node without rows is left out.
    """
    cuts = total.shape[2] - 1
    whole = total[:, np.argmax(allowed)].sum(axis=1)  # (node, 2)
    left = np.cumsum(total, axis=2)[:, :, :-1]
    right = whole[:, None, None] - left
    worth = lambda x: x[..., 0] ** 2 / (x[..., 1] + s.shrink)
    gain = 0.5 * (worth(left) + worth(right) - worth(whole)[:, None, None])
    fits = (left[..., 1] >= s.least_weight) & (right[..., 1] >= s.least_weight) & allowed[None, :, None]
    gain = np.where(fits, gain, -np.inf).reshape(len(total), -1)
    k = np.flatnonzero(whole[:, 1] > 0)
    best = gain[k].argmax(axis=1)
    f, cut = np.divmod(best, cuts)
    leaf = lambda x: -x[..., 0] / (x[..., 1] + s.shrink) * s.learning_rate
    out = f, cut, gain[k, best], leaf(left[k, f, cut]), leaf(right[k, f, cut])
    grows = out[2] > 1e-6
    return k, np.where(grows, f, -1), *(np.where(grows, x, 0) for x in out[1:]), leaf(whole[k])


def _prune(trees: Trees, gain: np.ndarray, gamma: np.ndarray) -> None:
    """Bottom-up: a split whose children are leaves and that gains less than ``gamma`` goes."""
    depth = trees.feature.shape[1].bit_length() - 2
    for nodes in (slice(1 << k, 2 << k) for k in range(depth - 1, -1, -1)):
        below = trees.feature[:, 2 * nodes.start : 2 * nodes.stop]
        own = trees.feature[:, nodes]
        own[(own >= 0) & (below[:, ::2] < 0) & (below[:, 1::2] < 0) & (gain[:, nodes] < gamma[:, None])] = -1


def fit_boosted(
    rows: DataFrame, settings: Sequence[Setting], rounds: int, cuts: Sequence[np.ndarray], seed: int = 42, stages: Sequence[int] = (),
) -> Boosted:
    """Fit all models on ``binned`` rows; ``stages`` are numbers of rounds after which held-out rows are scored.

    Each model sees the rows outside its held-out fold. A level's histogram of one model has 2^level x features x
    bins cells, so ``depth`` is at most 10. Without rows the trees are single leaves of value 0.
    """
    settings = list(settings)
    deepest = max(s.depth for s in settings)
    if deepest > DEEPEST:
        raise ValueError(f"depth beyond {DEEPEST}")
    models, d, width = len(settings), len(cuts), max(2, 1 + max(len(c) for c in cuts))
    arrays = {n: np.array([getattr(s, n) for s in settings]) for n in ("held_out", "row_share", "gamma", "depth", "column_share")}
    fitted, state, newest = Boosted(settings, list(cuts)), rows, []
    stages = sorted(set(stages) | {rounds})
    rng = np.random.default_rng(seed)
    if rows.count() * (16 + d) <= TRAVELLING:
        return _fit_alone(rows, fitted, rounds, width, rng, seed, stages)
    # hundreds of small shuffles of a row per model and task: what adaptive execution would look at is known
    spark, groups = rows.sparkSession, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(4, models // 64))
    with configured(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=str(groups)):
        for r in range(1, rounds + 1):
            now, gains = Trees.empty(models, deepest), np.zeros((models, 2 << deepest))
            allowed = _columns_seen(rng, arrays["column_share"], d)
            for level in range(deepest):
                made = state.mapInArrow(_histograms(arrays["held_out"], arrays["row_share"], arrays["depth"], newest, now, level, width, seed * 1000 + r), _HISTOGRAMS)
                found = made.groupBy("model").applyInArrow(_best_splits(settings, allowed, level, width), _SPLITS).toArrow()  # a row per model and node
                m, node, f, cut = (found[c].to_numpy() for c in ("model", "node", "feature", "cut"))
                gain, left, right, own = (found[c].to_numpy() for c in ("gain", "left", "right", "own"))
                if level == 0:
                    now.value[m, node] = own
                grows = (f >= 0) & (level < arrays["depth"][m])
                m, node, f, cut, gain, left, right = (a[grows] for a in (m, node, f, cut, gain, left, right))
                now.feature[m, node], now.cut[m, node], gains[m, node] = f, cut, gain
                now.value[m, 2 * node], now.value[m, 2 * node + 1] = left, right
                if not len(m):
                    break
            _prune(now, gains, arrays["gamma"])
            fitted.rounds.append(now)
            newest = [*newest, now]
            if r in stages:
                fitted.staged[r] = _validated(state, arrays["held_out"], newest)
            if len(newest) == WRITE_EVERY and r < rounds:
                state, newest = durable(state.mapInArrow(_advanced(models, newest), "key long, fold int, label int, bins binary, margins binary")), []
    return fitted


def _columns_seen(rng: np.random.Generator, share: np.ndarray, d: int) -> np.ndarray:
    """(model, feature): the columns that a round's trees see."""
    order = rng.random((len(share), d)).argsort(axis=1).argsort(axis=1)
    return order < np.maximum(1, np.floor(share * d + 1e-9))[:, None]


def _fit_alone(rows: DataFrame, fitted: Boosted, rounds: int, width: int, rng: np.random.Generator, seed: int, stages: Sequence[int]) -> Boosted:
    """The models dealt to tasks, each of which holds all rows; models that see the same rows go together."""
    settings, d, session = fitted.settings, len(fitted.cuts), rows.sparkSession
    share = np.array([s.column_share for s in settings])
    allowed = np.array([_columns_seen(rng, share, d) for _ in range(rounds)]).reshape(rounds, len(settings), d)
    table = rows.select("key", "fold", "label", "bins").toArrow().combine_chunks()
    n = len(table)
    key, fold, label = (table[c].to_numpy() for c in ("key", "fold", "label"))
    bins = _matrix(table["bins"].chunk(0), "u1") if n else np.zeros((0, d), np.uint8)
    most = max(1, min(-(-len(settings) // (4 * session.sparkContext.defaultParallelism)), _HELD // (4 * max(n, 1))))
    alike: dict[tuple, list[int]] = {}
    for m, s in enumerate(settings):
        alike.setdefault((s.held_out, s.row_share), []).append(m)
    tasks = [own[k : k + most] for own in alike.values() for k in range(0, len(own), most)]
    held = session.sparkContext.broadcast((key, fold, label, bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                own = tasks[t]
                grower = _Grower(*held.value, settings[own[0]].held_out, settings[own[0]].row_share, width)
                trees, staged = grower.fit([settings[m] for m in own], allowed[:, own], seed, stages)
                parts = [[getattr(x, c)[k].tobytes() for x in trees] for k in range(len(own)) for c in ("feature", "cut", "value")]
                columns = [pa.array(own, pa.int32()), *(pa.array([b"".join(p) for p in parts[c::3]], pa.binary()) for c in range(3))]
                staged = [np.array([staged[r][k] for r in stages], np.int64).tobytes() for k in range(len(own))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(staged, pa.binary())], names=["model", "feature", "cut", "value", "staged"])

    made = session.range(0, len(tasks), numPartitions=len(tasks)).mapInArrow(run, "model int, feature binary, cut binary, value binary, staged binary").toArrow()  # a row per model
    held.destroy()
    deepest = max(s.depth for s in settings)
    fitted.rounds.extend(Trees.empty(len(settings), deepest) for _ in range(rounds))
    fitted.staged.update((r, np.zeros((len(settings), 2), np.int64)) for r in stages)
    for r in made.to_pylist():
        m = r["model"]
        size = 2 << settings[m].depth
        for name, kind in (("feature", "<i2"), ("cut", "<i2"), ("value", "<f4")):
            for trees, own in zip(fitted.rounds, np.frombuffer(r[name], kind).reshape(rounds, -1)):
                getattr(trees, name)[m, :size] = own[:size]
        for stage, counts in zip(stages, np.frombuffer(r["staged"], np.int64).reshape(-1, 2)):
            fitted.staged[stage][m] = counts
    return fitted


class _Grower:
    """Grows models that see the same rows, those of a held-out fold last; nothing leaves the task.

    Sums are taken by node and the bins of two features at once, and the place of a row among them says where it goes.
    """

    def __init__(self, key: np.ndarray, fold: np.ndarray, label: np.ndarray, bins: np.ndarray, held_out: int, share: float, width: int):
        order = np.argsort(fold == held_out, kind="stable")
        self.seen, self.share, self.width = int((fold != held_out).sum()), share, width
        self.key, self.label, self.bins = key[order][: self.seen], label[order], np.ascontiguousarray(bins[order].T)

    def fit(self, settings: list[Setting], allowed: np.ndarray, seed: int, stages: Sequence[int]) -> tuple[list[Trees], dict[int, np.ndarray]]:
        """A round's trees of all models, and right predictions and rows of the held-out fold after some rounds."""
        n, deepest = len(self.label), max(s.depth for s in settings)
        margins, order, rounds, staged = np.zeros((len(settings), n), np.float32), np.arange(n), [], {}
        label, paired = self.label, self.width**2 << (deepest - 1) <= _CELLS
        for r in range(1, len(allowed) + 1):
            used, place = self.seen, order
            if self.share < 1:  # the rows of this round first, then the others
                drawn = uniform(self.key, seed * 1000 + r) < self.share
                place = np.concatenate([np.flatnonzero(drawn), np.flatnonzero(~drawn), np.arange(self.seen, n)])
                used, label = int(drawn.sum()), self.label[place]
                back = np.empty(n, np.int64)
                back[order] = np.arange(n)
                moved = back[place]
            codes: dict[tuple[int, int], np.ndarray] = {}
            now, gains = Trees.empty(len(settings), deepest), np.zeros((len(settings), 2 << deepest))
            for m, s in enumerate(settings):
                if self.share < 1:
                    margins[m] = margins[m].take(moved)
                pairs = self._pairs(allowed[r - 1, m], paired)
                for p in pairs:
                    if p not in codes:
                        codes[p] = self._codes(p, place if self.share < 1 else None)
                self._tree(m, s, allowed[r - 1, m], pairs, [codes[p] for p in pairs], margins[m], label, used, now, gains)
            order = place
            rounds.append(now)
            if r in stages:
                right = ((margins[:, self.seen :] > 0) == (self.label[self.seen :] == 1)).sum(axis=1)
                staged[r] = np.stack([right, np.full(len(settings), n - self.seen)], axis=1)
        return rounds, staged

    def _pairs(self, allowed: np.ndarray, paired: bool) -> list[tuple[int, int]]:
        """Two features each, or one and -1, that have all columns a tree sees."""
        own = np.flatnonzero(allowed).tolist()
        if not paired or len(own) < 2:
            return [(f, -1) for f in own]
        own += own[-2:-1] if len(own) % 2 else []  # the last of an odd number has company that counts elsewhere
        return list(zip(own[::2], own[1::2]))

    def _codes(self, pair: tuple[int, int], place: np.ndarray | None) -> np.ndarray:
        first, second = pair
        code = self.bins[first] if second < 0 else self.bins[first].astype(np.uint16) * np.uint16(self.width) + self.bins[second]
        return code if place is None else code.take(place)

    def _tree(
        self, m: int, s: Setting, allowed: np.ndarray, pairs: list[tuple[int, int]], codes: list[np.ndarray], margin: np.ndarray,
        label: np.ndarray, used: int, now: Trees, gains: np.ndarray,
    ) -> None:
        """Grow one model's tree on the first ``used`` rows and add what it says to all margins."""
        if not s.depth:
            return
        width, d = self.width, len(self.bins)
        shape = (width, width) if pairs[0][1] >= 0 else (width,)
        cells, blocks = int(np.prod(shape)), [slice(a, min(a + _BLOCK, used)) for a in range(0, used, _BLOCK)]
        owner = {f: (j, axis) for j, p in reversed([*enumerate(pairs)]) for axis, f in enumerate(p) if f >= 0}
        feature, cut, value = now.feature[m], now.cut[m], now.value[m]
        weight, spots = np.empty(used, np.complex128), [c[:used].astype(np.int64) for c in codes]
        for b in blocks:
            p = 1 / (1 + np.exp(-margin[b]))
            weight.real[b], weight.imag[b] = p - label[b], p * (1 - p)
        steps, level = [], 0
        while level < s.depth:
            nodes = 1 << level
            sums = [np.zeros(nodes * cells, np.complex128) for _ in pairs]
            for b in blocks:
                if steps:
                    self._step(steps[-1], [x[b] for x in spots], [c[b] for c in codes])
                for total, spot in zip(sums, spots):
                    np.add.at(total, spot[b], weight[b])
            total = np.zeros((nodes, d, width), np.complex128)
            for f, (j, axis) in owner.items():
                own = sums[j].reshape(nodes, *shape)
                total[:, f] = own if len(shape) == 1 else own.sum(axis=2 - axis)
            k, f, c, gain, left, right, here = _best(total.view(np.float64).reshape(nodes, d, width, 2), s, allowed)
            if level == 0:
                value[nodes + k] = here
            elif len(k):
                alive = feature[(nodes + k) >> 1] >= 0  # rows that stopped above go along to the left
                k, f, c, gain, left, right = (x[alive] for x in (k, f, c, gain, left, right))
            grows = f >= 0
            node, f, c, gain, left, right = (x[grows] for x in (nodes + k, f, c, gain, left, right))
            feature[node], cut[node], gains[m, node] = f, c, gain
            value[2 * node], value[2 * node + 1] = left, right
            level += 1
            if level == s.depth or not len(node):
                break
            steps.append(self._table(feature, cut, level - 1, owner, shape, len(pairs), lambda at: at * cells, np.int64))
        one = Trees(now.feature[m : m + 1], now.cut[m : m + 1], now.value[m : m + 1])
        _prune(one, gains[m : m + 1], np.array([s.gamma]))
        reached = np.array(value)  # by node the value of the place where a row stops
        for nodes in (np.arange(1 << k, 2 << k) for k in range(1, level + 1)):
            reached[nodes] = np.where(feature[nodes >> 1] < 0, reached[nodes >> 1], reached[nodes])
        last = self._table(feature, cut, level - 1, owner, shape, len(pairs), lambda at: reached[at + (1 << level)], np.float32)
        for a in range(0, len(margin), _BLOCK):
            for b in (slice(a, min(a + _BLOCK, used)), slice(max(a, used), min(a + _BLOCK, len(margin)))):
                if b.start >= b.stop:
                    continue
                at = [x[b] for x in spots] if b.stop <= used else [c[b].astype(np.int64) for c in codes]
                for step in steps if b.start >= used else ():
                    self._step(step, at, [c[b] for c in codes])
                for x, spot in zip(last, at):
                    margin[b] += x.take(spot)

    @staticmethod
    def _step(step: list[np.ndarray], spots: list[np.ndarray], codes: list[np.ndarray]) -> None:
        """Rows go one level down, in place."""
        base = step[0].take(spots[0])
        for table, spot in zip(step[1:], spots[1:]):
            base += table.take(spot)
        for spot, code in zip(spots, codes):
            np.add(base, code, out=spot)

    @staticmethod
    def _table(feature, cut, level: int, owner: dict, shape: tuple, pairs: int, answer, kind) -> list[np.ndarray]:
        """By pair and place of a row, what is said of the node below that the row goes to; 0 by all pairs but the one that decides."""
        nodes, bins = 1 << level, np.arange(shape[0])
        tables = [np.zeros((nodes, *shape), kind) for _ in range(pairs)]
        f, c = feature[nodes : 2 * nodes], cut[nodes : 2 * nodes]
        for own in np.unique(f).tolist():
            k = np.flatnonzero(f == own)
            j, axis = owner[own] if own >= 0 else (0, 0)
            said = answer(2 * k[:, None] + ((bins > c[k, None]) if own >= 0 else np.zeros(len(bins), bool)))
            tables[j][k] = said if len(shape) == 1 else said[:, :, None] if axis == 0 else said[:, None, :]
        return [t.reshape(-1) for t in tables]


def _advanced(models: int, newest: list[Trees]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, models):
            *_, bins, margins = _batch(batch, models)
            columns = [batch.column(c) for c in ("key", "fold", "label", "bins")] + [_packed(_advance(margins, bins, newest))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fold", "label", "bins", "margins"])

    return run


def _validated(state: DataFrame, held: np.ndarray, newest: list[Trees]) -> np.ndarray:
    """(model, 2): right predictions and rows of each model's held-out fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(held), 2), dtype=np.int64)
        for batch in _slices(batches, len(held)):
            _, fold, label, bins, margins = _batch(batch, len(held))
            own = fold[:, None] == held
            total += np.stack([(own & ((_advance(margins, bins, newest) > 0) == (label[:, None] == 1))).sum(axis=0), own.sum(axis=0)], axis=1)
        columns = [np.arange(len(held)), *total.T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["model", "right", "n"])

    counted = state.mapInArrow(run, "model long, right long, n long").groupBy("model").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))
    out = np.zeros((len(held), 2), dtype=np.int64)
    for r in counted.collect():  # a row per model
        out[r.model] = r.right, r.n
    return out


def boosted_grid(
    df: DataFrame, key: Sequence[str], fold: str, folds: int, grid: Mapping[str, Sequence], rounds: int, base: Setting = Setting(),
    bins: int = 32, stages: Sequence[int] = (), seed: int = 42, features: str = "features", label: str = "label",
) -> tuple[Boosted, DataFrame]:
    """Mean accuracy over the folds of every combination of settings, and the best one fitted on all rows.

    All combinations, each once per held-out fold and once on all rows, are fitted together. The table has a row per
    combination and number of rounds in ``stages`` (the whole number always); ties go to the earlier combination.
    """
    names = list(grid)
    combos = [replace(base, **dict(zip(names, values))) for values in product(*grid.values())]
    settings = [replace(c, held_out=f) for c in combos for f in (*range(folds), -1)]
    cuts = cut_points(df, features, bins)
    fitted = fit_boosted(binned(df, features, label, key, cuts, fold), settings, rounds, cuts, seed, stages)
    lines, best = [], (-1.0, 0)
    for r, counts in sorted(fitted.staged.items()):
        for k, combo in enumerate(combos):
            own = counts[k * (folds + 1) : k * (folds + 1) + folds]
            accuracy = float(np.mean(own[:, 0] / np.maximum(own[:, 1], 1)))
            values = [getattr(combo, n) for n in names]
            lines.append((*(v if n == "depth" else float(v) for n, v in zip(names, values)), r, accuracy))
            if r == rounds and accuracy > best[0]:
                best = accuracy, k
    kinds = ", ".join(f"{n} {'int' if n == 'depth' else 'double'}" for n in names)
    table = df.sparkSession.createDataFrame(lines, f"{kinds}, rounds int, accuracy double")
    return fitted.only(best[1] * (folds + 1) + folds), table
