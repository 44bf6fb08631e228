"""Forests and boosted trees over one stored table of binned rows.

Every feature is reduced to at most 64 bins, a byte each, once for all models.
A node's split needs only its histogram of sums by (feature, bin), so levels of
all trees of a forest grow together: each task adds up its rows' histograms, one
combined sum per (tree, node) chooses the split, and only splits reach the driver.
Once a node holds at most `LOCAL` rows, those rows are dealt to one task, which
grows the rest of its subtree from the same histograms; a node's group is bounded
by that number however large the table. Boosting grows its trees one after the
other by the same steps, on rows and columns sampled per tree; a table that is one
such group keeps its task for `STEP` rounds.

Samples are drawn from the number of a stored block and of a tree, so a task that
is run again on another executor draws the same rows. What boosting has learnt is
written back to the table every `KEEP` rounds; in between, a task recomputes it
from the few trees since, so nothing depends on memory of lost executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.operators.trees import Ensemble, predicted
from stopflow.session import remove_path, scratch_path

BINS = 64
BLOCK = 1 << 12
#: Rows of a node below which one task grows what is under it.
LOCAL = 1 << 16
#: Boosting rounds after which margins are brought up to date, and after which they are written to a table.
STEP, KEEP = 25, 100

Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]
TABLE = "bins binary, target binary, margin binary"


class BinnedTable:
    """Rows as stored blocks: bins (rows x features bytes), target and margin (doubles).

    A bin counts the edges below a value; edges are quantiles that occur in the data.
    """

    def __init__(self, rows: DataFrame, features: list[str], target: str, bins: int = BINS):
        self.spark, self.features, self.paths = rows.sparkSession, features, []
        shares = [i / bins for i in range(1, bins)]
        quantiles = rows.agg(F.count("*").alias("_rows"), *[F.percentile_approx(c, shares, 10_000).alias(c) for c in features]).first()
        self.rows = quantiles["_rows"]
        self.edges = [np.unique(np.array(quantiles[c] or [], dtype=float)) for c in features]
        edges = self.edges

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *columns, y = (np.asarray(c.to_numpy(zero_copy_only=False), dtype=float) for c in batch.columns)
                packed = np.column_stack([np.searchsorted(e, x, "left") for e, x in zip(edges, columns, strict=True)]).astype(np.uint8)
                for at in range(0, len(y), BLOCK):
                    part = slice(at, at + BLOCK)
                    values = packed[part].tobytes(), y[part].tobytes(), np.zeros(len(y[part])).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([v], type=pa.binary()) for v in values], names=["bins", "target", "margin"])

        cast = rows.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]])
        # Tasks with less than a block are not worth their start.
        self.table = self._stored(cast.coalesce(max(1, -(-self.rows // BLOCK))).mapInArrow(pack, TABLE))

    def _stored(self, blocks: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "binned")
        blocks.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
        self.paths.append(path)
        return self.spark.read.parquet(path)

    def release(self) -> None:
        """Remove what is stored."""
        while self.paths:
            remove_path(self.spark, self.paths.pop())

    def blocks(self, table: DataFrame) -> RDD:
        width = len(self.features)

        def opened(row) -> Block:
            return row.block, np.frombuffer(row.bins, np.uint8).reshape(-1, width), np.frombuffer(row.target), np.frombuffer(row.margin)

        return table.rdd.map(opened)

    def with_margins(self, blocks: RDD) -> DataFrame:
        """The table with the margins of blocks; margins stored before are removed."""
        closed = blocks.map(lambda b: tuple(bytearray(x.tobytes()) for x in b[1:]))
        new = self._stored(self.spark.createDataFrame(closed, TABLE))
        while len(self.paths) > 2:
            remove_path(self.spark, self.paths.pop(1))
        return new


@dataclass
class Nodes:
    """One tree: children are numbers of nodes, -1 where there are none; `cut` is the last bin that goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    total: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, weight: float, total: float) -> int:
        for values, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.weight, weight), (self.total, total), (self.gain, 0.0)):
            values.append(value)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, cut: int, gain: float, sides: list[tuple[float, float]]) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = (self.add(*side) for side in sides)
        return self.left[node], self.right[node]

    def graft(self, node: int, other: Nodes) -> None:
        """Put another tree, grown from a node, in its place."""
        shift = len(self.feature) - 1
        moved = lambda child: child + shift if child > 0 else -1  # noqa: E731 - its root stays where the node is
        for name in ("feature", "cut", "weight", "total", "gain"):
            mine, new = getattr(self, name), getattr(other, name)
            mine[node] = new[0]
            mine += new[1:]
        for name in ("left", "right"):
            mine, new = getattr(self, name), [moved(c) for c in getattr(other, name)]
            mine[node] = new[0]
            mine += new[1:]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v) for v in (self.feature, self.cut, self.left, self.right))


def place(bins: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node of each row among the nodes so far."""
    feature, cut, left, right = tree
    at = np.zeros(len(bins), dtype=np.int64)
    live = np.arange(len(bins)) if feature[0] >= 0 else np.array([], dtype=np.int64)
    while len(live):
        node = at[live]
        at[live] = node = np.where(bins[live, feature[node]] <= cut[node], left[node], right[node])
        live = live[feature[node] >= 0]
    return at


@dataclass(frozen=True)
class Shape:
    depth: int
    least: float
    l2: float = 0.0
    bins: int = BINS


def best_splits(weight: np.ndarray, total: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """For histograms (nodes, bins) of one feature: gain and cut of each node's best split (-inf where none is allowed) and its left sums."""
    w, t = weight.cumsum(axis=1), total.cumsum(axis=1)
    all_w, all_t = w[:, -1:], t[:, -1:]
    rest_w, rest_t = all_w - w, all_t - t
    allowed = (w >= shape.least) & (rest_w >= shape.least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = t * t / (w + shape.l2) + rest_t * rest_t / (rest_w + shape.l2) - all_t * all_t / (all_w + shape.l2)
    gain = np.where(allowed, gain, -np.inf)
    cut = gain.argmax(axis=1)
    each = np.arange(len(cut))
    return gain[each, cut], cut, w[each, cut], t[each, cut]


def histogram(bins: np.ndarray, weight: np.ndarray, target: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    """(2, columns, bins): weights and weighted targets."""
    out = np.empty((2, len(columns), width))
    for i, c in enumerate(columns):
        out[0, i] = np.bincount(bins[:, c], weights=weight, minlength=width)
        out[1, i] = np.bincount(bins[:, c], weights=weight * target, minlength=width)
    return out


def grow_in_task(bins: np.ndarray, weight: np.ndarray, target: np.ndarray, columns: np.ndarray, depth: int, shape: Shape) -> Nodes:
    """The tree under a node whose rows are all here, level by level."""
    tree, pulled = Nodes(), weight * target
    frontier = np.array([tree.add(float(weight.sum()), float(pulled.sum()))])
    at, live = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    for _ in range(depth):
        n = len(frontier)
        gain, feature = np.full(n, -np.inf), np.zeros(n, dtype=np.int64)
        cut, w, t = np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n)
        base, own_weight, own_pull = at * shape.bins, weight[live], pulled[live]
        for c in columns:
            key = base + bins[live, c]
            sums = (np.bincount(key, weights=v, minlength=n * shape.bins).reshape(n, -1) for v in (own_weight, own_pull))
            new, its_cut, left_w, left_t = best_splits(*sums, shape)
            better = new > gain
            gain[better], feature[better], cut[better], w[better], t[better] = new[better], c, its_cut[better], left_w[better], left_t[better]
        scale = np.array([tree.total[node] ** 2 / (tree.weight[node] + shape.l2 + 1e-300) for node in frontier])
        chosen = np.flatnonzero(gain > 1e-12 * scale + 1e-300)
        if not len(chosen):
            break
        # Rows of children that may be split again go on; the frontier holds nothing else.
        child = np.full((n, 2), -1, dtype=np.int64)
        following = []
        for i in chosen.tolist():
            node = int(frontier[i])
            sides = [(float(w[i]), float(t[i])), (tree.weight[node] - float(w[i]), tree.total[node] - float(t[i]))]
            for side, new in enumerate(tree.split(node, int(feature[i]), int(cut[i]), float(gain[i]), sides)):
                if sides[side][0] >= 2 * shape.least:
                    child[i, side] = len(following)
                    following.append(new)
        at = child[at, (bins[live, feature[at]] > cut[at]).astype(np.int64)]
        live, at = live[at >= 0], at[at >= 0]
        if not len(live):
            break
        frontier = np.array(following)
    return tree


def grow(blocks: RDD, rows: int, sample: Callable, columns: dict[int, np.ndarray], shape: Shape, local: int) -> dict[int, Nodes]:
    """Grow the trees named by `columns` (tree to its columns) together.

    `sample(block, tree)` gives the places, weights and targets of a block's rows in a tree.
    """
    trees = {t: Nodes() for t in columns}
    for tree in trees.values():
        tree.add(float(rows), 0.0)
    wide = [(t, 0) for t in trees if rows > local]
    narrow = [(t, 0, shape.depth) for t in trees if rows <= local]
    parallel = blocks.context.defaultParallelism
    level = 0

    def rows_of(block: Block, arrays: dict, wanted: dict[int, list[int]]) -> Iterator[tuple]:
        for t, nodes in wanted.items():
            places, weight, target = sample(block, t)
            bins = block[1][places]
            at = place(bins, arrays[t])
            for node in nodes:
                mine = at == node
                if mine.any():
                    yield (t, node), bins[mine], weight[mine], target[mine]

    def by_tree(nodes: list[tuple]) -> dict[int, list[int]]:
        out: dict[int, list[int]] = {}
        for t, node, *_ in nodes:
            out.setdefault(t, []).append(node)
        return out

    while wide and level < shape.depth:
        arrays, wanted = {t: trees[t].arrays() for t, _ in wide}, by_tree(wide)

        def partial(block, arrays=arrays, wanted=wanted):
            for key, bins, weight, target in rows_of(block, arrays, wanted):
                yield key, histogram(bins, weight, target, columns[key[0]], shape.bins)

        def choose(sums):
            found = [best_splits(sums[0, i : i + 1], sums[1, i : i + 1], shape) for i in range(sums.shape[1])]
            best = max(range(len(found)), key=lambda i: (found[i][0][0], -i))
            gain, cut, w, t = (float(v[0]) for v in found[best])
            return float(sums[0, 0].sum()), float(sums[1, 0].sum()), best, gain, int(cut), w, t

        splits = blocks.flatMap(partial).reduceByKey(np.add, min(len(wide), parallel)).mapValues(choose).collect()
        wide, level = [], level + 1
        for (t, node), (weight, total, best, gain, cut, w, left) in sorted(splits):
            tree = trees[t]
            tree.weight[node], tree.total[node] = weight, total
            if gain <= 1e-12 * total * total / (weight + shape.l2 + 1e-300):
                continue
            sides = [(w, left), (weight - w, total - left)]
            for child, (size, _) in zip(tree.split(node, int(columns[t][best]), cut, gain, sides), sides, strict=True):
                if size > local:
                    wide.append((t, child))
                elif level < shape.depth and size >= 2 * shape.least:
                    narrow.append((t, child, shape.depth - level))

    if narrow:
        arrays, wanted = {t: trees[t].arrays() for t, *_ in narrow}, by_tree(narrow)
        depth = {(t, node): left for t, node, left in narrow}

        def deal(block):
            yield from ((key, rest) for key, *rest in rows_of(block, arrays, wanted))

        def finish(dealt):
            key, parts = dealt
            bins, weight, target = (np.concatenate(p) for p in zip(*parts, strict=True))
            return key, grow_in_task(bins, weight, target, columns[key[0]], depth[key], shape)

        if len(narrow) > 1:
            groups = blocks.flatMap(deal).groupByKey(min(len(narrow), 4 * parallel))
        else:  # one bounded group needs no shuffle
            (only,) = depth
            groups = blocks.coalesce(1).flatMap(deal).values().glom().filter(len).map(lambda parts: (only, parts))
        for (t, node), under in groups.map(finish).collect():
            trees[t].graft(node, under)
    return trees


@dataclass
class TreeModel:
    """A fitted ensemble: `base` plus the mean (`averaged`) or the sum of its trees."""

    ensemble: Ensemble
    features: list[str]
    averaged: bool
    base: float = 0.0

    def transform(self, rows: DataFrame) -> DataFrame:
        """rows with `prediction`."""
        return predicted(rows, self.ensemble, self.features, self.averaged, self.base)

    def importances(self) -> dict[str, float]:
        """Share of all gain by feature; each tree of an average counts the same."""
        total = self.ensemble.gains(len(self.features), each_alike=self.averaged)
        return dict(zip(self.features, (total / total.sum() if total.sum() else total).tolist(), strict=True))

    def save(self, spark, path: str) -> None:
        spark.createDataFrame(self.ensemble.frame()).write.mode("overwrite").parquet(f"{path}/nodes")
        about = [(i, name, self.averaged, self.base) for i, name in enumerate(self.features)]
        spark.createDataFrame(about, "position int, feature string, averaged boolean, base double").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark, path: str) -> TreeModel:
        about = spark.read.parquet(f"{path}/about").orderBy("position").collect()
        return cls(Ensemble(spark.read.parquet(f"{path}/nodes")), [r["feature"] for r in about], about[0]["averaged"], about[0]["base"])


def _ensemble(trees: list[Nodes], edges: list[np.ndarray], value: Callable[[float, float], float]) -> Ensemble:
    import pandas as pd

    frames = []
    for t, tree in enumerate(trees):
        weight, total, feature, cut = (np.array(v) for v in (tree.weight, tree.total, tree.feature, tree.cut))
        threshold = np.zeros(len(feature))
        for f, edge in enumerate(edges):
            at = feature == f
            threshold[at] = edge[cut[at]] if len(edge) else 0.0
        frames.append(
            pd.DataFrame(
                {
                    "tree": t,
                    "node": np.arange(len(feature)),
                    "value": value(weight, total),
                    "rows": weight,
                    "feature": feature,
                    "threshold": threshold,
                    "left": tree.left,
                    "right": tree.right,
                    "gain": tree.gain,
                }
            )
        )
    return Ensemble(pd.concat(frames, ignore_index=True))


@dataclass(frozen=True)
class Forest:
    """Trees of bootstrap samples, averaged; all features at every split."""

    trees: int = 100
    depth: int = 15
    least: int = 3
    seed: int = 42
    local: int = LOCAL

    def fit(self, table: BinnedTable) -> TreeModel:
        seed = self.seed

        def bootstrap(block: Block, tree: int):
            weight = np.random.default_rng([seed, tree, block[0]]).poisson(1.0, len(block[1])).astype(float)
            places = np.flatnonzero(weight)
            return places, weight[places], block[2][places]

        every = np.arange(len(table.features))
        blocks = table.blocks(table.table).persist()
        grown = grow(blocks, table.rows, bootstrap, {t: every for t in range(self.trees)}, Shape(self.depth, self.least), self.local)
        blocks.unpersist()
        ensemble = _ensemble([grown[t] for t in range(self.trees)], table.edges, lambda w, s: np.divide(s, w, out=np.zeros_like(s), where=w > 0))
        return TreeModel(ensemble, table.features, averaged=True)


@dataclass(frozen=True)
class Boosting:
    """Trees fitted one after the other to what is left, on shares of rows and of columns drawn per tree."""

    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    least: int = 1
    l2: float = 1.0
    seed: int = 42
    local: int = LOCAL

    def fit(self, table: BinnedTable) -> TreeModel:
        shape, rate, seed, share = Shape(self.depth, self.least, self.l2), self.rate, self.seed, self.row_share
        kept_columns = max(1, int(self.column_share * len(table.features)))
        blocks = table.blocks(table.table).persist()
        n, y = blocks.map(lambda b: np.array([len(b[2]), b[2].sum()])).fold(np.zeros(2), np.add)
        if not n:  # nothing to learn from: one leaf of 0
            blocks.unpersist()
            leaf = Nodes()
            leaf.add(0.0, 0.0)
            return TreeModel(_ensemble([leaf], table.edges, lambda w, s: s), table.features, averaged=False)
        base = float(y / n)
        done: list[Nodes] = []

        def columns(number: int) -> np.ndarray:
            return np.sort(np.random.default_rng([seed, number]).permutation(len(table_features))[:kept_columns])

        def scored(tree: Nodes) -> tuple:
            return tree.arrays(), rate * np.array(tree.total) / (np.array(tree.weight) + shape.l2)

        def renewed(block: Block, recent: list[tuple]) -> Block:
            margin = block[3]
            for tree, value in recent:
                margin = margin + value[place(block[1], tree)]
            return (*block[:3], margin)

        def residuals(block: Block, number: int, recent: list[tuple]) -> tuple:
            places = np.flatnonzero(np.random.default_rng([seed, number, block[0]]).random(len(block[1])) < share)
            return places, np.ones(len(places)), (block[2] - base - renewed(block, recent)[3])[places]

        def in_one_task(parts: list[Block], numbers: range) -> list[Nodes]:
            out = []
            for number in numbers:
                samples = [(b[1][places], *rest) for b in parts for places, *rest in [residuals(b, number, [])]]
                out.append(grow_in_task(*(np.concatenate(v) for v in zip(*samples, strict=True)), columns(number), shape.depth, shape))
                parts = [renewed(b, [scored(out[-1])]) for b in parts]
            return out

        table_features, held = table.features, [blocks]
        for first in range(0, self.rounds, STEP):
            numbers = range(first, min(first + STEP, self.rounds))
            if table.rows <= self.local:
                (new,) = blocks.coalesce(1).glom().map(lambda parts, numbers=numbers: in_one_task(parts, numbers)).collect()
            else:
                new, recent = [], []
                for number in numbers:
                    sample = lambda block, number, recent=tuple(recent): residuals(block, number, recent)
                    new.append(grow(blocks, table.rows, sample, {number: columns(number)}, shape, self.local)[number])
                    recent.append(scored(new[-1]))
            done += new
            blocks = blocks.map(lambda b, new=[scored(tree) for tree in new]: renewed(b, new)).persist()
            held.append(blocks)
            if numbers.stop % KEEP == 0 and numbers.stop < self.rounds:
                stored = table.with_margins(blocks)
                while held:
                    held.pop().unpersist()
                blocks = table.blocks(stored).persist()
                held.append(blocks)
        while held:
            held.pop().unpersist()
        return TreeModel(_ensemble(done, table.edges, lambda w, s: rate * s / (w + self.l2)), table.features, averaged=False, base=base)
