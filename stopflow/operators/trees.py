"""Fitted tree ensembles as tables of nodes: predictions, per-tree outputs and Shapley values."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.session import scratch_path


def node_table(model, path: str | None = None) -> DataFrame:
    """(tree, node, value, rows, feature, threshold, left, right) of a forest or tree.

    Reads back what Spark writes when the model is saved.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    if path is None:
        path = scratch_path(spark, "forest")
        model.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    node = "nodeData." if "nodeData" in saved.columns else ""
    tree = F.col("treeID") if "treeID" in saved.columns else F.lit(0)
    return saved.select(
        tree.alias("tree"),
        F.col(f"{node}id").alias("node"),
        F.col(f"{node}prediction").alias("value"),
        F.col(f"{node}rawCount").alias("rows"),
        F.col(f"{node}split.featureIndex").alias("feature"),
        F.try_element_at(f"{node}split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.col(f"{node}leftChild").alias("left"),
        F.col(f"{node}rightChild").alias("right"),
    )


class Ensemble:
    """Trees flattened into arrays: at most trees x 2 ** (depth + 1) nodes, whatever the table."""

    def __init__(self, nodes: DataFrame | pd.DataFrame):
        table = nodes if isinstance(nodes, pd.DataFrame) else nodes.toPandas()
        table = table.sort_values(["tree", "node"], kind="stable")
        sizes = table.groupby("tree").size()
        start = np.repeat((sizes.cumsum() - sizes).to_numpy(), sizes.to_numpy())
        self.roots = (sizes.cumsum() - sizes).to_numpy()
        inner = table["left"].to_numpy() >= 0
        self.feature = np.where(inner, table["feature"].fillna(-1).to_numpy(), -1).astype(np.int64)
        self.threshold = table["threshold"].fillna(0.0).to_numpy(float)
        self.left = table["left"].to_numpy().astype(np.int64) + start
        self.right = table["right"].to_numpy().astype(np.int64) + start
        self.value = table["value"].to_numpy(float)
        self.rows = table["rows"].to_numpy(float)
        self.gain = table["gain"].to_numpy(float) if "gain" in table else np.zeros(len(table))
        #: The leaves as arrays, made by the first batch of a task that needs them.
        self.grouped: list | None = None

    def frame(self) -> pd.DataFrame:
        """The table of nodes again."""
        tree = np.searchsorted(self.roots, np.arange(len(self.feature)), "right") - 1
        first, leaf = self.roots[tree], self.feature < 0
        return pd.DataFrame(
            {
                "tree": tree,
                "node": np.arange(len(self.feature)) - first,
                "value": self.value,
                "rows": self.rows,
                "feature": self.feature,
                "threshold": self.threshold,
                "left": np.where(leaf, -1, self.left - first),
                "right": np.where(leaf, -1, self.right - first),
                "gain": self.gain,
            }
        )

    def gains(self, features: int, each_alike: bool) -> np.ndarray:
        """Gain by feature; `each_alike` scales every tree's gain to 1 first."""
        tree = np.searchsorted(self.roots, np.arange(len(self.feature)), "right") - 1
        inner = self.feature >= 0
        of_tree = np.bincount(tree[inner], weights=self.gain[inner], minlength=len(self.roots))
        scale = np.where(of_tree > 0, of_tree, 1.0)[tree[inner]] if each_alike else 1.0
        return np.bincount(self.feature[inner], weights=self.gain[inner] / scale, minlength=features)

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) outputs of every tree."""
        out = np.empty((len(x), len(self.roots)))
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            live = np.arange(len(x)) if self.feature[root] >= 0 else np.array([], dtype=np.int64)
            while len(live):
                node = at[live]
                down = np.where(x[live, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
                at[live] = down
                live = live[self.feature[down] >= 0]
            out[:, t] = self.value[at]
        return out

    def leaves(self) -> Iterator[tuple[float, dict]]:
        """Every leaf as (value, {feature: (low, high, share of rows that follow)})."""
        feature, threshold, left, right, rows, value = (
            v.tolist() for v in (self.feature, self.threshold, self.left, self.right, self.rows, self.value)
        )
        stack = [(root, {}) for root in self.roots.tolist()]
        while stack:
            node, path = stack.pop()
            f = feature[node]
            if f < 0:
                yield value[node], path
                continue
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            cut = threshold[node]
            for child, lo, hi in ((left[node], low, min(high, cut)), (right[node], max(low, cut), high)):
                stack.append((child, {**path, f: (lo, hi, share * rows[child] / rows[node])}))

    def cuts(self, features: int) -> list[np.ndarray]:
        """The distinct thresholds of each feature; a value's bin is the number of those below it."""
        return [np.unique(self.threshold[self.feature == f]) for f in range(features)]

    def grouped_leaves(self, features: int) -> list[tuple]:
        """Leaves by the set of features on their path: the set (k), values (n), first and last bins that agree and shares (n, k)."""
        groups: dict[tuple, list] = {}
        for value, path in self.leaves():
            names = tuple(sorted(path))
            if names:
                groups.setdefault(names, []).append((value, [path[f] for f in names]))
        cuts = self.cuts(features)
        out = []
        for names, leaves in groups.items():
            paths = np.array([path for _, path in leaves])
            first = np.column_stack([np.searchsorted(cuts[f], paths[:, j, 0], "right") for j, f in enumerate(names)])
            last = np.column_stack([np.searchsorted(cuts[f], paths[:, j, 1], "left") for j, f in enumerate(names)])
            out.append((list(names), np.array([v for v, _ in leaves]), first, last, paths[:, :, 2]))
        return out

    def bins(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) bins: rows of equal bins go the same way in every tree."""
        return np.column_stack([np.searchsorted(cut, x[:, f], "left") for f, cut in enumerate(self.cuts(x.shape[1]))])

    def shapley(self, x: np.ndarray) -> np.ndarray:
        """(rows, features) Shapley values of the mean over trees."""
        return self.shapley_of_bins(self.bins(x))

    def shapley_of_bins(self, bins: np.ndarray, cells: int = 1 << 18) -> np.ndarray:
        """Shapley values of the mean over trees, for rows given by their bins.

        A leaf pays its value when every feature on its path agrees; a feature
        left out agrees with the share of training rows that followed the path.
        What a leaf pays to its k features depends only on which of them agree.
        A row's case is found by adding up one bit per feature, looked up by bin
        for many leaves at once; each case that occurs at a leaf is worked out
        once and then looked up. `cells` bounds the numbers held for a block of leaves.
        """
        if self.grouped is None:
            self.grouped = self.grouped_leaves(bins.shape[1])
        phi = np.zeros(bins.shape)
        rows = len(bins)
        for names, value, first, last, share in self.grouped if rows else ():
            k = len(names)
            sums, taken = np.zeros((rows, k)), np.empty((rows, k))
            block = max(1, cells // max(1 << k, rows))
            for begin in range(0, len(value), block):
                at = slice(begin, begin + block)
                leaves = len(value[at])
                case = np.tile(np.arange(leaves, dtype=np.int64) << k, (rows, 1))
                for j, f in enumerate(names):
                    numbers = np.arange(int(bins[:, f].max()) + 1)[:, None]
                    agree = (numbers >= first[at, j]) & (numbers <= last[at, j])
                    case += (agree.astype(np.int64) << j)[bins[:, f]]
                case = np.ascontiguousarray(case.T)
                occurring = np.flatnonzero(np.bincount(case.ravel(), minlength=leaves << k))
                place = np.empty(leaves << k, dtype=np.int64)
                place[occurring] = np.arange(len(occurring))
                leaf = begin + (occurring >> k)
                paid = _paid((occurring[:, None] >> np.arange(k) & 1).astype(float), value[leaf], share[leaf])
                for its in case:
                    np.take(paid, place[its], axis=0, out=taken, mode="clip")
                    sums += taken
            phi[:, names] += sums
        return phi / len(self.roots)


def _paid(agree: np.ndarray, value: np.ndarray, share: np.ndarray) -> np.ndarray:
    """(cases, k) Shapley values of single leaves, `agree` telling which of a leaf's features agree in a case.

    The Shapley weights are an integral of a product of linear factors over
    [0, 1], which Gauss-Legendre nodes evaluate exactly.
    """
    points, weights = np.polynomial.legendre.leggauss((agree.shape[1] + 1) // 2)
    out = np.zeros(agree.shape)
    for t, w in zip((points + 1) / 2, weights / 2, strict=True):
        factor = agree * t + share * (1 - t)
        out += (w * value * factor.prod(axis=1))[:, None] / factor
    return out * (agree - share)


def _matrix(columns) -> np.ndarray:
    return np.column_stack([c.to_numpy(float) for c in columns])


def _inputs(features: list[str]) -> list:
    return [F.col(c).cast("double") for c in features]


def _sent(df: DataFrame, nodes: DataFrame | Ensemble) -> Broadcast:
    """The ensemble for all tasks; its size is bounded by its trees and their depth."""
    return df.sparkSession.sparkContext.broadcast(nodes if isinstance(nodes, Ensemble) else Ensemble(nodes))


def predicted(df: DataFrame, ensemble: Ensemble, features: list[str], averaged: bool, base: float) -> DataFrame:
    """Add `prediction`: `base` plus the mean or the sum of the trees."""
    sent = _sent(df, ensemble)

    @F.pandas_udf("double")
    def prediction(*columns: pd.Series) -> pd.Series:
        out = sent.value.outputs(_matrix(columns))
        return pd.Series(base + (out.mean(axis=1) if averaged else out.sum(axis=1)))

    return df.withColumn("prediction", prediction(*_inputs(features)))


def tree_spread(df: DataFrame, nodes: DataFrame | Ensemble, features: list[str]) -> DataFrame:
    """Add `trees_mean` and `trees_std` (population) of the single trees' outputs."""
    sent = _sent(df, nodes)

    @F.pandas_udf("trees_mean double, trees_std double")
    def spread(*columns: pd.Series) -> pd.DataFrame:
        out = sent.value.outputs(_matrix(columns))
        return pd.DataFrame({"trees_mean": out.mean(axis=1), "trees_std": out.std(axis=1)})

    return df.withColumn("_spread", spread(*_inputs(features))).select("*", "_spread.*").drop("_spread")


def squared_errors(df: DataFrame, ensemble: Ensemble, features: list[str], label: str, base: float) -> DataFrame:
    """(round, rows, squares): the sum of squared errors of the first trees' sum, after every tree."""
    sent = _sent(df, ensemble)

    def errors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            so_far = base + sent.value.outputs(frame[features].to_numpy(float)).cumsum(axis=1)
            squares = ((so_far - frame[[label]].to_numpy(float)) ** 2).sum(axis=0)
            yield pd.DataFrame({"rows": [len(frame)], "squares": [squares.tolist()]})

    sums = df.select(F.col(label).cast("double").alias(label), *features).mapInPandas(errors, "rows long, squares array<double>")
    long = sums.select("rows", F.posexplode("squares").alias("at", "squares"))
    return long.groupBy((F.col("at") + 1).alias("round")).agg(F.sum("rows").alias("rows"), F.sum("squares").alias("squares"))


def shapley_values(df: DataFrame, nodes: DataFrame | Ensemble, features: list[str]) -> DataFrame:
    """Add `shapley`: an array of one contribution per feature."""
    sent = _sent(df, nodes)

    @F.pandas_udf("array<double>")
    def contributions(*columns: pd.Series) -> pd.Series:
        return pd.Series(list(sent.value.shapley(_matrix(columns))))

    return df.withColumn("shapley", contributions(*_inputs(features)))


def mean_absolute_shapley(df: DataFrame, nodes: DataFrame | Ensemble, features: list[str]) -> DataFrame:
    """One row: the array `shapley` of mean absolute contributions over all rows.

    Rows of equal bins have equal values, so each distinct tuple of bins is worked out once and counts as often as it occurs.
    """
    sent = _sent(df, nodes)

    @F.pandas_udf("array<int>")
    def binned(*columns: pd.Series) -> pd.Series:
        return pd.Series(list(sent.value.bins(_matrix(columns)).astype(np.int32)))

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            count = frame["count"].to_numpy(float)
            paid = np.abs(sent.value.shapley_of_bins(np.stack(frame["bins"].to_numpy()).astype(np.int64)))
            yield pd.DataFrame({"rows": [count.sum()], "paid": [(count @ paid).tolist()]})

    cores = df.sparkSession.sparkContext.defaultParallelism
    tuples = df.select(binned(*_inputs(features)).alias("bins")).groupBy("bins").count().repartition(max(cores, df.rdd.getNumPartitions()))
    parts = tuples.mapInPandas(sums, "rows double, paid array<double>")
    return parts.agg(F.array(*[F.sum(F.get("paid", F.lit(i))) / F.sum("rows") for i in range(len(features))]).alias("shapley"))
