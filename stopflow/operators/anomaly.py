"""Anomalies: z-score rule, isolation forest and their agreement.

The forest follows Liu, Ting and Zhou (2008). Training touches a fixed number of
rows (trees x sample size) whatever the table size; the trees are rows of a table
of at most trees x (2 x sample - 1) nodes, small enough to travel to every task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import ANOMALY_MESSAGES, DEFAULTS, FOREST_INPUTS, WEEKDAYS_EN, Settings
from stopflow.functions.dates import weekday_name
from stopflow.functions.numeric import half_even
from stopflow.functions.quantiles import exact_quantile
from stopflow.operators.features import norm_and_gap, zscores
from stopflow.operators.lookups import last7_mean, score_against_history
from stopflow.session import join_lookup

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, length double"


# -- z-score rule ------------------------------------------------------------


def zscore_anomalies(scored: DataFrame, threshold: float = DEFAULTS.z_threshold) -> DataFrame:
    """Rows beyond the threshold, marked low or high."""
    beyond = scored.where(F.abs("z") > threshold)
    return beyond.withColumn("side", F.when(F.col("z") < 0, F.lit("low")).otherwise(F.lit("high")))


def with_inputs(table: DataFrame) -> DataFrame:
    """Features with z, norm and gap: what the forest looks at."""
    return norm_and_gap(zscores(table))


def extreme_zscores(scored: DataFrame, k: int = 10) -> DataFrame:
    return scored.orderBy(F.desc(F.round(F.abs("z"), 9)), "stop", "day").limit(k)


# -- isolation forest --------------------------------------------------------


def average_path(size: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of `size` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1.0) + 0.5772156649015329) - 2.0 * (size - 1.0) / size


def tree_samples(df: DataFrame, key: list[str], rows: int, settings: Settings = DEFAULTS) -> DataFrame:
    """For every tree, `forest_sample` rows chosen by a hash of the row key.

    A row is hashed to one tree and kept if a second hash is small, so a large
    table emits little more than the rows needed. A table smaller than the total
    is offered several times, each copy with its own hashes. Depends on row
    content only, not on partitioning.
    """
    trees, wanted = settings.forest_trees, min(settings.forest_sample, rows)
    need = trees * wanted
    copies = max(1, math.ceil(4.0 * need / max(rows, 1)))
    # Expect half as much again as needed, plus a margin for small counts.
    share = min(1.0, (1.5 * need + 50.0 * trees) / (rows * copies))
    unit = lambda salt: F.pmod(F.xxhash64(*key, "copy", F.lit(f"{settings.seed}-{salt}")), F.lit(1 << 40)) / float(1 << 40)
    offered = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    offered = offered.withColumn("u", unit("keep")).where(F.col("u") < share)
    offered = offered.withColumn("tree", F.floor(unit("tree") * trees).cast("int"))
    once = offered.groupBy("tree", *key).agg(F.min(F.struct("u", *FOREST_INPUTS)).alias("r"))
    order = Window.partitionBy("tree").orderBy("r.u", *key)
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
    return ranked.select("tree", "rank", *[F.col(f"r.{c}").cast("double").alias(c) for c in FOREST_INPUTS])


def _grow(sample: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One tree over a bounded sample."""
    tree = int(sample["tree"].iloc[0])
    points = sample.sort_values("rank")[FOREST_INPUTS].to_numpy(float)
    limit = math.ceil(math.log2(max(len(points), 2)))
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []

    def split(index: np.ndarray, depth: int) -> int:
        node = len(nodes)
        nodes.append([tree, node, -1, 0.0, -1, -1, depth + average_path(len(index))])
        values = points[index]
        low, high = values.min(axis=0), values.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(usable) == 0:
            return node
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = values[:, feature] <= threshold
        if goes_left.all():
            return node
        left = split(index[goes_left], depth + 1)
        right = split(index[~goes_left], depth + 1)
        nodes[node][2:6] = [feature, threshold, left, right]
        return node

    split(np.arange(len(points)), 0)
    return pd.DataFrame(nodes, columns=[f.split()[0] for f in NODE_SCHEMA.split(", ")])


@dataclass
class IsolationForest:
    nodes: DataFrame
    sample: int
    threshold: float | None = None

    def score(self, df: DataFrame) -> DataFrame:
        """Add `score` in (-1, 0): the lower, the more isolated."""
        table = self.nodes.toPandas().sort_values(["tree", "node"])
        sizes = table.groupby("tree").size()
        start = np.repeat((sizes.cumsum() - sizes).to_numpy(), sizes.to_numpy())
        feature = table["feature"].to_numpy()
        cut = table["threshold"].to_numpy()
        left = table["left"].to_numpy() + start
        right = table["right"].to_numpy() + start
        length = table["length"].to_numpy()
        roots = np.flatnonzero(table["node"].to_numpy() == 0)
        depth = math.ceil(math.log2(max(self.sample, 2)))
        norm = average_path(self.sample) or 1.0

        @F.pandas_udf("double")
        def isolation(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            x = np.column_stack([a.to_numpy(float), b.to_numpy(float), c.to_numpy(float)])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for root in roots:
                at = np.full(len(x), root)
                for _ in range(depth):
                    f = feature[at]
                    down = np.where(x[rows, f] <= cut[at], left[at], right[at])
                    at = np.where(f >= 0, down, at)
                total += length[at]
            return pd.Series(-np.exp2(-(total / len(roots)) / norm))

        filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FOREST_INPUTS]
        return df.withColumn("score", isolation(*filled))

    def label(self, scored: DataFrame) -> DataFrame:
        return scored.withColumn("is_isolated", F.col("score") < F.lit(self.threshold))


def grow_forest(df: DataFrame, key: list[str], settings: Settings = DEFAULTS) -> IsolationForest:
    """Trees from a stored table of forest inputs. Call `fit_threshold` next."""
    rows = df.count()
    seed = settings.seed
    samples = tree_samples(df, key, rows, settings)
    nodes = samples.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, seed), NODE_SCHEMA)
    return IsolationForest(nodes.persist(), min(settings.forest_sample, rows))


def fit_threshold(forest: IsolationForest, scored: DataFrame, share: float = DEFAULTS.contamination) -> IsolationForest:
    """The exact quantile of the training scores below which a row is an anomaly."""
    forest.threshold = exact_quantile(scored, "score", share)
    return forest


def detector_agreement(labelled: DataFrame, threshold: float = DEFAULTS.z_threshold) -> DataFrame:
    by_z = F.abs("z") > threshold
    group = (
        F.when(by_z & F.col("is_isolated"), F.lit("both"))
        .when(by_z, F.lit("z-score only"))
        .when(F.col("is_isolated"), F.lit("forest only"))
    )
    return labelled.withColumn("detector", group).where(F.col("detector").isNotNull()).groupBy("detector").agg(
        F.count("*").alias("rows")
    )


def anomaly_summary(labelled: DataFrame, threshold: float = DEFAULTS.z_threshold) -> DataFrame:
    by_z, isolated = F.abs("z") > threshold, F.col("is_isolated")
    share = lambda flag: F.avg(F.when(isolated, F.col(flag).cast("double"))) * 100.0
    return labelled.agg(
        F.count("*").alias("rows"),
        F.count_if(isolated).alias("isolated"),
        F.count_if(by_z).alias("beyond_z"),
        F.count_if(isolated & by_z).alias("consensus"),
        share("is_weekend").alias("weekend_pct"),
        share("is_holiday").alias("holiday_pct"),
    )


def lowest_scores(scored: DataFrame, k: int = 10) -> DataFrame:
    return scored.orderBy("score", "stop", "day").limit(k)


def anomaly_by_weekday(anomalies: DataFrame) -> DataFrame:
    """Anomalies per weekday, weekdays without any included, plus the four day-type totals."""
    spark = anomalies.sparkSession
    weekdays = spark.createDataFrame([(i, name) for i, name in enumerate(WEEKDAYS_EN)], "position int, label string")
    by_name = anomalies.groupBy(weekday_name(F.col("day")).alias("label")).agg(F.count("*").alias("rows"))
    named = weekdays.join(F.broadcast(by_name), "label", "left").select(
        F.lit("weekday").alias("kind"), "label", F.coalesce("rows", F.lit(0)).alias("rows")
    )
    types = anomalies.agg(
        F.count_if("is_holiday").alias("holiday"),
        F.count_if("is_weekend").alias("weekend"),
        F.count_if("is_vacation").alias("vacation"),
        F.greatest(F.count("*") - F.count_if("is_holiday") - F.count_if("is_weekend"), F.lit(0)).alias("ordinary"),
    )
    long = types.unpivot([], ["holiday", "weekend", "vacation", "ordinary"], "label", "rows")
    return named.unionByName(long.select(F.lit("day type").alias("kind"), "label", "rows"))


def observed_inputs(observed: DataFrame, daily: DataFrame, moments: DataFrame) -> DataFrame:
    """Forest inputs of observed (stop, n) rows, from the stop's history."""
    scored = score_against_history(observed, moments)
    recent = join_lookup(scored, last7_mean(daily), "stop")
    return recent.withColumn("gap", F.col("n") - F.col("recent_mean"))


def z_verdict(limit: float = DEFAULTS.z_message):
    """The side, rounded z and rounded mean shown with a verdict."""
    side = F.when(F.col("z") < -limit, F.lit("low")).when(F.col("z") > limit, F.lit("high")).when(F.col("z").isNotNull(), F.lit("normal"))
    return [side.alias("side"), half_even(F.col("z"), 2).alias("z"), half_even(F.col("mean"), 0).alias("mean")]


def detect_all(observed: DataFrame, forest: IsolationForest, limit: float = DEFAULTS.z_message) -> DataFrame:
    """One verdict per row of `observed_inputs`; rows that cannot be judged keep NULLs and a status."""
    count = F.when(F.col("n").isNull(), F.lit("count missing")).when(F.col("n") < 0, F.lit("count negative"))
    asked = observed.withColumn("status", F.coalesce(F.when(F.col("status") == "ok", count), "status"))
    able = F.col("status") == "ok"
    return detect(asked.where(able), forest, limit).unionByName(asked.where(~able), allowMissingColumns=True)


def detect(observed: DataFrame, forest: IsolationForest, limit: float = DEFAULTS.z_message) -> DataFrame:
    """Verdict and message for observed rows carrying z, norm, gap and mean."""
    labelled = forest.label(forest.score(observed))
    count, mean = F.format_number("n", 0), F.format_number("mean", 0)
    message = (
        F.when(F.col("is_isolated") & (F.col("z") < -limit), F.format_string(ANOMALY_MESSAGES["low"], count, mean))
        .when(F.col("is_isolated") & (F.col("z") > limit), F.format_string(ANOMALY_MESSAGES["high"], count, mean))
        .otherwise(F.format_string(ANOMALY_MESSAGES["normal"], count))
    )
    return labelled.withColumns(
        {"message": message, "score": half_even(F.col("score"), 4), "z": half_even(F.col("z"), 2), "mean": half_even(F.col("mean"), 0)}
    )
