"""Stop profiles and their segmentation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, PROFILE_MEASURES, PROFILE_NAMES_K2, PROFILE_NAMES_K5
from stopflow.functions.dates import is_weekend
from stopflow.functions.gram import gram
from stopflow.functions.numeric import half_even, ratio_or_zero
from stopflow.functions.ranks import ranked
from stopflow.operators.centres import Centres, best_centres
from stopflow.session import join_lookup, materialize

SCALED = [f"{c}_scaled" for c in PROFILE_MEASURES]
QUALITY = "silhouette double, davies_bouldin double, calinski_harabasz double, inertia double"


def stop_profile(daily: DataFrame) -> DataFrame:
    """Five measures per stop: weekday and weekend means, their ratio, volume, variation."""
    weekend = is_weekend(F.col("day"))
    sums = daily.groupBy("stop").agg(
        F.coalesce(F.avg(F.when(~weekend, F.col("n"))), F.lit(0.0)).alias("weekday_mean"),
        F.coalesce(F.avg(F.when(weekend, F.col("n"))), F.lit(0.0)).alias("weekend_mean"),
        F.sum("n").alias("volume"),
        F.avg("n").alias("_mean"),
        F.stddev_samp("n").alias("_std"),
    )
    return sums.select(
        "stop",
        "weekday_mean",
        "weekend_mean",
        ratio_or_zero(F.col("weekend_mean"), F.col("weekday_mean")).alias("weekend_ratio"),
        "volume",
        F.coalesce(ratio_or_zero(F.col("_std"), F.col("_mean")), F.lit(0.0)).alias("variation"),
    )


def scale_of(profiles: DataFrame) -> DataFrame:
    """One row: mean and population deviation of each measure (deviation 1 where there is none)."""
    out = []
    for c in PROFILE_MEASURES:
        spread = F.stddev_pop(c)
        out += [F.avg(c).alias(f"{c}_mean"), F.when(spread > 0, spread).otherwise(1.0).alias(f"{c}_std")]
    return profiles.agg(*out)


def standardize(profiles: DataFrame, scale: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population variance; the scale is a single row of ten numbers."""
    row = (scale_of(profiles) if scale is None else scale).first()
    return profiles.withColumns(
        {f"{c}_scaled": (F.col(c) - F.lit(row[f"{c}_mean"])) / F.lit(row[f"{c}_std"]) for c in PROFILE_MEASURES}
    )


def with_vector(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=SCALED, outputCol="vector").transform(scaled)


# -- k-means -----------------------------------------------------------------


def best_kmeans(vectors: DataFrame, k: int, restarts: int = DEFAULTS.kmeans_restarts, seed: int = DEFAULTS.seed) -> Centres:
    """The cheapest of several k-means runs."""
    return best_centres(vectors, SCALED, [k], restarts, seed)[k]


def hierarchical(vectors: DataFrame, k: int, seed: int = DEFAULTS.seed) -> DataFrame:
    """Top-down hierarchy. Ward's bottom-up merging needs all pairwise distances, this does not.

    Spark splits a cluster by a nudge in proportion to its centre, which is zero
    for standardized data; shifting all points leaves their distances alone.
    """
    shifted = vectors.withColumns({f"{c}_shifted": F.col(c) + 10.0 for c in SCALED})
    shifted = VectorAssembler(inputCols=[f"{c}_shifted" for c in SCALED], outputCol="shifted").transform(shifted)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="shifted", predictionCol="cluster").fit(shifted)
    return model.transform(shifted).drop("shifted", *[f"{c}_shifted" for c in SCALED])


def pca2(vectors: DataFrame) -> tuple[DataFrame, list[float]]:
    """Two principal components and their shares of the variance; the largest loading is positive."""
    loadings, shares = gram(vectors, SCALED).components(2)
    along = lambda i: sum((F.col(c) * F.lit(float(v)) for c, v in zip(SCALED, loadings[:, i], strict=True)), F.lit(0.0))
    return vectors.withColumns({f"pca{i + 1}": along(i) for i in range(2)}), shares.tolist()


# -- quality -----------------------------------------------------------------


def _centers(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(F.count("*").alias("size"), *[F.avg(c).alias(f"{c}_center") for c in SCALED])


def _squared_distance(a: str = "", b: str = "_center"):
    return sum((F.pow(F.col(f"{c}{a}") - F.col(f"{c}{b}"), 2) for c in SCALED), F.lit(0.0))


def inertia(labelled: DataFrame) -> DataFrame:
    joined = join_lookup(labelled, _centers(labelled), "cluster", "inner")
    return joined.agg(F.sum(_squared_distance()).alias("inertia"))


def calinski_harabasz(labelled: DataFrame) -> DataFrame:
    """Spread between centres over spread inside clusters, each per degree of freedom."""
    overall = labelled.agg(*[F.avg(c).alias(c) for c in SCALED]).first()
    joined = join_lookup(labelled, _centers(labelled), "cluster", "inner")
    to_whole = sum((F.pow(F.col(f"{c}_center") - F.lit(overall[c]), 2) for c in SCALED), F.lit(0.0))
    sums = joined.agg(
        F.sum(_squared_distance()).alias("within"),
        F.sum(to_whole).alias("between"),
        F.count("*").alias("rows"),
        F.countDistinct("cluster").alias("clusters"),
    )
    value = F.try_divide(
        F.col("between") * (F.col("rows") - F.col("clusters")), F.col("within") * (F.col("clusters") - 1)
    )
    return sums.select(value.alias("calinski_harabasz"))


#: Centres that meet each other in one go.
TILE = 512


def davies_bouldin(labelled: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / distance between centres.

    Centres are dealt to tiles of at most TILE; every pair of tiles is one row,
    worked out in blocks, and only the worst value of each cluster goes on, so
    no list of all clusters is ever formed. A pair of tiles whose boxes are so far
    apart that it cannot beat what each cluster meets in its own tile is left out.
    """
    centers = _centers(labelled)
    spread = join_lookup(labelled, centers, "cluster", "inner").groupBy("cluster").agg(
        F.avg(F.sqrt(_squared_distance())).alias("spread"),
        *[F.first(f"{c}_center").alias(f"{c}_center") for c in SCALED],
    )
    spread = spread.persist()
    clusters = spread.count()
    center = F.array(*[f"{c}_center" for c in SCALED])
    members = F.collect_list(F.struct("cluster", "spread", center.alias("center"))).alias("members")

    def worst(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for here, there in zip(frame["members"], frame["others"], strict=True):
                (i, s, x), (j, t, y) = ([np.array([m[k] for m in side]) for k in ("cluster", "spread", "center")] for side in (here, there))
                x, y = np.stack(list(x)), np.stack(list(y))
                distance = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
                with np.errstate(divide="ignore", invalid="ignore"):
                    ratio = np.where(i[:, None] == j[None], -np.inf, (s[:, None] + t[None]) / distance)
                yield pd.DataFrame({"cluster": i, "worst": ratio.max(axis=1)})

    found = "cluster long, worst double"
    if clusters <= TILE:
        every = spread.groupBy().agg(members).select("members", F.col("members").alias("others")).where(F.size("members") > 0).mapInPandas(worst, found)
    else:
        every = _worst_by_tiles(spread, members, lambda pairs: pairs.mapInPandas(worst, found))
    value = every.groupBy("cluster").agg(F.max("worst").alias("worst")).where(F.col("worst") >= 0).agg(F.avg("worst")).first()[0]
    spread.unpersist()
    return labelled.sparkSession.createDataFrame([(value,)], "davies_bouldin double")


def _worst_by_tiles(spread: DataFrame, members: Column, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(cluster, worst) from every hopeful pair of tiles; neighbours in the first measure share a tile."""
    placed = ranked(spread, [f"{SCALED[0]}_center", "cluster"], "place").withColumn("tile", F.floor(F.col("place") / TILE))
    low, high = (f(f"{SCALED[0]}_center").alias(name) for f, name in ((F.min, "low"), (F.max, "high")))
    tiles = materialize(placed.groupBy("tile").agg(members, F.max("spread").alias("widest"), low, high), "tiles")
    own = materialize(work(tiles.select("members", F.col("members").alias("others"))), "own-tile")
    least = placed.select("cluster", "tile").join(own, "cluster").groupBy("tile").agg(F.min("worst").alias("least"))
    gap = F.greatest(F.col("b.low") - F.col("a.high"), F.col("a.low") - F.col("b.high"), F.lit(0.0))
    hopeful = (gap == 0) | (F.col("a.widest") + F.col("b.widest") > F.col("a.least") * gap)
    others = F.explode(F.sequence(F.lit(0), F.lit(tiles.count() - 1))).alias("other")
    bounds = tiles.join(least, "tile").select("tile", "widest", "low", "high", "least", others).alias("a")
    pairs = bounds.join(tiles.drop("members").alias("b"), F.col("a.other") == F.col("b.tile")).where((F.col("a.tile") != F.col("b.tile")) & hopeful)
    pairs = pairs.select(F.col("a.tile").alias("tile"), "other")
    met = pairs.join(tiles.select("tile", "members"), "tile").join(tiles.select(F.col("tile").alias("other"), F.col("members").alias("others")), "other")
    return own.unionByName(work(met.select("members", "others")))


def silhouette(labelled: DataFrame) -> DataFrame:
    """Mean silhouette over squared Euclidean distances, the same at every size.

    A profile's mean distance to a cluster follows from the cluster's size, sum
    and sum of squares, so no distances between profiles are taken. A cluster
    of one profile has width 0.
    """
    points = labelled.select("cluster", *SCALED)
    if points.agg(F.countDistinct("cluster")).first()[0] < 2:
        return labelled.sparkSession.createDataFrame([(None,)], "silhouette double")
    vectors = VectorAssembler(inputCols=SCALED, outputCol="vector").transform(points)
    value = ClusteringEvaluator(featuresCol="vector", predictionCol="cluster").evaluate(vectors)
    return labelled.sparkSession.createDataFrame([(value,)], "silhouette double")


def cluster_quality(labelled: DataFrame) -> DataFrame:
    """All four measures in one row; noise (label -1) is left out."""
    kept = labelled.where(F.col("cluster") != -1).select("stop", "cluster", *SCALED).persist()
    parts = [silhouette(kept), davies_bouldin(kept), calinski_harabasz(kept), inertia(kept)]
    values = {k: v for part in parts for k, v in part.first().asDict().items()}
    kept.unpersist()
    return labelled.sparkSession.createDataFrame([values], QUALITY)


def choose_k(vectors: DataFrame, ks=range(2, 11), restarts: int = DEFAULTS.kmeans_restarts) -> DataFrame:
    """Quality for each k, with the best k by each criterion marked."""
    vectors = vectors.persist()
    spark = vectors.sparkSession
    best = best_centres(vectors, SCALED, list(ks), restarts, DEFAULTS.seed)
    rows = []
    with ThreadPoolExecutor(4) as pool:
        qualities = list(pool.map(lambda k: cluster_quality(best[k].transform(vectors)).first(), ks))
    for k, quality in zip(ks, qualities, strict=True):
        rows.append((k, quality["inertia"], quality["silhouette"], quality["davies_bouldin"], quality["calinski_harabasz"]))
    vectors.unpersist()
    table = spark.createDataFrame(rows, "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double")
    everything = Window.partitionBy()
    return table.withColumns(
        {
            "best_silhouette": F.col("k") == F.max_by("k", "silhouette").over(everything),
            "best_davies_bouldin": F.col("k") == F.min_by("k", "davies_bouldin").over(everything),
            "best_calinski_harabasz": F.col("k") == F.max_by("k", "calinski_harabasz").over(everything),
        }
    )


# -- names and summaries -------------------------------------------------------


def cluster_means(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(F.count("*").alias("size"), *[F.avg(c).alias(c) for c in PROFILE_MEASURES])


def cluster_means_scaled(labelled: DataFrame) -> DataFrame:
    """Cluster means, each measure scaled to 0..1 over the clusters."""
    everything = Window.partitionBy()
    lo, hi = lambda c: F.min(c).over(everything), lambda c: F.max(c).over(everything)
    return cluster_means(labelled).select(
        "cluster",
        "size",
        *[F.coalesce(F.try_divide(F.col(c) - lo(c), hi(c) - lo(c)), F.lit(0.0)).alias(c) for c in PROFILE_MEASURES],
    )


def name_two(labelled: DataFrame) -> DataFrame:
    """(cluster, profile): the cluster with the largest mean volume is the hubs."""
    rank = F.row_number().over(Window.orderBy(F.desc("volume"), "cluster"))
    return cluster_means(labelled).select(
        "cluster",
        F.when(rank == 1, F.lit(PROFILE_NAMES_K2["hub"])).otherwise(F.lit(PROFILE_NAMES_K2["standard"])).alias("profile"),
    )


def name_five(labelled: DataFrame) -> DataFrame:
    """(cluster, profile) by picking one cluster per rule from those left over.

    Each pick is the first row of the remaining clusters in the rule's order.
    """
    left = cluster_means(labelled).persist()
    rules = [
        ("hub", F.desc("volume")),
        ("residential", F.asc("weekend_ratio")),
        ("irregular", F.desc("variation")),
        ("large", F.desc("volume")),
    ]
    names = None
    for role, order in rules:
        pick = left.orderBy(order, "cluster").limit(1).select("cluster")
        named = pick.withColumn("profile", F.lit(PROFILE_NAMES_K5[role]))
        names = named if names is None else names.unionByName(named)
        left = left.join(F.broadcast(pick), "cluster", "left_anti")
    return names.unionByName(left.select("cluster", F.lit(PROFILE_NAMES_K5["standard"]).alias("profile")))


def map_labels(labelled: DataFrame, names: DataFrame) -> DataFrame:
    return join_lookup(labelled, names, "cluster")


def topk_per_group(profiles: DataFrame, group: str, k: int) -> DataFrame:
    """The k largest stops of each group; Spark keeps k rows per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("volume"), "stop"))
    return profiles.withColumn("rank", rank).where(F.col("rank") <= k)


def _top_names(profiles: DataFrame, group: str, k: int) -> DataFrame:
    top = topk_per_group(profiles, group, k)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "stop")))
    return top.groupBy(group).agg(F.transform(ordered, lambda s: s["stop"]).alias("top"))


def cluster_summary(labelled: DataFrame, k: int = 5) -> DataFrame:
    """Per cluster: profile name, size, mean volume and the k largest stops."""
    sizes = labelled.groupBy("cluster").agg(
        F.min("profile").alias("profile"), F.count("*").alias("stops"), half_even(F.avg("volume"), 0).alias("mean_volume")
    )
    examples = F.array_join("top", ", ").alias("examples")
    return sizes.join(_top_names(labelled, "cluster", k), "cluster").select(*sizes.columns, examples)


def similar_stops(labelled: DataFrame, k: int = 5) -> DataFrame:
    """For every stop, the k largest other stops of its cluster.

    A cluster's k + 1 largest stops answer for all its members, so no pairs of
    stops are formed.
    """
    top = _top_names(labelled, "cluster", k + 1)
    joined = join_lookup(labelled.select("stop", "cluster"), top, "cluster")
    others = F.slice(F.array_remove("top", F.col("stop")), 1, k)
    return joined.select("stop", "cluster", F.posexplode(others).alias("rank", "similar_stop")).withColumn("rank", F.col("rank") + 1)


def assign_cluster(requests: DataFrame, labelled: DataFrame, new_profiles: DataFrame, scale: DataFrame, model: Centres) -> DataFrame:
    """Stored label for a known stop; for another, its scaled profile's nearest centre."""
    known = labelled.select("stop", "cluster", "profile")
    fresh = new_profiles.join(known, "stop", "left_anti")
    predicted = model.transform(standardize(fresh, scale)).select(
        "stop", "cluster", F.concat(F.lit("Cluster "), F.col("cluster")).alias("profile")
    )
    return join_lookup(requests, known.unionByName(predicted), "stop")
