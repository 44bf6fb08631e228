"""What training leaves behind, as tables that a later job reads back: detector and segmentation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.operators import anomaly, profiles
from stopflow.operators.centres import Centres


def _keep(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


@dataclass
class Detector:
    """An isolation forest with its threshold, and the moments that counts are held against."""

    forest: anomaly.IsolationForest
    moments: DataFrame

    def save(self, path: str) -> None:
        _keep(self.forest.nodes, f"{path}/nodes")
        _keep(self.moments, f"{path}/moments")
        about = [(self.forest.sample, self.forest.threshold)]
        _keep(self.moments.sparkSession.createDataFrame(about, "sample int, threshold double").coalesce(1), f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Detector:
        about = spark.read.parquet(f"{path}/about").first()
        forest = anomaly.IsolationForest(spark.read.parquet(f"{path}/nodes"), about["sample"], about["threshold"])
        return cls(forest, spark.read.parquet(f"{path}/moments"))

    def judge(self, observed: DataFrame, daily: DataFrame) -> DataFrame:
        """A verdict for every observed (stop, n)."""
        return anomaly.detect_all(anomaly.observed_inputs(observed, daily, self.moments), self.forest)


@dataclass
class Segmentation:
    """Scaler, centres and the label of every known stop."""

    scale: DataFrame
    centres: Centres
    labels: DataFrame

    def save(self, path: str) -> None:
        spark = self.labels.sparkSession
        _keep(self.scale.coalesce(1), f"{path}/scale")
        _keep(self.labels.select("stop", "cluster", "profile"), f"{path}/labels")
        points = [(i, c, float(x), self.centres.cost) for i, p in enumerate(self.centres.points) for c, x in zip(self.centres.columns, p, strict=True)]
        _keep(spark.createDataFrame(points, "cluster int, measure string, value double, cost double").coalesce(1), f"{path}/centres")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Segmentation:
        points: dict[int, dict[str, float]] = {}
        cost = 0.0
        for r in spark.read.parquet(f"{path}/centres").collect():  # one row per cluster and measure
            points.setdefault(r["cluster"], {})[r["measure"]] = r["value"]
            cost = r["cost"]
        columns = [c for c in profiles.SCALED if c in points[0]]
        centres = Centres(columns, np.array([[points[i][c] for c in columns] for i in sorted(points)]), cost)
        return cls(spark.read.parquet(f"{path}/scale"), centres, spark.read.parquet(f"{path}/labels"))

    def label(self, stop_profiles: DataFrame) -> DataFrame:
        """Nearest centre of profiles, known or not."""
        return self.centres.transform(profiles.standardize(stop_profiles, self.scale))

    def assign(self, requests: DataFrame, new_profiles: DataFrame) -> DataFrame:
        """Stored label for a known stop, the nearest centre for another."""
        return profiles.assign_cluster(requests, self.labels, new_profiles, self.scale, self.centres)


def literal_forest(spark: SparkSession, trees: list[list[tuple]], sample: int, threshold: float) -> anomaly.IsolationForest:
    """A forest given by its nodes: (feature, threshold, left, right, length), feature -1 in leaves."""
    rows = [(t, i, *node) for t, tree in enumerate(trees) for i, node in enumerate(tree)]
    return anomaly.IsolationForest(spark.createDataFrame(rows, anomaly.NODE_SCHEMA), sample, threshold)
