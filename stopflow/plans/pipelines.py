"""Training and refresh jobs composed from the operators."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, Settings
from stopflow.operators import anomaly, cleaning, density, features, profiles, regression
from stopflow.operators.centres import best_centres
from stopflow.session import materialize, spread
from stopflow.sources import readers, sinks


def load_year(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Named raw files to clean, deduplicated validations."""
    rows = cleaning.usable(cleaning.clean_rows(readers.read_raw_files(spark, paths)))
    order = ["source", "carrier", "network", "stop_code", "zone_id", "n"]
    return cleaning.project(cleaning.deduplicate(rows, order))


def prepare_features(spark: SparkSession, rows: DataFrame, calendar_path: str | None, target: str) -> DataFrame:
    calendar = readers.calendar_days(readers.read_calendar(spark, calendar_path)) if calendar_path else None
    sinks.write_features(features.build_features(rows, calendar), target)
    return readers.read_features(spark, target)


def isolation_labels(table: DataFrame, settings: Settings = DEFAULTS, runs: str | None = None) -> tuple[DataFrame, anomaly.IsolationForest]:
    """Grow a forest on a feature table, score every row once, cut at the exact quantile.

    With `runs`, the training's run is added to that table; its figures are observed while the scores are written.
    """
    inputs = materialize(anomaly.with_inputs(table), "inputs")
    forest = anomaly.grow_forest(inputs, ["stop", "day"], settings)
    seen = Observation("isolation")
    beyond = F.count_if(F.abs("z") > settings.z_threshold)
    scored = forest.score(inputs).observe(seen, F.count("*").alias("rows"), F.min("score").alias("lowest"), F.avg("score").alias("mean"), beyond.alias("beyond_z"))
    scored = materialize(scored, "scores")
    anomaly.fit_threshold(forest, scored, settings.contamination)
    if runs:
        params = {"trees": settings.forest_trees, "sample": settings.forest_sample, "contamination": settings.contamination}
        sinks.append_run(sinks.run_metrics(table.sparkSession, "isolation", "isolation forest", params, {**seen.get, "threshold": forest.threshold}), runs)
    return forest.label(scored), forest


def segment_stops(vectors: DataFrame, settings: Settings = DEFAULTS, runs: str | None = None) -> DataFrame:
    """Two- and five-way segmentation with named clusters; with `runs`, a run for each goes to that table."""
    out = vectors.persist()
    best = best_centres(vectors, profiles.SCALED, [2, 5], settings.kmeans_restarts, settings.seed)
    for k, name in ((2, profiles.name_two), (5, profiles.name_five)):
        labelled = best[k].transform(vectors)
        if runs:
            params = {"k": k, "restarts": settings.kmeans_restarts}
            sinks.append_run(sinks.run_metrics(vectors.sparkSession, f"k-means-{k}", "k-means", params, {"cost": best[k].cost}), runs)
        named = profiles.map_labels(labelled, name(labelled)).select(
            "stop", F.col("cluster").alias(f"cluster_k{k}"), F.col("profile").alias(f"profile_k{k}")
        )
        out = out.join(named, "stop")
    return out


def compare_clusterings(vectors: DataFrame, k: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Quality of k-means, the hierarchy and density clusters; empty below two clusters."""
    candidates = {
        "k-means": profiles.best_kmeans(vectors, k, settings.kmeans_restarts, settings.seed).transform(vectors),
        "hierarchical": profiles.hierarchical(vectors, k, settings.seed),
        "density": density.density_clusters(
            vectors.drop("vector"), profiles.SCALED, settings.density_eps, settings.density_min_points
        ),
    }
    rows = []
    for name, labelled in candidates.items():
        labelled = labelled.select("stop", "cluster", *profiles.SCALED).persist()
        clusters = labelled.where(F.col("cluster") != -1).select("cluster").distinct().count()
        noise = labelled.where(F.col("cluster") == -1).count()
        quality = profiles.cluster_quality(labelled).first().asDict() if clusters >= 2 else {}
        rows.append({"algorithm": name, "clusters": clusters, "noise": noise, **quality})
        labelled.unpersist()
    return vectors.sparkSession.createDataFrame(rows, f"algorithm string, clusters bigint, noise bigint, {profiles.QUALITY}")


def training_sides(table: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Stored features split by day, gaps filled, kept for the passes of training."""
    train, test, _ = regression.temporal_split(spread(table), settings.train_share)
    train, test = regression.impute(train, test)
    return train.persist(), test.persist()


def train_traffic(table: DataFrame, settings: Settings = DEFAULTS, runs: str | None = None, **sizes) -> tuple[DataFrame, dict]:
    """Split, impute, fit and compare the four short-term models; with `runs`, a run for each goes to that table."""
    train, test = training_sides(table, settings)
    comparison, fitted = regression.compare_models(train, test, regression.estimators(settings, **sizes), settings)
    if runs:
        record_comparison(comparison, runs, {"share": settings.train_share, **sizes})
    train.unpersist()
    test.unpersist()
    return comparison, fitted


def record_comparison(comparison: DataFrame, runs: str, params: dict) -> None:
    """A run for each compared model, from the figures that were compared."""
    for row in comparison.collect():  # four models
        values = {name: row[name] for name in row.asDict() if isinstance(row[name], float)}
        about = {**params, "status": row["status"], "selected": row["selected"]}
        sinks.append_run(sinks.run_metrics(comparison.sparkSession, row["model"], row["model"], about, values), runs)


def save_model(model: PipelineModel, codes: DataFrame, path: str) -> None:
    """The pipeline (which holds the order of its inputs) and the carrier codes it was trained with."""
    model.write().overwrite().save(f"{path}/pipeline")
    codes.coalesce(1).write.mode("overwrite").parquet(f"{path}/carrier_codes")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/carrier_codes")
