"""Queries without an SQL equivalent run over the whole tables and keep their invariants."""

import pytest
from pyspark.sql import functions as F

from stopflow.plans import catalog, oracle

CHECKS = {
    "isolation_forest": lambda df: (df.where("score >= 0 OR score <= -1").count(), abs(df.where("is_isolated").count() / df.count() - 0.02) < 0.005) == (0, True),
    "anomaly_summary": lambda df: df.first()["consensus"] <= min(df.first()["isolated"], df.first()["beyond_z"]),
    "detector_agreement": lambda df: {r["detector"] for r in df.collect()} <= {"both", "z-score only", "forest only"},
    "lowest_forest_scores": lambda df: df.count() == 10 and df.where("score >= 0 OR score < -1").count() == 0,
    "detect_anomaly": lambda df: df.where("(status = 'ok') <> (message IS NOT NULL AND score IS NOT NULL)").count() == 0
    and {"ok", "unknown stop", "count negative"} == {r["status"] for r in df.select("status").distinct().collect()},
    "kmeans_profiles": lambda df: df.select("cluster_k5").distinct().count() == df.select("profile_k5").distinct().count() == 5,
    "choose_k": lambda df: [r["k"] for r in df.orderBy("k").collect()] == list(range(2, 11)),
    "assign_cluster": lambda df: df.where("cluster IS NULL").count() == 0,
    "density_clusters": lambda df: df.where("cluster < -1 OR cluster IS NULL").count() == 0,
    "hierarchical_clusters": lambda df: df.count() == 3 and df.where("clusters >= 2 AND (silhouette < -1 OR silhouette > 1 OR davies_bouldin <= 0)").count() == 0,
    "pca2": lambda df: df.first()["share1"] >= df.first()["share2"] > 0,
    "model_comparison": lambda df: df.count() == 4 and df.where("selected").count() <= 1,
    "model_store": lambda df: df.agg(F.max("largest_difference")).first()[0] == 0.0,
    "run_metrics_table": lambda df: df.where("kind = 'metric'").count() == 6,
    "predict_traffic": lambda df: df.where("predicted < 0 OR confidence > 1 OR (status = 'ok') <> (predicted IS NOT NULL)").count() == 0
    and {"ok", "unknown stop", "day missing"} == {r["status"] for r in df.select("status").distinct().collect()},
    "decision_tree": lambda df: df.first()["r2"] > 0.5,
    "random_forest": lambda df: df.first()["r2"] > 0.6,
    "boosted_trees": lambda df: df.first()["r2"] > 0.6,
    "training_runs": lambda df: {r["model"] for r in df.select("model").distinct().collect()} == {"linear", "tree", "forest", "boosted", "k-means", "isolation forest"}
    and df.where("kind = 'metric' AND number IS NULL").count() == 0,
    "feature_attribution": lambda df: df.count() == 48 and df.where("method LIKE 'impurity%' AND (importance < 0 OR importance > 1)").count() == 0,
    "top_factors": lambda df: df.agg(F.max("rank")).first()[0] == 3,
    "learning_curve": lambda df: df.orderBy("round").first()["rmse_train"] >= df.orderBy(F.desc("round")).first()["rmse_train"],
    "linear_model": lambda df: df.count() == 13,
    "long_term_forecast": lambda df: df.where("lower > predicted OR predicted > upper OR (status = 'ok') <> (predicted IS NOT NULL)").count() == 0
    and [r["status"] for r in df.where("stop = 'NO SUCH STOP'").collect()] == ["unknown stop"],
    "forecast_curve": lambda df: {r["kind"] for r in df.select("kind").distinct().collect()} == {"history", "projection"},
    "forecast_backtest": lambda df: df.where("held_out <> 30 OR mae < 0").count() == 0,
    "projection_check": lambda df: df.where("suspect <> (ratio < 0.5)").count() == 0,
    "drift_report": lambda df: {r["status"] for r in df.collect()} <= {"OK", "DRIFT", "REFERENCE MISSING"},
}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(oracle.QUERIES)))
def test_runs_and_keeps_its_invariant(name, spark, folder):
    df = catalog.QUERIES[name](spark, folder).persist()
    assert df.count() > 0
    assert CHECKS.get(name, lambda _: True)(df)
