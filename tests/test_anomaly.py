import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.config import Settings
from stopflow.operators import anomaly, exploration, profiles
from stopflow.operators.centres import best_centres
from stopflow.plans import artefacts, catalog, pipelines

SETTINGS = Settings(forest_trees=50, forest_sample=64)


@pytest.fixture
def inputs(spark):
    rng = np.random.default_rng(0)
    rows = [(f"S{i % 10}", i, *map(float, rng.normal(0, 1, 3))) for i in range(800)]
    rows += [("OUT", i, 12.0 + i, -15.0, 14.0) for i in range(5)]
    return spark.createDataFrame(rows, "stop string, day int, norm double, gap double, z double")


def test_outliers_score_lowest(inputs):
    forest = anomaly.grow_forest(inputs, ["stop", "day"], SETTINGS)
    scored = forest.score(inputs).persist()
    lowest = anomaly.lowest_scores(scored, 5).collect()
    assert {r["stop"] for r in lowest} == {"OUT"}
    assert scored.where((F.col("score") >= 0) | (F.col("score") <= -1)).count() == 0


def test_flagged_share_is_the_contamination(inputs):
    forest = anomaly.grow_forest(inputs, ["stop", "day"], SETTINGS)
    scored = forest.score(inputs).persist()
    flagged = anomaly.fit_threshold(forest, scored, 0.02).label(scored).where("is_isolated").count()
    assert abs(flagged / 805 - 0.02) < 0.005


def test_forest_does_not_depend_on_partitioning(inputs):
    a = anomaly.grow_forest(inputs.repartition(1), ["stop", "day"], SETTINGS).nodes
    b = anomaly.grow_forest(inputs.repartition(13, "day"), ["stop", "day"], SETTINGS).nodes
    key = ["tree", "node"]
    assert a.orderBy(*key).collect() == b.orderBy(*key).collect()


def test_every_tree_gets_its_full_sample(inputs):
    for trees, sample in ((50, 64), (3, 16), (20, 805)):
        settings = Settings(forest_trees=trees, forest_sample=sample)
        sizes = anomaly.tree_samples(inputs, ["stop", "day"], 805, settings).groupBy("tree").count().collect()
        assert len(sizes) == trees
        if sample < 805:
            assert {r["count"] for r in sizes} == {sample}


def test_average_path_matches_the_recursion():
    # Mean external path length of random binary search trees: c(n) = 2 H(n-1) - 2 (n-1) / n.
    for n in (10, 256):
        exact = 2 * sum(1 / i for i in range(1, n)) - 2 * (n - 1) / n
        assert anomaly.average_path(n) == pytest.approx(exact, rel=0.03)


def test_messages(spark):
    forest = anomaly.IsolationForest(
        spark.createDataFrame([(0, 0, 2, -1.0, 1, 2, 0.0), (0, 1, -1, 0.0, -1, -1, 1.0), (0, 2, -1, 0.0, -1, -1, 9.0)], anomaly.NODE_SCHEMA), 4, -0.6
    )
    observed = spark.createDataFrame(
        [(800, -4.0, 0.1, -9.0, 10000.4), (9900, 0.0, 0.9, 0.0, 10000.4)], "n bigint, z double, norm double, gap double, mean double"
    )
    got = anomaly.detect(observed, forest).orderBy("n").collect()
    assert got[0]["is_isolated"] and got[0]["message"].startswith("Trafic anormalement bas") and "800 vs moyenne 10,000" in got[0]["message"]
    assert not got[1]["is_isolated"] and got[1]["message"] == "Trafic normal (9,900 validations)"


def test_stored_detector_and_segmentation_answer_alike(spark, folder, tmp_path):
    """Trained ones: what is read back judges every row as what was stored."""
    table = catalog._features(spark, folder)
    labelled, forest = pipelines.isolation_labels(table)
    daily = labelled.select("stop", "day", "n")
    detector = artefacts.Detector(forest, exploration.stop_moments(labelled))
    detector.save(str(tmp_path / "detector"))
    again = artefacts.Detector.load(spark, str(tmp_path / "detector"))
    asked = daily.where("day(day) = 3").select("stop", "n").unionByName(spark.createDataFrame([("NOWHERE", 3), (None, 1)], "stop string, n bigint"))
    answers = [sorted(map(repr, d.judge(asked, daily).select("stop", "n", "status", "is_isolated", "score", "z", "message").collect())) for d in (detector, again)]
    assert answers[0] == answers[1] and len(answers[0]) == asked.count()

    profiled = profiles.stop_profile(catalog._supplier_daily(spark, folder)).persist()
    scale = profiles.scale_of(profiled)
    scaled = profiles.standardize(profiled, scale)
    centres = best_centres(scaled, profiles.SCALED, [3], 2, 1)[3]
    named = centres.transform(scaled).withColumn("profile", F.lit("some name"))
    kept = artefacts.Segmentation(scale, centres, named)
    kept.save(str(tmp_path / "segments"))
    again = artefacts.Segmentation.load(spark, str(tmp_path / "segments"))
    fresh = profiles.stop_profile(daily)
    asked = fresh.select("stop").unionByName(profiled.select("stop"))
    answers = [sorted(map(repr, s.assign(asked, fresh).collect())) for s in (kept, again)]
    assert answers[0] == answers[1] and len(answers[0]) == asked.count()
