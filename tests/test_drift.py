import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.functions import quantiles
from stopflow.operators import drift


def frame(spark, shift=0.0, rows=1500, seed=0):
    rng = np.random.default_rng(seed)
    data = [(float(a + shift), float(round(b, 1)), bool(c < 0.3)) for a, b, c in zip(rng.normal(0, 1, rows), rng.gamma(2, 2, rows), rng.uniform(size=rows))]
    return spark.createDataFrame(data, "a double, b double, flag boolean")


@pytest.fixture(params=[1_000_000, 100])
def slices(request, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_SLICE", request.param)


def test_distances_equal_a_plain_computation(spark, slices):
    old, new = frame(spark), frame(spark, 0.4, 1200, 1)
    got = {r["feature"]: r for r in drift.drift_distances(old, new, ["a", "b", "flag"]).collect()}
    for name in ("a", "b"):
        x, y = (np.sort(df.select(name).toPandas()[name].to_numpy(float)) for df in (old, new))
        points = np.unique(np.concatenate([x, y]))
        gap = np.abs(np.searchsorted(x, points, "right") / len(x) - np.searchsorted(y, points, "right") / len(y))
        assert got[name]["ks"] == pytest.approx(gap.max())
        assert got[name]["wasserstein"] == pytest.approx((gap[:-1] * np.diff(points)).sum() / x.std())
    p, q = (df.agg(F.avg(F.col("flag").cast("double"))).first()[0] for df in (old, new))
    a, b = np.array([p, 1 - p]), np.array([q, 1 - q])
    m = (a + b) / 2
    assert got["flag"]["js"] == pytest.approx(np.sqrt(((a * np.log(a / m)).sum() + (b * np.log(b / m)).sum()) / 2))


def test_identical_snapshots_do_not_drift(spark):
    row = drift.drift_report("same", frame(spark), frame(spark), ["a", "b", "flag", "absent"]).first()
    assert (row["status"], row["drifted"], row["features"]) == ("OK", 0, 3)


def test_shifted_snapshot_drifts(spark):
    row = drift.drift_report("shift", frame(spark), frame(spark, 2.0), ["a"]).first()
    assert row["status"] == "DRIFT" and row["share"] == 1.0


@pytest.mark.parametrize("rows", [300, 3000])
@pytest.mark.parametrize("test", ["wasserstein", "kolmogorov-smirnov"])
def test_the_named_test_is_used_at_every_size(spark, rows, test):
    old, new = frame(spark, rows=rows), frame(spark, 1.0, rows, 6)
    for other, drifted in ((old, False), (new, True)):
        found = drift.drifted_features(drift.drift_distances(old, other, ["a", "flag"]), ["flag"], test).collect()
        got = {r["feature"]: r for r in found}
        assert got["a"]["test"] == test and got["a"]["drifted"] == drifted
        assert got["flag"]["test"] == "jensen-shannon" and not got["flag"]["drifted"]


def test_unknown_test_is_refused(spark):
    with pytest.raises(ValueError):
        drift.drifted_features(drift.drift_distances(frame(spark), frame(spark), ["a"]), [], "guess")


def test_missing_snapshots_are_reported(spark):
    assert drift.drift_report("x", None, frame(spark), ["a"]).first()["status"] == "REFERENCE MISSING"
    assert drift.drift_report("x", frame(spark), None, ["a"]).first()["status"] == "CURRENT DATA MISSING"


def test_rows_with_gaps_are_left_out(spark):
    holed = frame(spark).withColumn("a", F.when(F.col("b") > 1, F.col("a")))
    got = drift.drift_distances(holed, frame(spark), ["a", "b"]).collect()
    assert {r["reference_rows"] for r in got} == {holed.where("b > 1").count()}
