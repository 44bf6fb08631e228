import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.functions import quantiles


@pytest.fixture(params=[1_000_000, 40])
def slices(request, monkeypatch):
    """Once in a single slice, once cut into many."""
    monkeypatch.setattr(quantiles, "ROWS_PER_SLICE", request.param)


def skewed(spark):
    """A third of the rows share one value."""
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.pow(F.col("id") % 997, 1.5)).alias("x"))


def test_quantiles_equal_numpy(spark, slices):
    df = skewed(spark)
    values = np.array([r["x"] for r in df.collect()])
    shares = [0.0, 0.02, 0.25, 0.333, 0.5, 0.98, 1.0]
    got = {r["share"]: r["value"] for r in quantiles.exact_quantiles(df, "x", shares).collect()}
    for share in shares:
        assert got[share] == pytest.approx(np.quantile(values, share)), share


def test_grouped_quantiles(spark, slices):
    df = skewed(spark).withColumn("g", F.when(F.col("x") > 100, "a").otherwise("b"))
    pdf = df.toPandas()
    got = {r["g"]: r["value"] for r in quantiles.exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["x"].median().to_dict())


def test_running_totals_cross_slices(spark, slices):
    counts = spark.range(1, 501).select(F.col("id").cast("double").alias("value"), F.col("id").alias("rows"))
    got = quantiles.running_totals(quantiles.with_slices(counts), [], "value", ["rows"]).orderBy("value").collect()
    before = 0
    for i, row in enumerate(got, 1):
        assert row["rows_before"] == before and row["rows_total"] == 500 * 501 // 2
        assert row["next_value"] == (i + 1 if i < 500 else None)
        before += i


def test_empty_column(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None
