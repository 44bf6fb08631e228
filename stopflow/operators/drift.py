"""Drift between a reference and a current snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, Settings
from stopflow.functions.quantiles import running_totals, with_slices


def _sides(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, side, value): rows with any gap dropped, both snapshots stacked."""
    def long(df: DataFrame, side: str) -> DataFrame:
        whole = df.select(*features).dropna().select(*[F.col(c).cast("double").alias(c) for c in features])
        return whole.unpivot([], features, "feature", "value").withColumn("side", F.lit(side))

    return long(reference, "reference").unionByName(long(current, "current"))


def drift_distances(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: sizes, Wasserstein distance in reference deviations, Kolmogorov-Smirnov
    statistic, Jensen-Shannon distance.

    Equal values are counted together before the shuffle. Cumulative counts are
    taken slice by slice along the value axis, so a feature with very many
    distinct values is never ordered in one task.
    """
    def is_side(side: str):
        return F.when(F.col("side") == side, 1).otherwise(0)

    stacked = _sides(reference, current, features)
    counts = stacked.groupBy("feature", "value").agg(
        F.sum(is_side("reference")).alias("ref"), F.sum(is_side("current")).alias("cur")
    )
    ranked = running_totals(with_slices(counts), ["feature"], "value", ["ref", "cur"])
    upto = lambda s: (F.col(f"{s}_before") + F.col(s)) / F.col(f"{s}_total")
    p, q = F.col("ref") / F.col("ref_total"), F.col("cur") / F.col("cur_total")
    m = (p + q) / 2
    part = lambda a: F.when(a > 0, a * F.ln(a / m)).otherwise(0.0)
    gap = F.abs(upto("ref") - upto("cur"))
    x, weight = F.col("value"), F.col("ref") / F.col("ref_total")
    sums = ranked.withColumns({"gap": gap, "js": (part(p) + part(q)) / 2, "wx": weight * x}).groupBy("feature").agg(
        F.max("ref_total").alias("reference_rows"),
        F.max("cur_total").alias("current_rows"),
        F.sum(F.col("gap") * (F.coalesce("next_value", "value") - F.col("value"))).alias("move"),
        F.max("gap").alias("ks"),
        F.sqrt(F.greatest(F.sum("js"), F.lit(0.0))).alias("js"),
    )
    spread = stacked.where(F.col("side") == "reference").groupBy("feature").agg(F.stddev_pop("value").alias("spread"))
    # One row per named feature on both sides.
    joined = sums.join(F.broadcast(spread), "feature")
    return joined.select(
        "feature",
        "reference_rows",
        "current_rows",
        (F.col("move") / F.greatest("spread", F.lit(0.001))).alias("wasserstein"),
        "ks",
        "js",
    )


def ks_p_value(distance, a, b):
    """Asymptotic two-sample p-value."""
    size = F.sqrt(a * b / (a + b))
    lam = (size + 0.12 + 0.11 / size) * distance
    term = lambda k: F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda s, k: s + term(k))
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.least(2 * series, F.lit(1.0)), F.lit(0.0)))


def drifted_features(distances: DataFrame, categorical: list[str], test: str = "wasserstein", settings: Settings = DEFAULTS) -> DataFrame:
    """Whether each feature drifted: categorical ones by Jensen-Shannon distance, the others by `test`.

    `test` is "wasserstein" or "kolmogorov-smirnov", whatever the number of rows.
    """
    if test not in ("wasserstein", "kolmogorov-smirnov"):
        raise ValueError(f"unknown test {test!r}")
    by_distance = (F.col("feature").isin(categorical) if categorical else F.lit(False)) | F.lit(test == "wasserstein")
    name = F.when(F.col("feature").isin(categorical), F.lit("jensen-shannon")).otherwise(F.lit(test)) if categorical else F.lit(test)
    measures = {
        "jensen-shannon": F.col("js"),
        "wasserstein": F.col("wasserstein"),
        "kolmogorov-smirnov": ks_p_value(F.col("ks"), F.col("reference_rows").cast("double"), F.col("current_rows").cast("double")),
    }
    score = F.coalesce(*[F.when(name == key, value) for key, value in measures.items()])
    drifted = F.when(by_distance, score > settings.drift_distance).otherwise(score < settings.drift_p_value)
    return distances.select("feature", name.alias("test"), score.alias("score"), drifted.alias("drifted"))


def drift_report(
    name: str,
    reference: DataFrame | None,
    current: DataFrame | None,
    features: list[str],
    test: str = "wasserstein",
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One verdict row: DRIFT when more than the tolerated share of features drifted."""
    present = reference if reference is not None else current
    spark = present.sparkSession
    schema = "model string, status string, drifted bigint, features bigint, share double"
    if reference is None:
        return spark.createDataFrame([(name, "REFERENCE MISSING", None, None, None)], schema)
    if current is None:
        return spark.createDataFrame([(name, "CURRENT DATA MISSING", None, None, None)], schema)
    shared = [c for c in features if c in reference.columns and c in current.columns]
    categorical = [c for c, kind in reference.dtypes if kind == "boolean"]
    verdicts = drifted_features(drift_distances(reference, current, shared), categorical, test, settings)
    share = F.col("drifted") / F.col("features")
    return verdicts.agg(F.count_if("drifted").alias("drifted"), F.count("*").alias("features")).select(
        F.lit(name).alias("model"),
        F.when(share > settings.drift_share, F.lit("DRIFT")).otherwise(F.lit("OK")).alias("status"),
        "drifted",
        "features",
        share.alias("share"),
    )


def drift_reports(
    sets: dict[str, tuple[DataFrame | None, DataFrame | None, list[str], str]], settings: Settings = DEFAULTS
) -> DataFrame:
    """One verdict per (reference, current, features, test)."""
    parts = [drift_report(name, *given, settings) for name, given in sets.items()]
    return reduce(DataFrame.unionByName, parts)
