"""Short-term traffic models."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, FEATURES, Settings
from stopflow.functions.gram import gram
from stopflow.functions.numeric import half_even
from stopflow.functions.quantiles import exact_quantiles
from stopflow.operators.histogram_trees import BinnedTable, Boosting, Forest, TreeModel
from stopflow.operators.lookups import rounded_prediction
from stopflow.operators.trees import Ensemble, mean_absolute_shapley, shapley_values, squared_errors, tree_spread

TARGET = "n"


def split_day(features: DataFrame, share: float = DEFAULTS.train_share) -> date:
    """First test day: position int(share x days) among the sorted distinct days."""
    days = features.select("day").distinct()
    ranked = days.select(
        "day", F.row_number().over(Window.orderBy("day")).alias("position"), F.count("*").over(Window.partitionBy()).alias("days")
    )
    return ranked.where(F.col("position") == F.floor(F.col("days") * share) + 1).first()["day"]


def temporal_split(features: DataFrame, share: float = DEFAULTS.train_share) -> tuple[DataFrame, DataFrame, date]:
    """Train before the split day, test from it on; the day is a literal, so it reaches the scan."""
    cut = split_day(features, share)
    day = F.lit(cut)
    return features.where(F.col("day") < day), features.where(F.col("day") >= day), cut


def feature_medians(train: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Exact median of every feature: (feature, median)."""
    numeric = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot([], columns, "feature", "value")
    return exact_quantiles(long, "value", [0.5], ["feature"]).select("feature", F.col("value").alias("median"))


def impute(train: DataFrame, test: DataFrame, columns: list[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """Fill gaps of both sides with the training medians, computed only for features with gaps."""
    both = train.unionByName(test)
    gaps = both.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    holed = [c for c in columns if gaps[c]]
    numeric = lambda df: df.withColumns({c: F.col(c).cast("double") for c in columns})
    if not holed:
        return numeric(train), numeric(test)
    medians = {r["feature"]: r["median"] for r in feature_medians(train, holed).collect()}
    known = {c: v for c, v in medians.items() if v is not None}
    return numeric(train).fillna(known), numeric(test).fillna(known)


@dataclass(frozen=True)
class Linear:
    """Least squares from sums of products; the fit itself has as many numbers as features."""

    def fit(self, train: DataFrame, columns: list[str]) -> LinearModel:
        coefficients, intercept = gram(train, [*columns, TARGET]).least_squares(TARGET)
        return LinearModel(columns, coefficients.tolist(), intercept)


@dataclass(frozen=True)
class LinearModel:
    features: list[str]
    coefficients: list[float]
    intercept: float

    def transform(self, rows: DataFrame) -> DataFrame:
        terms = (F.col(c).cast("double") * F.lit(v) for c, v in zip(self.features, self.coefficients, strict=True))
        return rows.withColumn("prediction", sum(terms, F.lit(self.intercept)))


def estimators(settings: Settings = DEFAULTS, forest_trees: int = 100, forest_depth: int = 15, rounds: int = 300) -> dict:
    """The four candidate models. Sizes are parameters; the defaults are the published ones."""
    common = {"featuresCol": "vector", "labelCol": TARGET}
    return {
        "linear": Linear(),
        "tree": DecisionTreeRegressor(maxDepth=10, minInstancesPerNode=5, maxBins=128, seed=settings.seed, maxMemoryInMB=1024, **common),
        "forest": Forest(trees=forest_trees, depth=forest_depth, least=3, seed=settings.seed),
        "boosted": Boosting(rounds=rounds, depth=6, rate=0.05, row_share=0.8, column_share=0.8, seed=settings.seed),
    }


def fit_model(train: DataFrame, estimator, columns: list[str] = FEATURES, table: BinnedTable | None = None) -> PipelineModel | TreeModel | LinearModel:
    """Fit one model. Ensembles use the binned table, made for this fit if none is given;
    Spark's own estimators are put after an assembler, in one pipeline that can be saved and reloaded as a unit."""
    if isinstance(estimator, (Forest, Boosting)):
        own = table or BinnedTable(train, columns, TARGET)
        try:
            return estimator.fit(own)
        finally:
            if table is None:
                own.release()
    if isinstance(estimator, Linear):
        return estimator.fit(train, columns)
    assembler = VectorAssembler(inputCols=columns, outputCol="vector")
    return Pipeline(stages=[assembler, estimator]).fit(train)


def fit_models(train: DataFrame, models: dict, columns: list[str] = FEATURES) -> dict[str, PipelineModel | TreeModel]:
    """Fit several models side by side, ensembles from one binned table."""
    table = BinnedTable(train, columns, TARGET) if any(isinstance(e, (Forest, Boosting)) for e in models.values()) else None
    fit = inheritable_thread_target(lambda estimator: fit_model(train, estimator, columns, table))
    with ThreadPoolExecutor(max(1, len(models))) as pool:
        fitted = dict(zip(models, pool.map(fit, models.values()), strict=True))
    if table is not None:
        table.release()
    return fitted


def regression_metrics(predicted: DataFrame, label: str = TARGET) -> DataFrame:
    """RMSE, MAE and R² in one pass."""
    error = F.col(label) - F.col("prediction")
    return predicted.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(label) * F.count("*"))).alias("r2"),
    )


def fit_status(r2_train, r2_test, settings: Settings = DEFAULTS):
    gap = r2_train - r2_test
    return (
        F.when(gap > settings.overfit_gap, F.lit("OVERFITTING"))
        .when(r2_test < settings.underfit_r2, F.lit("UNDERFITTING"))
        .otherwise(F.lit("OK"))
    )


def compare_models(train: DataFrame, test: DataFrame, models: dict, settings: Settings = DEFAULTS, minimum_r2: float | None = None):
    """Fit every candidate; one row of metrics each, the best sound one marked.

    Returns (table, fitted models). `minimum_r2` adds the documented but unused
    floor on the test score.
    """
    fitted = fit_models(train, models)
    return compare_fitted(train, test, fitted, settings, minimum_r2), fitted


def compare_fitted(train: DataFrame, test: DataFrame, fitted: dict, settings: Settings = DEFAULTS, minimum_r2: float | None = None) -> DataFrame:
    rows = []
    for name, model in fitted.items():
        a = regression_metrics(model.transform(train)).first()
        b = regression_metrics(model.transform(test)).first()
        rows.append((name, a["rmse"], a["mae"], a["r2"], b["rmse"], b["mae"], b["r2"]))
    schema = "model string, rmse_train double, mae_train double, r2_train double, rmse_test double, mae_test double, r2_test double"
    table = train.sparkSession.createDataFrame(rows, schema).withColumns(
        {
            "r2_gap": F.col("r2_train") - F.col("r2_test"),
            "status": fit_status(F.col("r2_train"), F.col("r2_test"), settings),
        }
    )
    sound = F.col("status") == "OK"
    if minimum_r2 is not None:
        sound = sound & (F.col("r2_test") >= minimum_r2)
    best = F.max_by("model", F.when(sound, F.col("r2_test"))).over(Window.partitionBy())
    any_sound = F.max(F.when(sound, F.lit(1))).over(Window.partitionBy())
    return table.withColumn("selected", F.coalesce((F.col("model") == best) & (any_sound == 1), F.lit(False)))


def linear_coefficients(model: LinearModel) -> DataFrame:
    from pyspark.sql import SparkSession

    rows = [*zip(model.features, model.coefficients, strict=True), ("intercept", model.intercept)]
    return SparkSession.active().createDataFrame(rows, "feature string, coefficient double")


def predict(model: PipelineModel | TreeModel, rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Whole non-negative prediction and its confidence.

    For a forest the confidence falls with the spread of the single trees; other
    models have a fixed one.
    """
    complete = rows.withColumns({c: F.col(c).cast("double") for c in columns})
    out = model.transform(complete).withColumn("predicted", rounded_prediction(F.col("prediction")))
    if not isinstance(model, TreeModel) or not model.averaged:
        return out.withColumn("confidence", F.lit(0.85)).drop("vector")
    spread = tree_spread(out, model.ensemble, columns)
    confidence = half_even(1 / (1 + F.col("trees_std") / (F.col("predicted") + 1)), 4)
    return spread.withColumn("confidence", confidence).drop("trees_mean", "trees_std")


def impurity_importance(models: dict[str, PipelineModel | TreeModel], columns: list[str] = FEATURES) -> DataFrame:
    """Share of the fall in squared error by feature; models without trees have none."""
    from pyspark.sql import SparkSession

    rows = []
    for name, model in models.items():
        if isinstance(model, TreeModel):
            rows += [(name, c, v) for c, v in model.importances().items()]
        elif isinstance(model, PipelineModel) and hasattr(model.stages[-1], "featureImportances"):
            rows += [(name, c, float(v)) for c, v in zip(columns, model.stages[-1].featureImportances.toArray(), strict=True)]
    return SparkSession.active().createDataFrame(rows, "model string, feature string, importance double")


def shapley_importance(rows: DataFrame, nodes: DataFrame | Ensemble, columns: list[str] = FEATURES) -> DataFrame:
    """Mean absolute contribution of each feature over all given rows."""
    names = F.array(*[F.lit(c) for c in columns])
    return mean_absolute_shapley(rows, nodes, columns).select(F.explode(F.arrays_zip(names.alias("feature"), F.col("shapley").alias("importance"))).alias("f")).select("f.*")


def top_factors(rows: DataFrame, nodes: DataFrame | Ensemble, k: int = 3, columns: list[str] = FEATURES) -> DataFrame:
    """The k strongest contributions of each row, strongest first, with their direction.

    Twelve contributions are sorted inside the row; nothing is shuffled.
    """
    names = F.array(*[F.lit(c) for c in columns])
    pairs = F.zip_with(names, "shapley", lambda c, v: F.struct(F.abs(v).alias("size"), v.alias("value"), c.alias("feature")))
    ranked = F.slice(F.sort_array(pairs, asc=False), 1, k)
    long = shapley_values(rows, nodes, columns).select("stop", "day", F.posexplode(ranked).alias("rank", "f"))
    direction = F.when(F.col("f.value") > 0, F.lit("raises")).otherwise(F.lit("lowers"))
    return long.select(
        "stop",
        "day",
        (F.col("rank") + 1).alias("rank"),
        F.col("f.feature").alias("feature"),
        F.col("f.value").alias("contribution"),
        direction.alias("direction"),
    )


def paired_with_donors(rows: DataFrame, columns: list[str], bucket_rows: int = 1000) -> DataFrame:
    """Each row with another row's values as `<column>_other`.

    Rows of all stops and days are spread by a hash over buckets of about
    `bucket_rows`; inside a bucket two further hashes give a row's position and
    its donor's, so every row gives its values once and no order is global.
    """
    buckets = rows.count() // bucket_rows + 1
    keyed = rows.withColumn("_bucket", F.pmod(F.xxhash64("stop", "day"), F.lit(buckets)))
    placed = lambda salt: F.row_number().over(Window.partitionBy("_bucket").orderBy(F.xxhash64(F.lit(salt), "stop", "day"), "stop", "day"))
    base = keyed.withColumn("_position", placed("receives"))
    donor = keyed.withColumn("_position", placed("gives")).select("_bucket", "_position", *[F.col(c).alias(f"{c}_other") for c in columns])
    return base.join(donor, ["_bucket", "_position"]).drop("_bucket", "_position")


def permutation_importance(model: PipelineModel | TreeModel, rows: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Rise of the RMSE when one feature is replaced by another row's value."""
    paired = paired_with_donors(rows, columns).persist()
    before = regression_metrics(model.transform(paired)).first()["rmse"]
    out = []
    for c in columns:
        swapped = paired.withColumn(c, F.col(f"{c}_other"))
        out.append((c, float(regression_metrics(model.transform(swapped)).first()["rmse"] - before)))
    paired.unpersist()
    return rows.sparkSession.createDataFrame(out, "feature string, rmse_rise double")


def learning_curve(model: TreeModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """RMSE on both sides after every boosting round, each side in one pass."""
    sides = [
        squared_errors(df, model.ensemble, model.features, TARGET, model.base).select("round", F.sqrt(F.col("squares") / F.col("rows")).alias(f"rmse_{name}"))
        for name, df in (("train", train), ("test", test))
    ]
    return sides[0].join(sides[1], "round")


def residuals(predicted: DataFrame) -> DataFrame:
    return predicted.select("stop", "day", TARGET, "prediction", (F.col(TARGET) - F.col("prediction")).alias("residual"))


def evaluator(metric: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName=metric)
