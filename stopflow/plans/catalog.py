"""Every query by name: (spark, folder of the test tables) -> DataFrame.

Doubles are rounded here, and only here, so that results can be compared exactly
with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, DRIFT_SETS, DRIFT_TESTS, PROFILE_MEASURES
from stopflow.functions import text
from stopflow.operators import (
    anomaly,
    cleaning,
    density,
    drift,
    exploration,
    features,
    forecast,
    lookups,
    profiles,
    regression,
)
from stopflow.operators.histogram_trees import TreeModel
from stopflow.operators.centres import Centres
from stopflow.plans import artefacts, pipelines
from stopflow.session import materialize, scratch_path, spread
from stopflow.sources import benchmark_tables as tables
from stopflow.sources import readers, sinks
from stopflow.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STOP, FIRST, LAST = "NATION_3", "1997-07-01", "1997-09-30"
SNAPSHOT = "1999-01-01"
# The test series average tens of counts a day, not thousands.
TEST_SETTINGS = replace(DEFAULTS, forecast_min_mean=25.0)
FIRST_ORDER = ["seq", "carrier", "network", "stop_code", "zone_id", "n"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double column."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c), special.get(c, digits)) for c in doubles})


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    return readers.calendar_days(tables.calendar(spark, folder))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return features.stop_day(tables.validations(spark, folder))


def _supplier_daily(spark: SparkSession, folder: str) -> DataFrame:
    return features.stop_day(tables.supplier_validations(spark, folder))


def _supplier_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier counts by day without codes: profiles look at nothing else, and codes would have to be grouped by."""
    return features.daily_counts(features.counted_rows(tables.supplier_validations(spark, folder)))


def _features(spark: SparkSession, folder: str, leak_free: bool = False) -> DataFrame:
    return features.build_features(tables.validations(spark, folder), _calendar(spark, folder), leak_free=leak_free)


def _stored_features(spark: SparkSession, folder: str, leak_free: bool = False) -> DataFrame:
    """Features through a file, as between preparation and training."""
    return materialize(_features(spark, folder, leak_free), "features")


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    return features.carrier_codes(cleaning.filter_defined(tables.validations(spark, folder)))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return tables.requests(spark, folder).withColumn("stop", text.stop_name(F.col("stop")))


def _labelled_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier profiles labelled by region, a known five-way segmentation."""
    daily = _supplier_daily(spark, folder)
    labels = daily.groupBy("stop").agg(F.min("carrier").cast("int").alias("cluster"))
    return profiles.stop_profile(daily).join(labels, "stop").persist()


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    stored = materialize(profiles.stop_profile(_supplier_counts(spark, folder)), "profiles")
    return profiles.with_vector(profiles.standardize(stored)).persist()


def _holidays(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.holiday_frame(tables.calendar(spark, folder))


def _totals(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("n").alias("n"))


# -- sources and sinks ---------------------------------------------------------


@query
def scan_raw_csv(spark, folder):
    path = scratch_path(spark, "raw")
    headers = {b: a for a, b in readers.RAW_HEADER.items()}
    raw = tables.submissions(spark, folder).drop("seq").withColumnsRenamed(headers)
    sinks.write_raw(raw, path)
    return cleaning.clean_rows(readers.read_raw_file(spark, path))


@query
def scan_quarters_by_name(spark, folder):
    paths = tables.write_quarter_files(spark, folder, scratch_path(spark, "quarters"))
    return cleaning.clean_rows(readers.read_raw_files(spark, paths))


@query
def scan_table(spark, folder):
    return tables.validations(spark, folder)


@query
def scan_features(spark, folder):
    path = scratch_path(spark, "features")
    sinks.write_features(_features(spark, folder), path)
    return tidy(readers.read_features(spark, path), std7=4).select(*features.COLUMNS)


@query
def scan_calendar(spark, folder):
    path = scratch_path(spark, "calendar")
    rows = tables.calendar(spark, folder).select(F.col("day").alias("date"), "type", F.lit("").alias("description"))
    rows.write.csv(path, header=True)
    return readers.calendar_days(readers.read_calendar(spark, path))


@query
def write_features(spark, folder):
    path = scratch_path(spark, "features")
    sinks.write_features(_features(spark, folder), path)
    return _totals(spark.read.parquet(path), "year", "month")


@query
def append_batches(spark, folder):
    path = scratch_path(spark, "table")
    rows = materialize(tables.validations(spark, folder), "batches")
    lot = F.pmod(F.xxhash64(*rows.columns), F.lit(5))
    for number in range(5):
        sinks.append_rows(rows.where(lot == number), path)
    return _totals(readers.read_table(spark, path), "carrier")


@query
def truncate_reload(spark, folder):
    root = scratch_path(spark, "table")
    rows = tables.validations(spark, folder)
    sinks.reload_table(rows, root)
    current = sinks.reload_table(cleaning.filter_defined(rows), root)
    return _totals(readers.read_table(spark, current), "category")


@query
def append_validated(spark, folder):
    return cleaning.accepted(cleaning.submitted_rows(tables.submissions(spark, folder)))


@query
def verify_load(spark, folder):
    expected = tables.table(spark, folder, "lineitem").count()
    return cleaning.verify_load(tables.validations(spark, folder), expected)


@query
def latest_rows(spark, folder):
    return cleaning.latest_rows(tables.sequenced_validations(spark, folder))


@query
def model_store(spark, folder):
    """A saved and reloaded pipeline predicts the same, with its inputs and codes beside it."""
    train, test, _ = regression.temporal_split(_stored_features(spark, folder))
    train, test = regression.impute(train, test)
    models = regression.estimators()
    model = regression.fit_model(train, models["tree"])
    path = scratch_path(spark, "model")
    pipelines.save_model(model, _codes(spark, folder), path)
    stored, codes = pipelines.load_model(spark, path)
    before = model.transform(test).select("stop", "day", F.col("prediction").alias("before"))
    after = stored.transform(test).select("stop", "day", "carrier", "prediction")
    return tidy(after.join(before, ["stop", "day"]).join(F.broadcast(codes), "carrier").groupBy("carrier", "carrier_index").agg(
        F.count("*").alias("rows"), F.max(F.abs(F.col("prediction") - F.col("before"))).alias("largest_difference")
    ))


@query
def run_metrics_table(spark, folder):
    """Runs of the naive model that repeats the count of seven rows earlier."""
    path = scratch_path(spark, "runs")
    train, test, cut = regression.temporal_split(_stored_features(spark, folder))
    for side, rows in (("train", train), ("test", test)):
        values = regression.regression_metrics(rows.withColumn("prediction", F.col("lag7"))).first().asDict()
        params = {"features": 1, "split_day": cut, "side": side}
        sinks.append_run(sinks.run_metrics(spark, f"naive-{side}", "naive", params, values), path)
    metric = F.when(F.col("kind") == "metric", F.col("value").try_cast("double"))
    param = F.when(F.col("kind") == "param", F.col("value"))
    return tidy(spark.read.parquet(path).select("run", "model", "kind", "name", metric.alias("metric"), param.alias("param")))


@query
def training_runs(spark, folder):
    """The runs that all trainings leave: four models, two segmentations, the forest."""
    path = scratch_path(spark, "runs")
    pipelines.record_comparison(regression.compare_fitted(*_sides(spark, folder), _models(spark, folder, *regression.estimators())), path, {"share": DEFAULTS.train_share})
    vectors = _vectors(spark, folder)
    pipelines.segment_stops(vectors, runs=path).count()
    pipelines.isolation_labels(_features(spark, folder), runs=path)
    return tidy(spark.read.parquet(path).select("run", "model", "kind", "name", F.col("value").try_cast("double").alias("number"), "value"))


@query
def dataset_inventory(spark, folder):
    daily = _daily(spark, folder)
    cut = F.lit(SNAPSHOT).cast("date")
    return cleaning.dataset_inventory({"reference": daily.where(F.col("day") < cut), "current": daily.where(F.col("day") >= cut)})


# -- projections and cleaning ----------------------------------------------------


def _changes(df: DataFrame, column: str, change, label: str | None = None) -> DataFrame:
    """Distinct texts of a column with what they become and how many rows have them."""
    label = label or column
    counted = df.groupBy(F.col(column).alias(f"{label}_text")).agg(F.count("*").alias("rows"))
    return counted.withColumn(label, change(F.col(f"{label}_text")))


@query
def parse_day(spark, folder):
    return _changes(tables.submissions(spark, folder), "day", cleaning.parse_day)


@query
def coerce_counts(spark, folder):
    return _changes(tables.submissions(spark, folder), "n", text.count_or_zero)


@query
def strip_text(spark, folder):
    return _changes(tables.submissions(spark, folder), "stop", text.strip)


@query
def normalize_code(spark, folder):
    kinds = ["carrier", "network", "stop_code"]
    long = tables.submissions(spark, folder).select(*kinds).unpivot([], kinds, "kind", "text")
    counted = long.groupBy("kind", "text").agg(F.count("*").alias("rows"))
    return counted.withColumn("code", text.code(F.col("text")))


@query
def relabel_category(spark, folder):
    return _changes(tables.submissions(spark, folder), "category", lambda c: cleaning.fix_category(text.strip(c)))


@query
def project_columns(spark, folder):
    return cleaning.project(tables.sequenced_validations(spark, folder))


@query
def flag_defined(spark, folder):
    return cleaning.flag_defined(tables.validations(spark, folder))


@query
def filter_defined(spark, folder):
    return cleaning.filter_defined(tables.validations(spark, folder))


@query
def filter_stop_period(spark, folder):
    return cleaning.stop_period(tables.validations(spark, folder), STOP, FIRST, LAST)


@query
def normalize_stop_name(spark, folder):
    return _changes(tables.submissions(spark, folder), "stop", text.stop_name)


@query
def filter_zscore(spark, folder):
    beyond = anomaly.zscore_anomalies(features.zscores(_daily(spark, folder)))
    return tidy(beyond.select("stop", "day", "n", "z", "side"))


@query
def detector_agreement(spark, folder):
    labelled, _ = pipelines.isolation_labels(_features(spark, folder))
    return anomaly.detector_agreement(labelled)


@query
def validate_rows(spark, folder):
    return cleaning.request_reasons(_requests(spark, folder)).select("request_id", "reason")


@query
def incomplete_stops(spark, folder):
    # Test suppliers are active about 540 days.
    return exploration.incomplete_stops(tables.supplier_validations(spark, folder), 540)


@query
def date_position(spark, folder):
    known = tables.validations(spark, folder).agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    dated = _requests(spark, folder).select("request_id", "stop", "day")
    return exploration.date_position(dated, known["a"], known["b"])


@query
def classify_day_type(spark, folder):
    calendar = _calendar(spark, folder)
    ends = calendar.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    return features.day_types(calendar, ends[0], ends[1])


# -- joins -------------------------------------------------------------------------


@query
def congestion_top20(spark, folder):
    return exploration.congestion_top20(tables.validations(spark, folder))


@query
def calendar_flags(spark, folder):
    daily = _daily(spark, folder).select("stop", "day")
    return features.add_calendar_flags(daily, _calendar(spark, folder)).select("stop", "day", "is_holiday", "is_vacation")


@query
def semi_top_stops(spark, folder):
    return exploration.semi_top_stops(tables.supplier_validations(spark, folder))


@query
def rate_by_aligned_division(spark, folder):
    return exploration.undefined_rate_aligned(tables.validations(spark, folder))


@query
def map_labels(spark, folder):
    labelled = _labelled_profiles(spark, folder)
    return profiles.map_labels(labelled, profiles.name_five(labelled)).select("stop", "cluster", "profile")


@query
def calendar_lag_lookup(spark, folder):
    pairs = lookups.distinct_pairs(_requests(spark, folder))
    return tidy(lookups.calendar_lags(pairs, _daily(spark, folder)))


@query
def short_term_answers(spark, folder):
    """Every request keeps its row: both lookups, or why there are none."""
    wanted = _requests(spark, folder).select("request_id", "stop", "day")
    pairs = lookups.distinct_pairs(wanted)
    daily = materialize(_daily(spark, folder), "daily")
    found = lookups.calendar_lags(pairs, daily).join(lookups.asof_last7(pairs, daily), ["stop", "day"])
    return tidy(lookups.with_status(lookups.answer(wanted, found), "lag1"), std7=4)


@query
def asof_last7(spark, folder):
    pairs = lookups.distinct_pairs(_requests(spark, folder))
    return tidy(lookups.asof_last7(pairs, _daily(spark, folder)), std7=4)


@query
def similar_stops(spark, folder):
    return profiles.similar_stops(_labelled_profiles(spark, folder))


@query
def score_against_history(spark, folder):
    observed = _requests(spark, folder).select("request_id", "stop", "n")
    scored = lookups.score_against_history(observed, exploration.stop_moments(_daily(spark, folder)).drop("min"))
    return tidy(scored.select("request_id", "stop", "n", "status", "mean", "z", "norm"))


# -- aggregations --------------------------------------------------------------------


@query
def top10_stops(spark, folder):
    return exploration.top10_stops(tables.validations(spark, folder))


@query
def weekday_mean(spark, folder):
    return exploration.weekday_mean(tables.validations(spark, folder))


@query
def stop_day(spark, folder):
    return _daily(spark, folder)


@query
def pivot_category(spark, folder):
    return features.pivot_category(tables.validations(spark, folder))


@query
def undefined_rate(spark, folder):
    return exploration.undefined_rate(tables.validations(spark, folder))


@query
def daily_totals(spark, folder):
    return exploration.daily_totals(tables.validations(spark, folder))


@query
def max_daily_total(spark, folder):
    return exploration.max_daily_total(tables.validations(spark, folder), STOP)


@query
def scalar_checks(spark, folder):
    return exploration.scalar_checks(tables.validations(spark, folder), STOP, "1998-07-14")


@query
def category_share(spark, folder):
    return exploration.category_share(tables.validations(spark, folder))


@query
def category_share_month(spark, folder):
    return exploration.category_share_month(tables.validations(spark, folder))


@query
def monthly_stats(spark, folder):
    return tidy(exploration.monthly_stats(tables.validations(spark, folder)))


@query
def week_weekend_ratio(spark, folder):
    return tidy(exploration.week_weekend_ratio(tables.validations(spark, folder)))


@query
def category_by_day(spark, folder):
    return exploration.category_by_day(tables.validations(spark, folder))


@query
def stop_weekday_heatmap(spark, folder):
    return tidy(exploration.stop_weekday_heatmap(tables.supplier_validations(spark, folder)))


@query
def describe_counts(spark, folder):
    return tidy(exploration.describe_column(tables.validations(spark, folder), "n"))


@query
def null_profile(spark, folder):
    return cleaning.null_profile(tables.submissions(spark, folder))


@query
def duplicate_rows(spark, folder):
    return cleaning.duplicate_rows(tables.validations(spark, folder))


@query
def active_days(spark, folder):
    return tidy(exploration.describe_column(exploration.active_days(tables.supplier_validations(spark, folder)), "active_days"))


@query
def defined_split(spark, folder):
    return exploration.defined_split(tables.validations(spark, folder))


@query
def flag_effect(spark, folder):
    return tidy(exploration.flag_effect(_features(spark, folder)))


@query
def lag_correlation(spark, folder):
    return tidy(exploration.lag_correlation(_features(spark, folder)), 4)


@query
def mean_congestion_top20(spark, folder):
    return tidy(exploration.mean_congestion_top20(features.add_congestion(_daily(spark, folder))))


@query
def stop_stats(spark, folder):
    return exploration.stop_stats(_daily(spark, folder))


@query
def stop_moments(spark, folder):
    return tidy(exploration.stop_moments(_daily(spark, folder)), std=4)


@query
def stop_profile(spark, folder):
    return tidy(profiles.stop_profile(_supplier_counts(spark, folder)))


@query
def cluster_summary(spark, folder):
    labelled = _labelled_profiles(spark, folder)
    return profiles.cluster_summary(profiles.map_labels(labelled, profiles.name_five(labelled)))


@query
def cluster_means_scaled(spark, folder):
    return tidy(profiles.cluster_means_scaled(_labelled_profiles(spark, folder)))


@query
def histogram(spark, folder):
    rows = tables.validations(spark, folder)
    scored = features.zscores(features.add_congestion(features.stop_day(rows))).persist()
    measures = [
        (rows, "n", 100),
        (exploration.active_days(tables.supplier_validations(spark, folder)), "active_days", 30),
        (scored, "z", 100),
        (scored, "congestion", 50),
    ]
    parts = {column: exploration.histogram(df, column, bins) for df, column, bins in measures}
    return tidy(cleaning.stack(parts).withColumnRenamed("source", "measure"))


@query
def forecast_eligibility(spark, folder):
    return forecast.forecast_eligibility(_daily(spark, folder), TEST_SETTINGS)


@query
def anomaly_summary(spark, folder):
    labelled, _ = pipelines.isolation_labels(_features(spark, folder))
    return tidy(anomaly.anomaly_summary(labelled))


@query
def anomaly_by_weekday(spark, folder):
    return anomaly.anomaly_by_weekday(anomaly.zscore_anomalies(features.zscores(_features(spark, folder))))


@query
def regression_metrics(spark, folder):
    """Measures of the naive forecast that repeats the count of seven rows earlier."""
    naive = _features(spark, folder).withColumn("prediction", F.col("lag7"))
    return tidy(regression.regression_metrics(naive))


@query
def list_stops(spark, folder):
    return exploration.list_values(tables.validations(spark, folder).select("stop", "category"), ["stop", "category"])


@query
def data_range(spark, folder):
    return exploration.data_range(_daily(spark, folder), STOP)


@query
def value_counts(spark, folder):
    table = _features(spark, folder)
    carriers = exploration.value_counts(table, ["carrier", "carrier_index"]).select(
        F.lit("carrier").alias("kind"), F.concat_ws("=", "carrier", F.col("carrier_index").cast("string")).alias("value"), "rows"
    )
    kinds = exploration.value_counts(tables.calendar(spark, folder), ["type"]).select(
        F.lit("calendar").alias("kind"), F.col("type").alias("value"), "rows"
    )
    weekends = exploration.value_counts(table, ["is_weekend"]).select(
        F.lit("weekend").alias("kind"), F.col("is_weekend").cast("string").alias("value"), "rows"
    )
    return carriers.unionByName(kinds).unionByName(weekends)


# -- windows -----------------------------------------------------------------------------


@query
def week_over_week(spark, folder):
    return features.week_over_week(tables.validations(spark, folder))


@query
def lag_features(spark, folder):
    return features.add_row_lags(_daily(spark, folder), fill=False).select("stop", "day", "n", "lag1", "lag7")


@query
def rolling_mean7(spark, folder):
    return tidy(features.add_rolling(_daily(spark, folder)).select("stop", "day", "mean7"))


@query
def rolling_std7(spark, folder):
    return tidy(features.add_rolling(_daily(spark, folder)).select("stop", "day", "std7"), 4)


@query
def fill_group_median(spark, folder):
    return features.add_row_lags(_daily(spark, folder)).select("stop", "day", "lag1", "lag7")


@query
def congestion_score(spark, folder):
    return features.add_congestion(_daily(spark, folder)).select("stop", "day", "congestion")


@query
def zscore(spark, folder):
    return tidy(features.zscores(_daily(spark, folder)).select("stop", "day", "z"))


@query
def norm_and_gap(spark, folder):
    rolled = features.add_rolling(_daily(spark, folder))
    return tidy(features.norm_and_gap(rolled).select("stop", "day", "norm", "gap"))


@query
def centered_mean7(spark, folder):
    return tidy(exploration.centered_mean7(tables.validations(spark, folder)))


@query
def encode_carrier(spark, folder):
    coded = features.encode_carrier(_daily(spark, folder), _codes(spark, folder))
    return coded.select("stop", "day", "carrier", "carrier_index")


@query
def topk_per_group(spark, folder):
    return profiles.topk_per_group(_labelled_profiles(spark, folder), "cluster", 4).select("cluster", "stop", "volume", "rank")


# -- sorts and set operations ------------------------------------------------------------


@query
def top20_stops(spark, folder):
    return exploration.top20_stops(tables.supplier_validations(spark, folder))


@query
def busiest_quietest_days(spark, folder):
    return exploration.busiest_quietest_days(tables.validations(spark, folder))


@query
def extreme_zscores(spark, folder):
    scored = features.zscores(_daily(spark, folder)).select("stop", "day", "n", "z")
    return tidy(anomaly.extreme_zscores(scored))


@query
def lowest_forest_scores(spark, folder):
    labelled, _ = pipelines.isolation_labels(_features(spark, folder))
    return tidy(anomaly.lowest_scores(labelled.select("stop", "day", "n", "z", "score")))


@query
def big_mid_small_sample(spark, folder):
    return tidy(forecast.big_mid_small(_daily(spark, folder), TEST_SETTINGS))


@query
def sort_load(spark, folder):
    return cleaning.sort_load(tables.sequenced_validations(spark, folder), FIRST_ORDER)


@query
def union_quarters(spark, folder):
    rows = tables.validations(spark, folder)
    parts = {f"T{q}": rows.where(F.quarter("day") == q) for q in range(1, 5)}
    return cleaning.stack({**parts, "undated": rows.where(F.col("day").isNull())})


@query
def dedup_keep_first(spark, folder):
    return cleaning.deduplicate(tables.sequenced_validations(spark, folder), FIRST_ORDER)


@query
def dedup_report(spark, folder):
    return cleaning.dedup_report(tables.sequenced_validations(spark, folder), FIRST_ORDER)


@query
def incremental_refresh(spark, folder):
    """The event table arriving as a file stream, with every file delivered twice."""
    root = scratch_path(spark, "refresh")
    arriving = tables.event_submissions(spark, folder)
    for _ in range(2):
        arriving.write.mode("append").parquet(f"{root}/in")
    stream = refresh.submitted_stream(spark, f"{root}/in", arriving.schema, files_per_batch=4)
    refresh.run_refresh(stream, f"{root}/table", f"{root}/quarantine", f"{root}/checkpoint", ["seq"])
    taken = spark.read.parquet(f"{root}/table")
    return taken.groupBy("stop").agg(F.count("*").alias("rows"), F.countDistinct("day").alias("days"))


@query
def refreshed_features(spark, folder):
    """Validations arriving by parts, one part twice: the kept features equal those built from all different rows."""
    root = scratch_path(spark, "refresh")
    arriving = tables.sequenced_validations(spark, folder)
    part = F.pmod(F.xxhash64("seq"), F.lit(3))
    for number in (0, 1, 1, 2):
        arriving.where(part == number).write.mode("append").parquet(f"{root}/in")
    files = len(spark.read.schema(arriving.schema).parquet(f"{root}/in").inputFiles())
    stream = refresh.submitted_stream(spark, f"{root}/in", arriving.schema, files_per_batch=max(1, -(-files // 2)))
    store = refresh.FeatureStore(root, _calendar(spark, folder), _codes(spark, folder), folders=8)
    refresh.run_refresh(stream, f"{root}/table", f"{root}/quarantine", f"{root}/checkpoint", arriving.columns, store)
    return tidy(store.read(spark), std7=4).select(*features.COLUMNS)


# -- modelling -----------------------------------------------------------------------------


@query
def feature_pipeline(spark, folder):
    return tidy(_features(spark, folder), std7=4).select(*features.COLUMNS)


@query
def temporal_split(spark, folder):
    train, test, _ = regression.temporal_split(_stored_features(spark, folder))
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(
        F.count("*").alias("rows"),
        F.countDistinct("day").alias("days"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


@query
def impute_train_median(spark, folder):
    train, _, _ = regression.temporal_split(_stored_features(spark, folder))
    return tidy(regression.feature_medians(train))


def _train_test(spark: SparkSession, folder: str, leak_free: bool = False):
    return pipelines.training_sides(_stored_features(spark, folder, leak_free))


#: What one application has prepared, by (application, folder): queries over the same folder share it.
_KEPT: dict[tuple, object] = {}


def _kept(spark: SparkSession, folder: str, name: str, make: Callable):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of the stored features with gaps filled, through files, once per application and folder."""

    def make():
        sides = _train_test(spark, folder)
        stored = materialize(sides[0], "train"), materialize(sides[1], "test")
        for side in sides:
            side.unpersist()
        return stored

    train, test = _kept(spark, folder, "sides", make)
    return spread(train), spread(test)


def _models(spark: SparkSession, folder: str, *names: str) -> dict[str, PipelineModel | TreeModel]:
    """Models of the published sizes, each fitted once per application and folder."""
    missing = [name for name in names if (spark.sparkContext.applicationId, folder, name) not in _KEPT]
    if missing:
        sized = regression.estimators()
        for name, model in regression.fit_models(_sides(spark, folder)[0], {name: sized[name] for name in missing}).items():
            _kept(spark, folder, name, lambda model=model: model)
    return {name: _kept(spark, folder, name, lambda: None) for name in names}


def _fitted(spark: SparkSession, folder: str, name: str) -> tuple[PipelineModel | TreeModel, DataFrame, DataFrame]:
    return _models(spark, folder, name)[name], *_sides(spark, folder)


@query
def linear_model(spark, folder):
    model, _, _ = _fitted(spark, folder, "linear")
    return tidy(regression.linear_coefficients(model))


@query
def decision_tree(spark, folder):
    model, _, test = _fitted(spark, folder, "tree")
    return tidy(regression.regression_metrics(model.transform(test)))


@query
def random_forest(spark, folder):
    model, _, test = _fitted(spark, folder, "forest")
    return tidy(regression.regression_metrics(model.transform(test)))


@query
def boosted_trees(spark, folder):
    model, _, test = _fitted(spark, folder, "boosted")
    return tidy(regression.regression_metrics(model.transform(test)))


@query
def model_comparison(spark, folder):
    return tidy(regression.compare_fitted(*_sides(spark, folder), _models(spark, folder, *regression.estimators())))


@query
def short_term_features(spark, folder):
    pairs = lookups.distinct_pairs(_requests(spark, folder))
    inputs = lookups.request_features(pairs, _daily(spark, folder), _calendar(spark, folder), _codes(spark, folder))
    return tidy(inputs, std7=4)


@query
def predict_traffic(spark, folder):
    model, _, _ = _fitted(spark, folder, "forest")
    wanted = _requests(spark, folder).select("request_id", "stop", "day")
    pairs = lookups.distinct_pairs(wanted)
    inputs = lookups.request_features(pairs, _daily(spark, folder), _calendar(spark, folder), _codes(spark, folder))
    answers = regression.predict(model, inputs).select("stop", "day", "predicted", "confidence")
    return lookups.with_status(lookups.answer(wanted, answers), "predicted")


@query
def feature_attribution(spark, folder):
    train, _ = _sides(spark, folder)
    fitted = _models(spark, folder, "forest", "boosted")
    impurity = regression.impurity_importance(fitted).withColumn("method", F.concat(F.lit("impurity "), F.col("model"))).drop("model")
    shapley = regression.shapley_importance(train, fitted["forest"].ensemble).withColumn("method", F.lit("shapley forest"))
    permuted = regression.permutation_importance(fitted["forest"], train).select(
        "feature", F.col("rmse_rise").alias("importance"), F.lit("permutation forest").alias("method")
    )
    return tidy(impurity.unionByName(shapley).unionByName(permuted))


@query
def top_factors(spark, folder):
    model, _, test = _fitted(spark, folder, "forest")
    return tidy(regression.top_factors(test, model.ensemble))


@query
def residuals(spark, folder):
    """What the naive model, the count of seven rows earlier, leaves on the test side."""
    _, test = _sides(spark, folder)
    return tidy(regression.residuals(test.withColumn("prediction", F.col("lag7"))))


@query
def learning_curve(spark, folder):
    model, train, test = _fitted(spark, folder, "boosted")
    return tidy(regression.learning_curve(model, train, test))


@query
def isolation_forest(spark, folder):
    labelled, _ = pipelines.isolation_labels(_features(spark, folder))
    return tidy(labelled.select("stop", "day", "n", "z", "norm", "gap", "score", "is_isolated"))


#: A forest small enough to be written down; each node: input, threshold, left, right, path length.
LITERAL_TREES = [
    [(2, 1.5, 1, 2, 0.0), (-1, 0.0, -1, -1, 2.0), (0, 0.8, 3, 4, 0.0), (-1, 0.0, -1, -1, 1.5), (-1, 0.0, -1, -1, 1.0)],
    [(1, 10.0, 1, 2, 0.0), (2, -1.0, 3, 4, 0.0), (-1, 0.0, -1, -1, 1.1), (-1, 0.0, -1, -1, 1.2), (-1, 0.0, -1, -1, 2.4)],
]


def _literal_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Rows labelled by the literal forest after it was stored and read back."""
    table = anomaly.with_inputs(_features(spark, folder))
    path = scratch_path(spark, "detector")
    forest = artefacts.literal_forest(spark, LITERAL_TREES, 4, -0.55)
    artefacts.Detector(forest, exploration.stop_moments(table)).save(path)
    detector = artefacts.Detector.load(spark, path)
    return detector.forest.label(detector.forest.score(table))


@query
def stored_detector(spark, folder):
    return tidy(_literal_labels(spark, folder).select("stop", "day", "n", "score", "is_isolated"))


@query
def literal_detector_agreement(spark, folder):
    return anomaly.detector_agreement(_literal_labels(spark, folder), 1.8)


@query
def literal_anomaly_summary(spark, folder):
    return tidy(anomaly.anomaly_summary(_literal_labels(spark, folder), 1.8))


@query
def literal_lowest_scores(spark, folder):
    return tidy(anomaly.lowest_scores(_literal_labels(spark, folder)).select("stop", "day", "score"))


@query
def detect_anomaly(spark, folder):
    table, forest = pipelines.isolation_labels(_features(spark, folder))
    observed = _requests(spark, folder).select("request_id", "stop", "n")
    inputs = anomaly.observed_inputs(observed, table.select("stop", "day", "n"), exploration.stop_moments(table))
    verdicts = anomaly.detect_all(inputs, forest)
    return tidy(verdicts.select("request_id", "stop", "n", "status", "is_isolated", "score", "z", "mean", "message"))


@query
def detect_zscore(spark, folder):
    """The part of the verdict that needs no forest."""
    daily = _daily(spark, folder)
    observed = _requests(spark, folder).select("request_id", "stop", "n")
    inputs = anomaly.observed_inputs(observed, daily, exploration.stop_moments(daily))
    return tidy(inputs.select("request_id", "stop", "n", "status", *anomaly.z_verdict(), "gap"))


@query
def standardize(spark, folder):
    scaled = profiles.standardize(profiles.stop_profile(_supplier_counts(spark, folder)))
    return tidy(scaled.select("stop", *profiles.SCALED))


@query
def kmeans_profiles(spark, folder):
    labelled = pipelines.segment_stops(_vectors(spark, folder))
    return tidy(labelled.select("stop", *PROFILE_MEASURES, "cluster_k2", "cluster_k5", "profile_k2", "profile_k5"))


@query
def cluster_quality(spark, folder):
    labelled = _labelled_profiles(spark, folder)
    return tidy(profiles.cluster_quality(profiles.standardize(labelled)))


@query
def choose_k(spark, folder):
    return tidy(profiles.choose_k(_vectors(spark, folder)))


@query
def name_clusters(spark, folder):
    labelled = _labelled_profiles(spark, folder)
    two = profiles.name_two(labelled).withColumnRenamed("profile", "profile_k2")
    return profiles.name_five(labelled).withColumnRenamed("profile", "profile_k5").join(two, "cluster")


@query
def assign_cluster(spark, folder):
    """Known suppliers keep their label; customers' nations come as new stops with their own profiles."""
    vectors = _vectors(spark, folder)
    model = profiles.best_kmeans(vectors, 5)
    labelled = model.transform(vectors)
    named = profiles.map_labels(labelled, profiles.name_five(labelled))
    fresh = profiles.stop_profile(_daily(spark, folder))
    asked = fresh.select("stop").unionByName(labelled.select("stop"))
    return profiles.assign_cluster(asked, named, fresh, profiles.scale_of(labelled), model)


#: Two centres in scaled measures.
LITERAL_CENTRES = [[0.5, 0.4, -0.2, 0.6, -0.3], [-0.6, -0.5, 0.3, -0.7, 0.2]]


@query
def stored_segments(spark, folder):
    """Scaler, centres and labels stored and read back; all suppliers labelled anew by the nearest centre."""
    known = profiles.stop_profile(_supplier_counts(spark, folder))
    scale = profiles.scale_of(known)
    centres = Centres(profiles.SCALED, np.array(LITERAL_CENTRES), 0.0)
    labelled = centres.transform(profiles.standardize(known, scale)).withColumn("profile", F.concat(F.lit("Cluster "), F.col("cluster")))
    path = scratch_path(spark, "segments")
    artefacts.Segmentation(scale, centres, labelled).save(path)
    again = artefacts.Segmentation.load(spark, path)
    fresh = again.label(known).select("stop", "cluster")
    return again.assign(known.select("stop"), known).select("stop", F.col("cluster").alias("stored_cluster"), "profile").join(fresh, "stop")


@query
def density_clusters(spark, folder):
    vectors = _vectors(spark, folder).drop("vector")
    return density.density_clusters(vectors, profiles.SCALED).select("stop", "cluster")


@query
def hierarchical_clusters(spark, folder):
    """Three algorithms compared on the same profiles."""
    vectors = _vectors(spark, folder)
    return tidy(pipelines.compare_clusterings(vectors, k=5))


@query
def pca2(spark, folder):
    out, shares = profiles.pca2(_vectors(spark, folder))
    return tidy(out.select("stop", "pca1", "pca2", *[F.lit(s).alias(f"share{i + 1}") for i, s in enumerate(shares)]))


@query
def holiday_frame(spark, folder):
    return _holidays(spark, folder)


def _far_targets(daily: DataFrame) -> DataFrame:
    """Every stop 30, 90 and 180 days past its last day."""
    ends = daily.groupBy("stop").agg(F.max("day").alias("last_day"))
    return ends.select("stop", F.explode(F.array(*[F.date_add("last_day", d) for d in (30, 90, 180)])).alias("day"))


@query
def long_term_forecast(spark, folder):
    daily = materialize(_daily(spark, folder), "daily")
    unknown = spark.createDataFrame([("NO SUCH STOP", "2000-01-01")], "stop string, day string").withColumn("day", F.to_date("day"))
    return forecast.forecast_answers(daily, _far_targets(daily).unionByName(unknown), _holidays(spark, folder), TEST_SETTINGS)


@query
def forecast_curve(spark, folder):
    daily = materialize(_daily(spark, folder), "daily")
    return forecast.forecast_curve(daily, _far_targets(daily), _holidays(spark, folder), TEST_SETTINGS)


@query
def forecast_backtest(spark, folder):
    daily = materialize(_daily(spark, folder), "daily")
    return tidy(forecast.forecast_backtest(daily, _holidays(spark, folder), TEST_SETTINGS))


@query
def backtest_metrics(spark, folder):
    """The backtest measures of a naive forecast: each held-out row predicted by the last one before."""
    train, test = forecast.hold_out(_daily(spark, folder).select("stop", "day", "n"), DEFAULTS.forecast_holdout)
    last = train.groupBy("stop").agg(F.max_by("n", "day").cast("double").alias("yhat"))
    return tidy(forecast.backtest_metrics(test.join(last, "stop")))


@query
def backtest_verdict(spark, folder):
    return tidy(forecast.backtest_verdict(backtest_metrics(spark, folder)))


@query
def forecast_refusals(spark, folder):
    """Asked stops without a long-term forecast, and why; the bound on traffic lies amid these series."""
    asked = _requests(spark, folder).select("stop").distinct()
    return forecast.refusals(asked, _daily(spark, folder), replace(DEFAULTS, forecast_min_mean=37.0)).select("stop", "reason")


@query
def projection_check(spark, folder):
    daily = materialize(_daily(spark, folder), "daily")
    return tidy(forecast.projection_check(daily, (75, 259), _holidays(spark, folder), TEST_SETTINGS))


def _snapshots(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(SNAPSHOT).cast("date")
    return table.where(F.col("day") < cut), table.where(F.col("day") >= cut)


@query
def drift_distances(spark, folder):
    table = _stored_features(spark, folder).withColumns({c: F.round(c, 9) for c in ("mean7", "std7")})
    reference, current = _snapshots(table)
    return tidy(drift.drift_distances(reference, current, DRIFT_SETS["traffic"]))


@query
def drift_report(spark, folder):
    before, after = _snapshots(_stored_features(spark, folder))
    old, new = (profiles.stop_profile(part) for part in _snapshots(_supplier_counts(spark, folder)))
    sides = {"traffic": (before, after), "anomaly": (before, after), "clustering": (old, new)}
    sets = {name: (*pair, DRIFT_SETS[name], DRIFT_TESTS[name]) for name, pair in sides.items()}
    sets["missing"] = (None, new, DRIFT_SETS["clustering"], DRIFT_TESTS["clustering"])
    return tidy(drift.drift_reports(sets))
