"""Exploration queries over validations and features.

Each one aggregates the raw rows first (partial sums before the shuffle) and
orders or ranks only the aggregated rows. Every limited result has a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, UNDEFINED, WEEKDAYS_EN
from stopflow.functions.dates import is_weekend, weekday_name, weekday_name_fr
from stopflow.functions.numeric import half_even, percent
from stopflow.functions.quantiles import exact_quantiles
from stopflow.operators.features import daily_counts


def _top(df: DataFrame, value: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(value), *ties).limit(k)


def stop_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("stop").agg(F.sum("n").alias("total"))


def top10_stops(rows: DataFrame, k: int = 10) -> DataFrame:
    totals = rows.groupBy("stop").agg(F.sum("n").alias("total"), F.countDistinct("day").alias("active_days"))
    return _top(totals, "total", k, "stop")


def top20_stops(rows: DataFrame, k: int = 20) -> DataFrame:
    top = _top(stop_totals(rows), "total", k, "stop")
    return top.withColumn("millions", half_even(F.col("total") / 1_000_000, 2))


def daily_totals(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy("day").agg(F.sum("n").alias("total"))
    return totals.withColumns(
        {"weekday_name": weekday_name(F.col("day")), "is_weekend": is_weekend(F.col("day"))}
    )


def weekday_mean(rows: DataFrame) -> DataFrame:
    """Mean daily total per weekday, numbered from 1 = Sunday."""
    daily = rows.groupBy("day").agg(F.sum("n").alias("total"))
    by_weekday = daily.groupBy(F.dayofweek("day").alias("weekday_number")).agg(
        F.first(weekday_name_fr(F.col("day"))).alias("weekday_name"),
        F.count("day").alias("days"),
        F.round(F.avg("total"), 0).alias("mean_total"),
        F.sum("total").alias("total"),
    )
    return by_weekday


def week_weekend_ratio(rows: DataFrame) -> DataFrame:
    """Mean of the five weekday means over the mean of the two weekend means."""
    daily = rows.groupBy("day").agg(F.sum("n").alias("total"))
    means = daily.groupBy(F.weekday("day").alias("weekday")).agg(F.avg("total").alias("mean"))
    sides = means.agg(
        F.avg(F.when(F.col("weekday") < 5, F.col("mean"))).alias("week_mean"),
        F.avg(F.when(F.col("weekday") >= 5, F.col("mean"))).alias("weekend_mean"),
    )
    return sides.withColumn("ratio", F.try_divide("week_mean", "weekend_mean"))


def monthly_stats(rows: DataFrame) -> DataFrame:
    daily = rows.groupBy("day").agg(F.sum("n").alias("total"))
    return daily.groupBy(F.month("day").alias("month"), F.date_format("day", "MMMM yyyy").alias("month_name")).agg(
        F.avg("total").alias("mean_total"), F.sum("total").alias("total"), F.count("*").alias("days")
    )


def max_daily_total(rows: DataFrame, stop: str) -> DataFrame:
    daily = rows.where(F.col("stop") == stop).groupBy("day").agg(F.sum("n").alias("total"))
    return daily.agg(F.max("total").alias("max_total"))


def scalar_checks(rows: DataFrame, stop: str, day: str) -> DataFrame:
    """Total of one stop on one day, and the last day of the table, in one pass."""
    wanted = (F.col("stop") == stop) & (F.col("day") == F.lit(day).cast("date"))
    return rows.agg(F.sum(F.when(wanted, F.col("n"))).alias("total"), F.max("day").alias("last_day"))


def congestion_top20(rows: DataFrame, k: int = 20) -> DataFrame:
    """Stop-days closest to the stop's record. A window maximum replaces the self-join."""
    top = F.max("n").over(Window.partitionBy("stop"))
    scored = daily_counts(rows).withColumn("max_n", top)
    scored = scored.withColumn("score", F.round(F.try_divide(F.col("n").cast("double"), F.col("max_n")), 3))
    return scored.orderBy(F.desc("score"), "stop", "day").limit(k)


def undefined_rate(rows: DataFrame, k: int = 20) -> DataFrame:
    undefined = F.sum(F.when(F.col("category") == UNDEFINED, F.col("n")).otherwise(0))
    rates = rows.groupBy("stop").agg(F.sum("n").alias("total"), undefined.alias("undefined"))
    rates = rates.withColumn("undefined_pct", percent(F.col("undefined"), F.col("total"), 1))
    return rates.orderBy(F.desc_nulls_last("undefined_pct"), "stop").limit(k)


def undefined_rate_aligned(rows: DataFrame, k: int = 20) -> DataFrame:
    """Undefined share as the division of two totals aligned on the stop; missing counts as 0."""
    totals = stop_totals(rows)
    undefined = stop_totals(rows.where(F.col("category") == UNDEFINED)).withColumnRenamed("total", "undefined")
    share = F.try_divide(F.col("undefined") * 100.0, F.col("total"))
    rates = totals.join(undefined, "stop", "left").select(
        "stop", half_even(F.coalesce(share, F.lit(0.0)), 2).alias("undefined_pct")
    )
    return _top(rates, "undefined_pct", k, "stop")


def semi_top_stops(rows: DataFrame, k: int = 50) -> DataFrame:
    """All rows of the k largest stops; the right side holds k rows at most."""
    top = _top(stop_totals(rows), "total", k, "stop").select("stop")
    return rows.join(F.broadcast(top), "stop", "left_semi")


def stop_weekday_heatmap(rows: DataFrame, k: int = 50) -> DataFrame:
    """Weekday totals of the k largest stops, each divided by the stop's largest."""
    cells = rows.groupBy("stop", F.weekday("day").alias("weekday")).agg(F.sum("n").alias("n"))
    wide = cells.groupBy("stop").pivot("weekday", list(range(7))).agg(F.sum("n"))
    days = [F.col(f"`{i}`") for i in range(7)]
    total = sum((F.coalesce(d, F.lit(0)) for d in days), F.lit(0))
    top = wide.withColumn("total", total).orderBy(F.desc("total"), "stop").limit(k)
    largest = F.greatest(*days)
    return top.select("stop", *[(d / largest).alias(name.lower()) for d, name in zip(days, WEEKDAYS_EN)])


def category_share(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy("category").agg(F.sum("n").alias("total"))
    whole = F.sum("total").over(Window.partitionBy())
    return totals.withColumn("pct", half_even(F.col("total") * 100.0 / whole, 1))


def category_share_month(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy(
        F.month("day").alias("month"), F.date_format("day", "MMMM").alias("month_name"), "category"
    ).agg(F.sum("n").alias("total"))
    whole = F.sum("total").over(Window.partitionBy("month"))
    return totals.withColumn("pct", half_even(F.col("total") * 100.0 / whole, 1))


def category_by_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "category").agg(F.sum("n").alias("total"))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum as (statistic, value)."""
    basic = df.agg(
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    )
    names = ["count", "mean", "std", "min", "max"]
    long = basic.select(F.explode(F.array(*[F.struct(F.lit(c).alias("statistic"), F.col(c).alias("value")) for c in names])).alias("s")).select("s.*")
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    labels = F.concat(F.round(F.col("share") * 100).cast("int").cast("string"), F.lit("%"))
    return long.unionByName(quartiles.select(labels.alias("statistic"), "value"))


def active_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("stop").agg(F.countDistinct("day").alias("active_days"))


def incomplete_stops(rows: DataFrame, minimum: int = DEFAULTS.incomplete_days) -> DataFrame:
    return active_days(rows).where(F.col("active_days") < minimum)


def defined_split(rows: DataFrame) -> DataFrame:
    """Rows, share of rows and volume with and without a defined category."""
    sides = rows.groupBy((F.col("category") != UNDEFINED).alias("is_defined")).agg(
        F.count("*").alias("rows"), F.sum("n").alias("volume")
    )
    return sides.withColumn("row_pct", half_even(F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()), 2))


def flag_effect(features: DataFrame) -> DataFrame:
    """Mean count with each flag on and off."""
    flags = ["is_weekend", "is_vacation", "is_holiday"]
    long = features.select("n", *flags).unpivot(["n"], flags, "flag", "on")
    return long.groupBy("flag", "on").agg(F.avg("n").alias("mean_n"), F.count("*").alias("rows"))


def lag_correlation(features: DataFrame) -> DataFrame:
    """Pearson correlation of the count with each lag feature, in one pass; a gap leaves out that pair only."""
    inputs = ["lag1", "lag7", "mean7", "std7"]
    wide = features.agg(*[F.corr("n", c).alias(c) for c in inputs])
    return wide.unpivot([], inputs, "feature", "correlation")


def mean_congestion_top20(features: DataFrame, k: int = 20) -> DataFrame:
    means = features.groupBy("stop").agg(F.avg("congestion").alias("mean_congestion"))
    return _top(means, "mean_congestion", k, "stop")


def stop_stats(daily: DataFrame) -> DataFrame:
    """History summary of every stop. The median is exact: one stop has one row per day."""
    return daily.groupBy("stop").agg(
        F.countDistinct("day").alias("days"),
        half_even(F.avg("n"), 0).alias("mean"),
        half_even(F.median("n"), 0).alias("median"),
        F.min("n").alias("min"),
        F.max("n").alias("max"),
        F.sum("n").alias("total"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def stop_moments(daily: DataFrame) -> DataFrame:
    return daily.groupBy("stop").agg(
        F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"),
        F.max("n").alias("max"),
        F.min("n").alias("min"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the column's minimum and maximum; the last bin includes the maximum."""
    bounds = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, rows bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    bucket = F.least(F.width_bucket(F.col(column).cast("double"), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    counts = df.where(F.col(column).isNotNull()).groupBy((bucket - 1).cast("int").alias("bin")).agg(F.count("*").alias("rows"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("low"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def list_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of each column in order, with how many there are."""
    pairs = rows.unpivot([], columns, "kind", "value").where(F.col("value").isNotNull()).distinct()
    counts = pairs.groupBy("kind").agg(F.count("*").alias("values"))
    # One row per column asked for.
    return pairs.join(F.broadcast(counts), "kind").orderBy("kind", "value")


def data_range(daily: DataFrame, stop: str) -> DataFrame:
    return daily.where(F.col("stop") == stop).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.countDistinct("day").alias("days")
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per distinct combination of columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


def busiest_quietest_days(rows: DataFrame, k: int = 5) -> DataFrame:
    daily = daily_totals(rows).select("day", "weekday_name", "total")
    busiest = daily.orderBy(F.desc("total"), "day").limit(k).withColumn("kind", F.lit("busiest"))
    quietest = daily.orderBy("total", "day").limit(k).withColumn("kind", F.lit("quietest"))
    return busiest.unionByName(quietest)


def centered_mean7(rows: DataFrame) -> DataFrame:
    """Centred seven-day mean of the daily totals, NULL within three days of either end.

    The window is over one row per calendar day, the only global order used here.
    """
    around = Window.orderBy("day").rowsBetween(-3, 3)
    daily = rows.groupBy("day").agg(F.sum("n").alias("total"))
    full = F.count("*").over(around) == 7
    return daily.withColumn("mean7", F.when(full, F.avg("total").over(around)))


def date_position(requests: DataFrame, first_day, last_day) -> DataFrame:
    """Whether a requested day lies inside the known range and how far past its end; a missing day is said to be."""
    past = F.datediff("day", F.lit(last_day))
    return requests.withColumns(
        {
            "position": F.when(F.col("day").isNull(), F.lit("day missing"))
            .when(F.col("day") < F.lit(first_day), F.lit("before"))
            .when(past > 0, F.lit("after"))
            .otherwise(F.lit("inside")),
            "days_past_end": F.when(F.col("day").isNotNull(), F.greatest(past, F.lit(0))),
        }
    )
