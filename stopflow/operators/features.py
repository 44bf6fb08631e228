"""The stop-by-day feature table.

After aggregation a (stop, day) pair is unique, so one stop holds at most one
row per calendar day however many raw rows it had. All windows below partition
by stop at that grain: their size is bounded by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stopflow.config import CATEGORIES, PUBLISHED_FEATURE_NAMES
from stopflow.functions import text
from stopflow.functions.dates import date_parts, is_weekend, weekday_name
from stopflow.functions.numeric import half_even, ratio_or_zero
from stopflow.operators.cleaning import filter_defined
from stopflow.session import join_lookup, materialize

CODES = ["carrier", "network", "stop_code", "zone_id"]
COLUMNS = list(PUBLISHED_FEATURE_NAMES)
LAST7 = (-6, 0)
PREVIOUS7 = (-7, -1)


def by_stop() -> WindowSpec:
    return Window.partitionBy("stop")


def in_order(rows: tuple[int, int] | None = None) -> WindowSpec:
    """A stop's rows by day, optionally in a moving frame of rows."""
    ordered = by_stop().orderBy("day")
    return ordered.rowsBetween(*rows) if rows else ordered


def daily_counts(rows: DataFrame) -> DataFrame:
    """(stop, day, n): the sum over all categories."""
    return rows.groupBy("stop", "day").agg(F.sum("n").alias("n"))


def counted_rows(rows: DataFrame) -> DataFrame:
    """Rows that enter the table: a defined category, a stop and a day."""
    return filter_defined(rows).where(F.col("stop").isNotNull() & F.col("day").isNotNull())


def stop_day(rows: DataFrame) -> DataFrame:
    """(stop, day, n and codes) over defined categories; rows without stop or day are left out.

    The codes are the smallest ones seen, so that the result does not depend on
    row order. Minima of text need a sort, so the raw rows are first summed per
    stop, day and codes by a hash aggregation; only what is left is sorted.
    """
    summed = counted_rows(rows).groupBy("stop", "day", *CODES).agg(F.sum("n").alias("n"))
    return summed.groupBy("stop", "day").agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in CODES])


def pivot_category(rows: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """One column per known category; naming them spares Spark a pass to find them."""
    wide = rows.groupBy("stop", "day").pivot("category", categories).agg(F.sum("n"))
    return wide.select(
        "stop", "day", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(text.column_name(c)) for c in categories]
    )


def add_date_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(date_parts(F.col("day")))


def add_calendar_flags(df: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """Holiday and vacation flags; all false without a calendar or outside its range.

    `calendar` has one row per day, 366 a year at most, so it may be broadcast
    without counting it.
    """
    if calendar is None:
        return df.withColumns({"is_holiday": F.lit(False), "is_vacation": F.lit(False)})
    flags = ["is_holiday", "is_vacation"]
    joined = df.join(F.broadcast(calendar.select("day", *flags)), "day", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})


def add_row_lags(df: DataFrame, fill: bool = True) -> DataFrame:
    """Counts 1 and 7 rows earlier; a missing lag takes the stop's median of that lag."""
    df = df.withColumns({f"lag{k}": F.lag(F.col("n").cast("double"), k).over(in_order()) for k in (1, 7)})
    if not fill:
        return df
    return df.withColumns({c: F.coalesce(c, F.median(c).over(by_stop())) for c in ("lag1", "lag7")})


def add_rolling(df: DataFrame, frame: tuple[int, int] = LAST7) -> DataFrame:
    """Mean and sample deviation over seven rows; the deviation of one row is 0."""
    return df.withColumns(
        {
            "mean7": F.avg("n").over(in_order(frame)),
            "std7": F.coalesce(F.stddev_samp("n").over(in_order(frame)), F.lit(0.0)),
        }
    )


def congestion(n: Column, top: Column) -> Column:
    return half_even(ratio_or_zero(n, top), 4)


def add_congestion(df: DataFrame) -> DataFrame:
    return df.withColumn("congestion", congestion(F.col("n"), F.max("n").over(by_stop())))


def carrier_codes(df: DataFrame) -> DataFrame:
    """Carrier code to index, in text order. The order is over distinct codes only."""
    codes = df.select(F.col("carrier").cast("string").alias("carrier")).where(F.col("carrier").isNotNull()).distinct()
    return codes.select("carrier", (F.row_number().over(Window.orderBy("carrier")) - 1).alias("carrier_index"))


def encode_carrier(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Unknown carriers get index 0."""
    joined = join_lookup(df, codes, "carrier")
    return joined.withColumn("carrier_index", F.coalesce("carrier_index", F.lit(0)))


def build_features(
    rows: DataFrame, calendar: DataFrame | None, codes: DataFrame | None = None, leak_free: bool = False
) -> DataFrame:
    """Raw validations to the feature table, with one shuffle by stop for all windows.

    The faithful version lets `mean7`, `std7` and `congestion` see the day they
    are used to predict. `leak_free` uses the seven preceding rows and the
    previous day's congestion instead.
    """
    daily = stop_day(rows)
    if codes is None:
        # Stored, so that codes and features come from one scan of the raw rows.
        daily = materialize(daily, "stop-day")
        codes = carrier_codes(daily)
    return features_of_days(daily, calendar, codes, leak_free)


def features_of_days(daily: DataFrame, calendar: DataFrame | None, codes: DataFrame, leak_free: bool = False) -> DataFrame:
    """The feature table from one row per (stop, day)."""
    base = encode_carrier(add_calendar_flags(add_date_parts(daily), calendar), codes)
    lagged = add_congestion(add_rolling(add_row_lags(base), PREVIOUS7 if leak_free else LAST7))
    if not leak_free:
        return lagged
    before = F.lag("congestion", 1).over(in_order())
    return lagged.withColumns({"congestion": F.coalesce(before, F.lit(0.0)), "mean7": F.coalesce("mean7", "lag7")})


def week_over_week(rows: DataFrame) -> DataFrame:
    """Daily count, the count seven rows earlier and the change in percent."""
    lagged = daily_counts(rows).withColumn("n_lag7", F.lag("n", 7).over(in_order()))
    change = F.try_divide((F.col("n") - F.col("n_lag7")) * 100.0, F.col("n_lag7"))
    return lagged.withColumn("change_pct", F.round(change, 1))


def zscores(df: DataFrame) -> DataFrame:
    """Distance to the stop's mean in sample deviations; 0 when there is no spread."""
    mean, spread = F.avg("n").over(by_stop()), F.stddev_samp("n").over(by_stop())
    return df.withColumn("z", F.when(spread > 0, (F.col("n") - mean) / spread).otherwise(0.0))


def norm_and_gap(df: DataFrame) -> DataFrame:
    """Share of the stop's maximum and distance to the seven-day mean."""
    return df.withColumns(
        {
            "norm": ratio_or_zero(F.col("n"), F.max("n").over(by_stop())),
            "gap": F.coalesce(F.col("n") - F.col("mean7"), F.lit(0.0)),
        }
    )


def day_types(calendar: DataFrame, first: str, last: str) -> DataFrame:
    """Every day of a period with the first type that applies: holiday, vacation, weekend, weekday."""
    bounds = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    spine = calendar.sparkSession.range(1).select(F.explode(bounds).alias("day"))
    flagged = spine.join(calendar, "day", "left")
    kind = (
        F.when(F.col("is_holiday"), F.lit("holiday"))
        .when(F.col("is_vacation"), F.lit("vacation"))
        .when(is_weekend(F.col("day")), F.lit("weekend"))
        .otherwise(F.lit("weekday"))
    )
    return flagged.select("day", weekday_name(F.col("day")).alias("weekday_name"), kind.alias("day_type"))
