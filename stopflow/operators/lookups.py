"""Batch answers to requests about a stop and a day.

A request is a row, so thousands are answered by one job. Whatever depends on
(stop, day) alone is computed once per distinct pair: a stop asked for in a third
of the requests costs one row per day asked, not one per request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import FEATURES
from stopflow.functions.numeric import half_even
from stopflow.operators.features import LAST7, add_calendar_flags, add_date_parts, by_stop, congestion, in_order
from stopflow.session import join_lookup


def distinct_pairs(requests: DataFrame) -> DataFrame:
    pairs = requests.select("stop", "day").where(F.col("stop").isNotNull() & F.col("day").isNotNull())
    return pairs.distinct()


def _history_at(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """Pairs of known stops with everything history says about them, in one shuffle by stop.

    Only the history of stops asked for is shuffled. Pairs and history are stacked and read in date order. History rows carry the
    statistics of the seven rows ending with themselves; a pair takes the last
    ones strictly before its day. Requests sort before history of the same day,
    and occupy no place in the seven-row frames because those are computed on
    history alone.
    """
    asked_stops = pairs.select("stop").distinct()
    history = join_lookup(history, asked_stops, "stop", "left_semi")
    stats = F.struct(F.avg("n").over(in_order(LAST7)).alias("mean7"), F.stddev_samp("n").over(in_order(LAST7)).alias("std7"))
    past = history.select(
        "stop",
        "day",
        F.lit(1).alias("is_history"),
        F.col("n"),
        "carrier",
        stats.alias("last7"),
    )
    asked = pairs.select(
        "stop",
        "day",
        F.lit(0).alias("is_history"),
        F.lit(None).cast("bigint").alias("n"),
        F.lit(None).cast("string").alias("carrier"),
        F.lit(None).cast(past.schema["last7"].dataType).alias("last7"),
    )
    before = Window.partitionBy("stop").orderBy("day", "is_history").rowsBetween(Window.unboundedPreceding, -1)
    days = F.datediff("day", F.lit("1970-01-01").cast("date"))
    exact = lambda shift: Window.partitionBy("stop").orderBy(days).rangeBetween(-shift, -shift)
    merged = asked.unionByName(past).select(
        "*",
        F.last("last7", ignorenulls=True).over(before).alias("recent"),
        F.max("n").over(exact(0)).alias("n_same"),
        F.max("n").over(exact(1)).alias("n_day1"),
        F.max("n").over(exact(7)).alias("n_day7"),
        F.median("n").over(by_stop()).alias("median_n"),
        F.max("n").over(by_stop()).alias("max_n"),
        F.min("carrier").over(by_stop()).alias("stop_carrier"),
    )
    known = merged.where((F.col("is_history") == 0) & F.col("max_n").isNotNull())
    return known.drop("is_history", "n", "carrier", "last7").withColumnRenamed("stop_carrier", "carrier")


def calendar_lags(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """Counts exactly 1 and 7 days earlier; the stop's median where the day is missing."""
    found = _history_at(pairs, history)
    median = F.col("median_n").cast("double")
    return found.select(
        "stop",
        "day",
        F.coalesce(F.col("n_day1").cast("double"), median).alias("lag1"),
        F.coalesce(F.col("n_day7").cast("double"), median).alias("lag7"),
    )


def asof_last7(pairs: DataFrame, history: DataFrame) -> DataFrame:
    """Mean and deviation of the last seven history rows strictly before the day."""
    found = _history_at(pairs, history)
    return found.select("stop", "day", F.col("recent.mean7").alias("mean7"), F.col("recent.std7").alias("std7"))


def request_features(pairs: DataFrame, history: DataFrame, calendar: DataFrame | None, codes: DataFrame) -> DataFrame:
    """The model inputs for each (stop, day): what is known before that day.

    A day inside the history takes its own count for the congestion score, as in
    training; a later day takes the recent mean.
    """
    found = _history_at(pairs, history)
    median = F.col("median_n").cast("double")
    filled = found.withColumns(
        {
            "lag1": F.coalesce(F.col("n_day1").cast("double"), median),
            "lag7": F.coalesce(F.col("n_day7").cast("double"), median),
        }
    ).withColumns(
        {
            "mean7": F.coalesce("recent.mean7", "lag7"),
            "std7": F.coalesce("recent.std7", F.lit(0.0)),
        }
    )
    scored = filled.withColumn(
        "congestion", congestion(F.coalesce(F.col("n_same").cast("double"), F.col("mean7")), F.col("max_n"))
    )
    dated = add_calendar_flags(add_date_parts(scored), calendar)
    coded = join_lookup(dated, codes, "carrier").withColumn("carrier_index", F.coalesce("carrier_index", F.lit(0)))
    return coded.select("stop", "day", *FEATURES)


def answer(requests: DataFrame, features: DataFrame) -> DataFrame:
    """Attach per-pair results to every request; unknown stops keep NULLs.

    One pair may be asked for in a third of the requests; `join_lookup` spreads it.
    """
    return join_lookup(requests, features, ["stop", "day"])


def with_status(answered: DataFrame, figure: str) -> DataFrame:
    """Requests with their answers and why there is none: every request keeps its row."""
    reason = F.when(F.col("stop").isNull(), F.lit("stop missing")).when(F.col("day").isNull(), F.lit("day missing"))
    return answered.withColumn("status", F.coalesce(reason, F.when(F.col(figure).isNull(), F.lit("unknown stop")), F.lit("ok")))


def score_against_history(observed: DataFrame, moments: DataFrame) -> DataFrame:
    """Observed counts with the stop's mean, z-score, share of its maximum and a status.

    Every row is answered: one of a missing or unknown stop has NULL figures and says so.
    """
    joined = join_lookup(observed, moments, "stop")
    known = F.col("mean").isNotNull()
    status = F.when(F.col("stop").isNull(), F.lit("stop missing")).when(known, F.lit("ok")).otherwise(F.lit("unknown stop"))
    z = F.when(F.col("std") > 0, (F.col("n") - F.col("mean")) / F.col("std")).otherwise(F.lit(0.0))
    norm = F.when(F.col("max") > 0, F.col("n") / F.col("max")).otherwise(F.lit(0.0))
    return joined.withColumns({"z": F.when(known, z), "norm": F.when(known, norm), "status": status})


def last7_mean(history: DataFrame) -> DataFrame:
    """Mean of the seven latest rows of each stop."""
    newest = Window.partitionBy("stop").orderBy(F.desc("day"))
    recent = history.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= 7)
    return recent.groupBy("stop").agg(F.avg("n").alias("recent_mean"))


def rounded_prediction(c):
    """Whole and never negative."""
    return F.greatest(half_even(c, 0), F.lit(0.0)).cast("bigint")
