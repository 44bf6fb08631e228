import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from stopflow.operators import lookups
from tests.test_features import days, validations

from stopflow.operators.features import carrier_codes, stop_day


@pytest.fixture
def history(spark):
    return {
        "LONG": days("2025-01-01", [5, 9, None, 7, 12, 3, 8, 8, None, 11, 20, 1]),
        "ONE": days("2025-01-05", [4]),
    }


REQUESTS = [
    ("LONG", "2025-01-06"),
    ("LONG", "2025-01-09"),
    ("LONG", "2025-01-12"),
    ("LONG", "2024-12-01"),
    ("LONG", "2025-03-01"),
    ("ONE", "2025-01-05"),
    ("ONE", "2025-01-06"),
    ("UNKNOWN", "2025-01-06"),
]


def expected(history, stop, day):
    past = history[stop]
    day = dt.date.fromisoformat(day)
    median = statistics.median(past.values())
    at = lambda d: past.get(d.isoformat())
    lag = lambda k: at(day - dt.timedelta(k)) if at(day - dt.timedelta(k)) is not None else median
    recent = [past[d] for d in sorted(past) if d < day.isoformat()][-7:]
    mean = statistics.mean(recent) if recent else lag(7)
    today = at(day) if at(day) is not None else mean
    return {
        "lag1": lag(1),
        "lag7": lag(7),
        "mean7": mean,
        "std7": statistics.stdev(recent) if len(recent) > 1 else 0.0,
        "congestion": round(today / max(past.values()), 4),
        "weekday": day.weekday(),
        "iso_week": day.isocalendar()[1],
    }


def test_request_features_equal_a_plain_computation(spark, history):
    daily = stop_day(validations(spark, history))
    requests = spark.createDataFrame(REQUESTS * 2, "stop string, day string").withColumn("day", F.to_date("day"))
    pairs = lookups.distinct_pairs(requests)
    got = lookups.request_features(pairs, daily, None, carrier_codes(daily)).collect()
    assert len(got) == len(REQUESTS) - 1
    for row in got:
        want = expected(history, row["stop"], str(row["day"]))
        assert {k: row[k] for k in want} == pytest.approx(want), (row["stop"], row["day"])


def test_every_request_is_answered(spark, history):
    daily = stop_day(validations(spark, history))
    requests = spark.createDataFrame(REQUESTS * 3, "stop string, day string").withColumn("day", F.to_date("day"))
    answers = lookups.calendar_lags(lookups.distinct_pairs(requests), daily)
    joined = lookups.answer(requests, answers)
    assert joined.count() == len(REQUESTS) * 3
    assert joined.where("lag1 IS NULL").select("stop").distinct().collect()[0]["stop"] == "UNKNOWN"


def test_large_lookup_gives_the_same_result_without_copies_of_it(spark):
    from stopflow.session import join_lookup

    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner", "left_semi"):
        small = join_lookup(rows, lookup, "k", how)
        large = join_lookup(rows, lookup, "k", how, max_rows=3)
        assert sorted(map(repr, small.collect())) == sorted(map(repr, large.select(*small.columns).collect()))
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Generate" not in plan and "BroadcastHashJoin" not in plan


def test_scores_guard_zero_spread_and_zero_maximum(spark):
    moments = spark.createDataFrame([("Z", 0.0, 0.0, 0), ("A", 10.0, 5.0, 20)], "stop string, mean double, std double, max bigint")
    observed = spark.createDataFrame([("Z", 3), ("A", 20), ("X", 1)], "stop string, n bigint")
    got = {r["stop"]: (r["z"], r["norm"]) for r in lookups.score_against_history(observed, moments).collect()}
    assert got == {"Z": (0.0, 0.0), "A": (2.0, 1.0), "X": (None, None)}
