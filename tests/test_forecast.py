import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopflow.config import Settings
from stopflow.operators import forecast

FIRST = dt.date(2024, 1, 1)
SETTINGS = Settings(forecast_min_days=100, forecast_min_mean=50.0)


def signal(day: dt.date) -> float:
    """Slow trend, weekend dip, summer dip."""
    t = (day - FIRST).days
    weekly = -0.3 if day.weekday() >= 5 else 0.12
    yearly = 0.2 * np.cos(2 * np.pi * t / 365.25)
    return (1000 + 0.2 * t) * (1 + weekly + yearly - (0.5 if day.month == 5 and day.day == 1 else 0))


@pytest.fixture(scope="module")
def history(spark):
    rng = np.random.default_rng(0)
    dates = [FIRST + dt.timedelta(i) for i in range(730)]
    rows = [("BIG", d, int(round(signal(d) * (1 + rng.normal(0, 0.02))))) for d in dates]
    rows += [("SHORT", d, 500) for d in dates[:50]] + [("QUIET", d, 3) for d in dates]
    return spark.createDataFrame(rows, "stop string, day date, n bigint").persist()


@pytest.fixture(scope="module")
def holidays(spark):
    return spark.createDataFrame([(dt.date(y, 5, 1),) for y in (2024, 2025, 2026)], "day date")


def test_known_series_is_recovered(spark, history, holidays):
    dates = [dt.date(2026, 3, 15), dt.date(2026, 7, 15), dt.date(2026, 5, 1), dt.date(2026, 9, 16)]
    targets = spark.createDataFrame([("BIG", d) for d in dates], "stop string, day date")
    got = {r["day"]: r for r in forecast.long_term_forecast(history, targets, holidays, SETTINGS).collect()}
    assert set(got) == set(dates)
    for d in dates:
        assert got[d]["predicted"] == pytest.approx(signal(d), rel=0.1), d
        assert got[d]["lower"] <= got[d]["predicted"] <= got[d]["upper"]
    assert got[dt.date(2026, 5, 1)]["holiday_pct"] < -30
    assert got[dt.date(2026, 3, 15)]["weekly_pct"] < -20
    assert got[dt.date(2026, 3, 15)]["horizon"] == (dt.date(2026, 3, 15) - dates_end()).days
    assert got[dt.date(2026, 7, 15)]["yearly_pct"] < got[dt.date(2026, 3, 15)]["yearly_pct"]


def dates_end():
    return FIRST + dt.timedelta(729)


def test_interval_widens_with_the_horizon(spark, history, holidays):
    wavy = history.where("stop = 'BIG'").withColumn("n", (F.col("n") * (1 + 0.3 * (F.col("day") > F.lit("2024-09-01").cast("date")).cast("int"))).cast("bigint"))
    targets = spark.createDataFrame([("BIG", dates_end() + dt.timedelta(7 * k)) for k in (1, 150)], "stop string, day date")
    rows = forecast.fit_predict(wavy, targets, holidays, SETTINGS).orderBy("day").collect()
    widths = [r["upper"] - r["lower"] for r in rows]
    assert widths[1] > widths[0] > 0


def test_short_and_quiet_stops_are_refused(spark, history):
    targets = spark.createDataFrame([(s, dt.date(2026, 3, 1)) for s in ("BIG", "SHORT", "QUIET", "NONE")], "stop string, day date")
    got = {r["stop"]: r["reason"] for r in forecast.refusals(targets, history, SETTINGS).collect()}
    assert got == {"SHORT": "history too short", "QUIET": "traffic too low", "NONE": "unknown stop"}
    row = forecast.forecast_eligibility(history, SETTINGS).first()
    assert (row["stops"], row["eligible"], row["too_short"], row["too_quiet"]) == (3, 1, 1, 1)


def test_backtest_is_close(history, holidays):
    row = forecast.forecast_backtest(history, holidays, SETTINGS).collect()
    assert [r["stop"] for r in row] == ["BIG"] and row[0]["held_out"] == 30 and row[0]["mape"] < 10


def test_mape_ignores_days_without_traffic(spark):
    df = spark.createDataFrame([("A", 0, 5.0), ("A", 10, 5.0)], "stop string, n bigint, yhat double")
    row = forecast.backtest_metrics(df).first()
    assert row["mae"] == 5.0 and row["mape"] == 50.0


def test_curve_runs_thirty_days_past_the_farthest_request(spark, history, holidays):
    far = dates_end() + dt.timedelta(45)
    targets = spark.createDataFrame([("BIG", far), ("BIG", dates_end())], "stop string, day date")
    curve = forecast.forecast_curve(history, targets, holidays, SETTINGS).persist()
    ends = {r["kind"]: (r["c"], r["m"]) for r in curve.groupBy("kind").agg(F.count("*").alias("c"), F.max("day").alias("m")).collect()}
    assert ends == {"history": (730, dates_end()), "projection": (730 + 75, far + dt.timedelta(30))}


def test_steady_stop_is_not_suspect(history, holidays):
    rows = forecast.projection_check(history, (75, 259), holidays, SETTINGS).collect()
    assert [(r["stop"], r["suspect"]) for r in rows] == [("BIG", False)]


def test_big_middle_small(spark):
    rows = [(f"S{i}", FIRST + dt.timedelta(d), 100 * (i + 1)) for i in range(5) for d in range(3)]
    df = spark.createDataFrame(rows, "stop string, day date, n bigint")
    got = {r["size"]: r["stop"] for r in forecast.big_mid_small(df, Settings(forecast_min_days=3, forecast_min_mean=1)).collect()}
    assert got == {"big": "S4", "middle": "S2", "small": "S0"}
