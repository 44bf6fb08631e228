"""Long-term forecast of each stop from its own history.

The model is the additive-trend, multiplicative-season decomposition of Taylor
and Letham (2018): y = trend (1 + weekly + yearly + holiday). Stops are fitted in
parallel; one stop's history is one row per day, so a group is bounded by the
length of the calendar. Only the small least-squares fit of one series is Python.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.config import DEFAULTS, HOLIDAY, Settings
from stopflow.functions.dates import weekday_name
from stopflow.functions.numeric import half_even
from stopflow.functions.quantiles import exact_quantile, running_totals, with_slices
from stopflow.operators.lookups import rounded_prediction
from stopflow.session import join_lookup, renewed

CHANGEPOINTS = 25
OUTPUT = (
    "stop string, day date, yhat double, lower double, upper double, trend double, weekly double, yearly double, holiday double"
)


def holiday_frame(calendar_rows: DataFrame) -> DataFrame:
    """Holidays as (holiday, day, lower_window, upper_window); vacations are left to the yearly season."""
    return calendar_rows.where(F.col("type") == HOLIDAY).select(
        F.lit(HOLIDAY).alias("holiday"), "day", F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window")
    )


def per_stop(daily: DataFrame) -> DataFrame:
    return daily.groupBy("stop").agg(
        F.countDistinct("day").alias("days"), F.avg("n").alias("mean"), F.sum("n").alias("volume"), F.max("day").alias("last_day")
    )


def _enough(settings: Settings):
    return F.col("days") >= settings.forecast_min_days, F.col("mean") >= settings.forecast_min_mean


def eligible_stops(daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    long, busy = _enough(settings)
    return per_stop(daily).where(long & busy)


def forecast_eligibility(daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Eligible and excluded stops by reason, and the median history and traffic."""
    long, busy = _enough(settings)
    stops = per_stop(daily).persist()
    medians = {c: exact_quantile(stops, c, 0.5) for c in ("days", "mean")}
    whole = lambda c: F.floor(F.lit(medians[c]).cast("double")).cast("bigint")
    return stops.agg(
        F.count("*").alias("stops"),
        F.count_if(long & busy).alias("eligible"),
        F.count_if(~long).alias("too_short"),
        F.count_if(long & ~busy).alias("too_quiet"),
        whole("days").alias("median_days"),
        whole("mean").alias("median_mean"),
    )


def big_mid_small(daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Largest, middle and smallest eligible stop by volume."""
    stops = eligible_stops(daily, settings).withColumn("value", -F.col("volume").cast("double")).persist()
    counts = stops.groupBy("value").agg(F.count("*").alias("rows"))
    before = running_totals(with_slices(counts), [], "value", ["rows"]).select(
        "value", "rows_before", F.col("rows_total").alias("count")
    )
    # Only stops of equal volume share a window.
    among_equals = F.row_number().over(Window.partitionBy("value").orderBy("stop")) - 1
    ranked = stops.join(before, "value").withColumn("position", F.col("rows_before") + among_equals)
    size = (
        F.when(F.col("position") == 0, F.lit("big"))
        .when(F.col("position") == F.floor(F.col("count") / 2), F.lit("middle"))
        .when(F.col("position") == F.col("count") - 1, F.lit("small"))
    )
    return ranked.withColumn("size", size).where(F.col("size").isNotNull()).select("size", "stop", "volume", "days", "mean")


# -- one series --------------------------------------------------------------


def _season(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(days / period, np.arange(1, order + 1))
    return np.hstack([np.sin(angle), np.cos(angle)])


class SeriesFit:
    """Penalised least squares, alternating between trend and season."""

    def __init__(self, days: np.ndarray, y: np.ndarray, holidays: np.ndarray, settings: Settings):
        self.first, self.span = days.min(), max(days.max() - days.min(), 1)
        self.unit = max(np.abs(y).max(), 1e-9)
        self.holidays = holidays
        self.settings = settings
        count = len(days)
        inner = np.linspace(0, int(count * settings.forecast_changepoint_range) - 1, CHANGEPOINTS + 1)[1:]
        self.knots = np.unique((days[np.clip(inner.round().astype(int), 0, count - 1)] - self.first) / self.span)
        trend_x, season_x, v = self._trend_x(days), self._season_x(days), y / self.unit
        beta = np.zeros(season_x.shape[1])
        slopes = np.zeros(len(self.knots))
        noise = max(v.var(), 1e-6)
        for _ in range(12):
            lift = 1 + season_x @ beta
            # Laplace prior on the slope changes, as reweighted ridge.
            sharp = noise / (settings.forecast_changepoint_scale * np.maximum(np.abs(slopes), 1e-4))
            ridge = np.concatenate([np.full(2, noise / 25.0), sharp])
            a = trend_x * lift[:, None]
            theta = np.linalg.solve(a.T @ a + np.diag(ridge), a.T @ v)
            slopes = theta[2:]
            g = trend_x @ theta
            b = season_x * g[:, None]
            beta = np.linalg.solve(b.T @ b + np.eye(b.shape[1]) * max(noise / 100.0, 1e-9), b.T @ (v - g))
            noise = max(np.mean((v - g * (1 + season_x @ beta)) ** 2), 1e-9)
        self.theta, self.beta, self.noise, self.slopes = theta, beta, noise, slopes

    def _trend_x(self, days: np.ndarray) -> np.ndarray:
        t = (days - self.first) / self.span
        return np.column_stack([np.ones_like(t), t, np.maximum(t[:, None] - self.knots[None, :], 0)])

    def _season_x(self, days: np.ndarray) -> np.ndarray:
        return np.column_stack([_season(days, 7.0, 3), _season(days, 365.25, 10), np.isin(days, self.holidays).astype(float)])

    def predict(self, days: np.ndarray) -> pd.DataFrame:
        season_x, trend = self._season_x(days), self._trend_x(days) @ self.theta
        weekly, yearly = season_x[:, :6] @ self.beta[:6], season_x[:, 6:26] @ self.beta[6:26]
        holiday = season_x[:, 26] * self.beta[26]
        lift = 1 + weekly + yearly + holiday
        # Past the data the trend keeps changing slope at its past rate: slope changes of
        # mean size m arriving at rate r add variance r 2 m^2 h^3 / 3 at distance h.
        ahead = np.maximum((days - self.first) / self.span - 1, 0)
        size = np.abs(self.slopes).mean() if len(self.slopes) else 0.0
        drift = len(self.slopes) / self.settings.forecast_changepoint_range * 2 * size**2 * ahead**3 / 3
        spread = np.sqrt(self.noise + drift * lift**2) * NormalDist().inv_cdf(0.5 + self.settings.forecast_interval / 2)
        yhat = trend * lift
        scaled = {"yhat": yhat, "lower": yhat - spread, "upper": yhat + spread, "trend": trend}
        out = {k: v * self.unit for k, v in scaled.items()}
        return pd.DataFrame({**out, "weekly": weekly, "yearly": yearly, "holiday": holiday})


def _epoch(days: pd.Series) -> np.ndarray:
    return pd.to_datetime(days).to_numpy().astype("datetime64[D]").astype("int64")


def fit_predict(history: DataFrame, targets: DataFrame, holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Fit each stop on (stop, day, n) and evaluate it on its target days.

    The holiday list is one date per holiday of the calendar, a few per year.
    """
    days_off = _epoch(holidays.select("day").distinct().toPandas()["day"])
    columns = [f.split()[0] for f in OUTPUT.split(", ")]

    def one_stop(past: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if past.empty or wanted.empty:
            return pd.DataFrame(columns=columns)
        past, wanted = past.sort_values("day"), wanted.sort_values("day").reset_index(drop=True)
        fit = SeriesFit(_epoch(past["day"]), past["n"].to_numpy(float), days_off, settings)
        return pd.concat([wanted[["stop", "day"]], fit.predict(_epoch(wanted["day"]))], axis=1)[columns]

    past = renewed(history.select("stop", "day", "n")).groupBy("stop")
    wanted = renewed(targets.select("stop", "day").distinct()).groupBy("stop")
    return past.cogroup(wanted).applyInPandas(one_stop, OUTPUT)


def _eligible_history(daily: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    stops = eligible_stops(daily, settings).persist()
    return join_lookup(daily, stops.select("stop"), "stop", "left_semi"), stops


def long_term_forecast(daily: DataFrame, targets: DataFrame, holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Whole prediction, interval, effects in percent and horizon for each eligible (stop, day)."""
    history, stops = _eligible_history(daily, settings)
    fitted = fit_predict(history, join_lookup(targets, stops.select("stop"), "stop", "left_semi"), holidays, settings)
    percent = lambda c: half_even(F.col(c) * 100, 1)
    return join_lookup(fitted, stops, "stop", "inner").select(
        "stop",
        "day",
        rounded_prediction(F.col("yhat")).alias("predicted"),
        rounded_prediction(F.col("lower")).alias("lower"),
        half_even(F.col("upper"), 0).cast("bigint").alias("upper"),
        half_even(F.col("trend"), 0).cast("bigint").alias("trend"),
        percent("weekly").alias("weekly_pct"),
        percent("yearly").alias("yearly_pct"),
        percent("holiday").alias("holiday_pct"),
        weekday_name(F.col("day")).alias("weekday_name"),
        F.datediff("day", "last_day").alias("horizon"),
        F.col("days").alias("history_days"),
        half_even(F.col("mean"), 0).cast("bigint").alias("history_mean"),
    )


def forecast_answers(daily: DataFrame, targets: DataFrame, holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A row for every asked (stop, day): the forecast, or why there is none."""
    given = long_term_forecast(daily, targets, holidays, settings).withColumn("status", F.lit("ok"))
    refused = refusals(targets.where(F.col("stop").isNotNull()), daily, settings).select("stop", "day", F.col("reason").alias("status"))
    nameless = targets.where(F.col("stop").isNull()).select("stop", "day", F.lit("stop missing").alias("status"))
    return given.unionByName(refused.unionByName(nameless), allowMissingColumns=True)


def refusals(targets: DataFrame, daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Why a stop gets no long-term forecast."""
    long, busy = _enough(settings)
    joined = join_lookup(targets, per_stop(daily), "stop")
    reason = (
        F.when(F.col("days").isNull(), F.lit("unknown stop"))
        .when(~long, F.lit("history too short"))
        .when(~busy, F.lit("traffic too low"))
    )
    return joined.withColumn("reason", reason).where(F.col("reason").isNotNull())


def forecast_curve(daily: DataFrame, targets: DataFrame, holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """History and projection of each asked stop in long form.

    The projection covers the history and runs 30 days past the farthest day asked.
    """
    asked = targets.groupBy("stop").agg(F.max("day").alias("until"))
    history, _ = _eligible_history(daily, settings)
    history = history.join(asked, "stop", "left_semi")
    ends = history.groupBy("stop").agg(F.max("day").alias("last_day")).join(asked, "stop")
    more = F.greatest(F.datediff("until", "last_day") + 30, F.lit(30))
    future = ends.select("stop", F.explode(F.sequence(F.date_add("last_day", 1), F.date_add(F.col("last_day"), more))).alias("day"))
    days = history.select("stop", "day").unionByName(future)
    whole = lambda c: half_even(F.col(c), 0).cast("bigint")
    projected = fit_predict(history, days, holidays, settings).select(
        "stop",
        "day",
        F.lit("projection").alias("kind"),
        whole("yhat").alias("value"),
        rounded_prediction(F.col("lower")).alias("lower"),
        whole("upper").alias("upper"),
    )
    nothing = F.lit(None).cast("bigint")
    past = history.select("stop", "day", F.lit("history").alias("kind"), F.col("n").alias("value"), nothing.alias("lower"), nothing.alias("upper"))
    return past.unionByName(projected)


def backtest_metrics(predicted: DataFrame) -> DataFrame:
    """MAE over all held-out days, MAPE over days with traffic."""
    error = F.abs(F.col("n") - F.col("yhat"))
    return predicted.groupBy("stop").agg(
        F.count("*").alias("held_out"),
        F.avg(error).alias("mae"),
        (F.avg(F.when(F.col("n") > 0, error / F.col("n"))) * 100).alias("mape"),
    )


def backtest_verdict(metrics: DataFrame, limit: float = 20.0) -> DataFrame:
    """One row: stops measured, exact median MAPE over them, and whether it is under the limit (percent)."""
    measured = metrics.where(F.col("mape").isNotNull())
    median = exact_quantile(measured, "mape", 0.5)
    return measured.agg(
        F.count("*").alias("stops"), F.lit(median).cast("double").alias("median_mape"), (F.lit(median).cast("double") < limit).alias("good")
    )


def hold_out(history: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Everything but the last rows of each stop, and those rows."""
    newest = Window.partitionBy("stop").orderBy(F.desc("day"))
    ranked = history.withColumn("age", F.row_number().over(newest))
    return ranked.where(F.col("age") > rows).drop("age"), ranked.where(F.col("age") <= rows).drop("age")


def forecast_backtest(daily: DataFrame, holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Hold out each eligible stop's last rows, fit on the rest and measure."""
    history, _ = _eligible_history(daily, settings)
    train, test = hold_out(history.select("stop", "day", "n"), settings.forecast_holdout)
    predicted = fit_predict(train, test, holidays, settings).join(test, ["stop", "day"])
    return backtest_metrics(predicted)


def projection_check(daily: DataFrame, offsets: tuple[int, int], holidays: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Suspect stops: the lower of two far projections falls under half the historical mean."""
    history, stops = _eligible_history(daily, settings)
    targets = stops.select("stop", F.explode(F.array(*[F.date_add("last_day", d) for d in offsets])).alias("day"))
    low = fit_predict(history, targets, holidays, settings).groupBy("stop").agg(F.min("yhat").alias("lowest"))
    return stops.join(low, "stop").select(
        "stop", "mean", "lowest", (F.col("lowest") / F.col("mean")).alias("ratio"),
        (F.col("lowest") / F.col("mean") < settings.suspect_ratio).alias("suspect"),
    )
