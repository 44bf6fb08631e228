import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from stopflow.operators import exploration, features
from stopflow.plans import catalog
from stopflow.sources import readers, sinks


def validations(spark, counts):
    """{stop: {day: n}} as raw rows."""
    rows = [
        (dt.date.fromisoformat(day), "100", "110", "1", 1, stop, "Imagine R", n)
        for stop, days in counts.items()
        for day, n in days.items()
    ]
    return spark.createDataFrame(rows, "day date, carrier string, network string, stop_code string, zone_id bigint, stop string, category string, n bigint")


def days(start, values):
    first = dt.date.fromisoformat(start)
    return {(first + dt.timedelta(i)).isoformat(): v for i, v in enumerate(values) if v is not None}


@pytest.fixture
def gaps(spark):
    return validations(
        spark,
        {
            "GAP": days("2025-01-01", [10, 20, None, 40, 50, 60, 70, 80, 90, 100]),
            "ONE": days("2025-01-01", [5]),
            "THREE": days("2025-01-01", [1, 2, 3]),
            "ZERO": days("2025-01-01", [0, 0, 0]),
        },
    )


def by_stop(df, stop):
    return {str(r["day"]): r for r in df.where(F.col("stop") == stop).collect()}


def test_row_lags_skip_missing_days(spark, gaps):
    table = features.build_features(gaps, None).persist()
    gap = by_stop(table, "GAP")
    assert gap["2025-01-04"]["lag1"] == 20.0
    assert gap["2025-01-09"]["lag7"] == 10.0
    assert gap["2025-01-01"]["lag7"] == statistics.median([10, 20])
    assert gap["2025-01-05"]["mean7"] == statistics.mean([10, 20, 40, 50])
    assert gap["2025-01-10"]["std7"] == pytest.approx(statistics.stdev([40, 50, 60, 70, 80, 90, 100]))
    assert by_stop(table, "ONE")["2025-01-01"]["lag1"] is None
    assert by_stop(table, "ONE")["2025-01-01"]["std7"] == 0.0
    assert by_stop(table, "THREE")["2025-01-03"]["lag7"] is None
    assert {r["congestion"] for r in by_stop(table, "ZERO").values()} == {0.0}
    assert {r["is_holiday"] for r in table.select("is_holiday").collect()} == {False}


def test_leak_free_features_do_not_see_their_day(spark, gaps):
    changed = gaps.withColumn("n", F.when(F.col("day") == F.lit("2025-01-10").cast("date"), 100000).otherwise(F.col("n")))
    for name in ("mean7", "std7"):
        a = by_stop(features.build_features(gaps, None, leak_free=True), "GAP")["2025-01-10"][name]
        b = by_stop(features.build_features(changed, None, leak_free=True), "GAP")["2025-01-10"][name]
        assert a == b


def test_zero_spread_gives_zero_score(spark, gaps):
    scored = features.norm_and_gap(features.zscores(features.add_rolling(features.stop_day(gaps))))
    for row in scored.where("stop in ('ZERO', 'ONE')").collect():
        assert row["z"] == 0.0
    assert {r["norm"] for r in scored.where("stop = 'ZERO'").collect()} == {0.0}


def test_holiday_inside_vacation_is_a_holiday_only(spark, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text("date,type,description\n2025-07-13,vacances,x\n2025-07-14,ferie,x\n2025-07-15,normal,x\n2025-09-01,rentree,x\n", encoding="utf-8")
    calendar = readers.calendar_days(readers.read_calendar(spark, str(path)))
    flags = {str(r["day"]): (r["is_holiday"], r["is_vacation"]) for r in calendar.collect()}
    assert flags == {
        "2025-07-13": (False, True),
        "2025-07-14": (True, False),
        "2025-07-15": (False, False),
        "2025-09-01": (False, True),
    }


def test_undefined_rows_and_null_keys_are_left_out(spark):
    rows = validations(spark, {"A": {"2025-01-01": 3}})
    undefined = rows.withColumn("category", F.lit("NON DEFINI"))
    nameless = rows.withColumn("stop", F.lit(None).cast("string"))
    assert [r["n"] for r in features.stop_day(rows.unionByName(undefined).unionByName(nameless)).collect()] == [3]


def test_codes_do_not_depend_on_row_order(spark):
    rows = validations(spark, {"A": {"2025-01-01": 3}})
    both = rows.unionByName(rows.withColumns({"carrier": F.lit("099"), "zone_id": F.lit(0).cast("bigint")}))
    a = features.stop_day(both).first()
    b = features.stop_day(both.orderBy(F.desc("carrier"))).first()
    assert a == b and a["carrier"] == "099" and a["n"] == 6


def test_carrier_index_follows_text_order(spark):
    codes = features.carrier_codes(spark.createDataFrame([("800",), ("100",), ("1000",), ("800",)], "carrier string"))
    assert {r["carrier"]: r["carrier_index"] for r in codes.collect()} == {"100": 0, "1000": 1, "800": 2}
    unknown = features.encode_carrier(spark.createDataFrame([("5",), (None,)], "carrier string"), codes)
    assert [r["carrier_index"] for r in unknown.collect()] == [0, 0]


def test_ties_are_broken_by_stop_and_day(spark):
    rows = validations(spark, {s: {"2025-01-01": 7, "2025-01-02": 7} for s in "DCBA"})
    top = exploration.congestion_top20(rows, 3).collect()
    assert [(r["stop"], str(r["day"]), r["score"]) for r in top] == [("A", "2025-01-01", 1.0), ("A", "2025-01-02", 1.0), ("B", "2025-01-01", 1.0)]


def test_week_over_week_survives_a_zero(spark):
    rows = validations(spark, {"A": days("2025-01-01", [0, 1, 1, 1, 1, 1, 1, 5])})
    last = features.week_over_week(rows).orderBy(F.desc("day")).first()
    assert (last["n"], last["n_lag7"], last["change_pct"]) == (5, 0, None)


def test_published_table_has_the_published_columns(spark, gaps, tmp_path):
    path = str(tmp_path / "published")
    sinks.publish_features(features.build_features(gaps, None), path)
    assert "LIBELLE_ARRET" in spark.read.parquet(path).columns and "score_congestion" in spark.read.parquet(path).columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_shuffle_by_stop_once(spark, folder):
    """One exchange by stop serves all windows."""
    windows = features.add_congestion(features.add_rolling(features.add_row_lags(catalog._daily(spark, folder))))
    keys = [line.split("hashpartitioning(")[1].split(", 8")[0] for line in plan(windows).splitlines() if "Exchange hashpartitioning(" in line]
    assert len([k for k in keys if k.startswith("stop#") and "," not in k]) == 1, keys


def test_filter_and_columns_reach_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "v")
    catalog._daily(spark, folder).write.parquet(path)
    text = plan(spark.read.parquet(path).where((F.col("stop") == "NATION_3") & (F.col("day") >= F.lit("1997-01-01").cast("date"))).select("n"))
    assert "EqualTo(stop,NATION_3)" in text and "GreaterThanOrEqual(day" in text
    assert "carrier" not in text.split("ReadSchema")[1]
