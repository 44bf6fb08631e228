import datetime as dt


from stopflow.operators.features import build_features
from stopflow.plans import catalog
from stopflow.sources import benchmark_tables as tables
from stopflow.streaming import refresh

SCHEMA = "seq bigint, ts timestamp, day date, carrier string, network string, stop_code string, zone_id bigint, stop string, category string, n bigint"


def row(seq, stop, day, n):
    when = dt.datetime(2025, 1, day, 12)
    return (seq, when, when.date(), "100", "110", "1", 1, stop, "Imagine R", n)


def test_refresh_takes_each_row_once_and_continues(spark, tmp_path):
    def deliver(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    schema = spark.createDataFrame([], SCHEMA).schema
    places = [str(tmp_path / p) for p in ("table", "quarantine", "checkpoint")]

    def run():
        refresh.run_refresh(refresh.submitted_stream(spark, str(tmp_path / "in"), schema, 1), *places, ["seq"])

    deliver([row(1, "A", 1, 10), row(2, "A", 2, 20), row(3, "B", 1, 5)])
    deliver([row(2, "A", 2, 20), row(4, "B", 2, -7)])
    run()
    table = spark.read.parquet(places[0])
    assert sorted(r["seq"] for r in table.collect()) == [1, 2, 3]
    assert [(r["seq"], r["reason"]) for r in spark.read.parquet(places[1]).collect()] == [(4, "count negative")]

    before = [r["batch"] for r in table.select("batch").distinct().collect()]
    deliver([row(1, "A", 1, 10), row(5, "A", 3, 30)])
    run()
    table = spark.read.parquet(places[0])
    assert sorted(r["seq"] for r in table.collect()) == [1, 2, 3, 5]

    plan = refresh._unseen(table.drop("batch").where("seq = 1"), places[0], 9, ["seq"], [dt.date(2025, 1, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters")[1] and "2025-01-01" in plan.replace("20089", "2025-01-01")


def test_features_of_touched_stops_equal_a_rebuild(spark, tmp_path):
    """Rows of a stop-day in several batches, replays and rejects; folders of other stops are not written again."""
    schema = spark.createDataFrame([], SCHEMA).schema
    places = [str(tmp_path / p) for p in ("table", "quarantine", "checkpoint")]
    codes = spark.createDataFrame([("100", 0)], "carrier string, carrier_index int")
    store = refresh.FeatureStore(str(tmp_path / "store"), None, codes, folders=8)

    def deliver(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        refresh.run_refresh(refresh.submitted_stream(spark, str(tmp_path / "in"), schema, 1), *places, ["seq"], store)

    stamps = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "store/features").rglob("*.parquet")}
    deliver([row(i, f"S{i % 6}", 1 + i % 20, i) for i in range(200)])
    before = stamps()
    deliver([row(i, "S3", 1 + i % 25, i) for i in range(300, 330)] + [row(3, "S3", 4, 3), row(999, "S4", 2, -1)])
    after = stamps()
    kept = set(before) & set(after)
    assert kept and all(before[p] == after[p] for p in kept) and set(after) - set(before)
    whole = build_features(spark.read.parquet(places[0]), None, codes)
    got = store.read(spark).select(*whole.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())) and got.count() > 60


def test_late_rows_arrive_whatever_their_time(spark, tmp_path):
    """Newest first, and every file twice: all rows are in the table or in quarantine, once."""
    schema = spark.createDataFrame([], SCHEMA).schema
    start = dt.datetime(2025, 1, 1)
    for begin in range(900, -1, -100):
        rows = []
        for seq in range(begin, begin + 100):
            when = start + dt.timedelta(days=seq)
            rows.append((seq, when, when.date(), "100", "110", "1", 1, "A", "Imagine R", -1 if seq % 50 == 0 else 1))
        for _ in range(2):
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    places = [str(tmp_path / p) for p in ("table", "quarantine", "checkpoint")]
    refresh.run_refresh(refresh.submitted_stream(spark, str(tmp_path / "in"), schema, 5), *places, ["seq"])
    taken = [r["seq"] for r in spark.read.parquet(places[0]).collect()]
    aside = [r["seq"] for r in spark.read.parquet(places[1]).collect()]
    assert sorted(taken + aside) == list(range(1000)) and len(aside) == 20


def test_arriving_parts_are_written_by_all_tasks(spark, folder, monkeypatch):
    rows, stream, seen = tables.sequenced_validations, refresh.submitted_stream, []

    def counted(spark, path, schema, files_per_batch):
        seen.append((len(spark.read.schema(schema).parquet(path).inputFiles()), files_per_batch))
        return stream(spark, path, schema, files_per_batch)

    monkeypatch.setattr(tables, "sequenced_validations", lambda spark, folder: rows(spark, folder).repartition(3))
    monkeypatch.setattr(refresh, "submitted_stream", counted)
    got = catalog.refreshed_features(spark, folder)
    assert seen == [(12, 6)]
    assert sorted(got.collect()) == sorted(catalog.feature_pipeline(spark, folder).collect())
