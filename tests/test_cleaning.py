import pytest
from pyspark.sql import functions as F

from stopflow.functions import text
from stopflow.operators import cleaning
from stopflow.plans import pipelines
from stopflow.sources import readers, sinks

RIGHT = "JOUR;CODE_STIF_TRNS;CODE_STIF_RES;CODE_STIF_ARRET;ID_ZDC;LIBELLE_ARRET;CATEGORIE_TITRE;NB_VALD"
SWAPPED = "JOUR;CODE_STIF_TRNS;CODE_STIF_RES;CODE_STIF_ARRET;LIBELLE_ARRET;ID_ZDC;CATEGORIE_TITRE ;NB_VALD"


@pytest.fixture
def quarters(tmp_path):
    files = {
        "T1": [RIGHT, "2025-01-01;100;110;1;71;CHATELET;Imagine R;5", "2025-01-01;100;110;1;71;CHATELET;Imagine R;7"],
        "T2": [SWAPPED, "2025-04-01;100.0;110.0;2; CHATELET ;;Contrat Solidarite Transport;3.7"],
        "T3": [RIGHT, "2025-07-14;;110;3;72.0;ABLON ;NON DEFINI;abc", "14/07/2025;100;110;3;72;ABLON;Imagine R;1"],
        "T4": [SWAPPED, "2025-10-01;100D;R 1;4;NA;73;Imagine R;9", "2025-10-02;100;110;4;;73;Imagine R;9"],
    }
    paths = {}
    for name, lines in files.items():
        paths[name] = str(tmp_path / f"{name}.csv")
        with open(paths[name], "w", encoding="utf-8-sig") as out:
            out.write("\n".join(lines) + "\n")
    return paths


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_raw_files_are_read_by_name(spark, quarters):
    clean = cleaning.clean_rows(readers.read_raw_files(spark, quarters))
    got = rows(clean.withColumn("day", F.col("day").cast("string")), "source", "day", "carrier", "network", "zone_id", "stop", "category", "n")
    assert got == sorted(
        [
            ("T1", "2025-01-01", "100", "110", 71, "CHATELET", "Imagine R", 5),
            ("T1", "2025-01-01", "100", "110", 71, "CHATELET", "Imagine R", 7),
            ("T2", "2025-04-01", "100", "110", 0, "CHATELET", "Contrat Solidarité Transport", 3),
            ("T3", "2025-07-14", "0", "110", 72, "ABLON", "NON DEFINI", 0),
            ("T3", None, "100", "110", 72, "ABLON", "Imagine R", 1),
            ("T4", "2025-10-01", "100D", "R 1", 73, "NA", "Imagine R", 9),
            ("T4", "2025-10-02", "100", "110", 73, None, "Imagine R", 9),
        ],
        key=repr,
    )


def test_year_load_drops_unusable_rows_and_copies(spark, quarters):
    loaded = pipelines.load_year(spark, quarters)
    assert rows(loaded, "stop", "n") == [("ABLON", 0), ("CHATELET", 3), ("CHATELET", 5), ("NA", 9)]


def test_missing_column_is_refused(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("JOUR;NB_VALD\n2025-01-01;3\n", encoding="utf-8")
    with pytest.raises(readers.MissingColumns):
        readers.read_raw_file(spark, str(path))
    with pytest.raises(readers.MissingColumns):
        readers.read_raw_files(spark, {"T1": str(path)})


def test_files_of_one_order_are_one_scan(spark, quarters, tmp_path):
    """Four files in two orders; folders of several files and names with blanks belong to their source."""
    folder = tmp_path / "a b" / "T5"
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"part {i}.csv").write_text(f"{RIGHT}\n2025-01-0{i + 1};100;110;1;71;X{i};Imagine R;5\n", encoding="utf-8")
    df = readers.read_raw_files(spark, {**quarters, "T5": str(folder)})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert rows(df.where("source = 'T5'"), "stop") == [("X0",), ("X1",), ("X2",)]
    assert df.where("source IS NULL").count() == 0 and df.count() == 10


def test_strict_dates_raise(spark):
    df = spark.createDataFrame([("2025-13-01",)], "day string")
    with pytest.raises(Exception):
        df.select(cleaning.parse_day(F.col("day"), strict=True)).collect()
    assert df.select(cleaning.parse_day(F.col("day")).alias("d")).first()["d"] is None


@pytest.mark.parametrize(
    "value, count, code",
    [
        ("100.0", 100, "100"),
        ("100D", 0, "100D"),
        ("3.7", 3, "3"),
        ("-0.5", 0, "0"),
        ("1e3", 1000, "1000"),
        (" 5 ", 5, "5"),
        ("abc", 0, "abc"),
        ("", 0, ""),
        ("1e30", 0, "1e30"),
        (None, 0, "0"),
    ],
)
def test_number_texts(spark, value, count, code):
    df = spark.createDataFrame([(value,)], "c string")
    row = df.select(text.count_or_zero(F.col("c")).alias("n"), text.code(F.col("c")).alias("code")).first()
    assert (row["n"], row["code"]) == (count, code)


def test_submitted_rows_get_defaults_or_a_reason(spark):
    schema = "seq bigint, day string, carrier string, network string, stop_code string, zone_id string, stop string, category string, n string"
    raw = spark.createDataFrame(
        [
            (1, "2026-07-05", None, None, None, None, " chatelet ", "Forfait Navigo", "145000"),
            (2, "2026-07-05", "7", "8", "9", "10", "CHATELET", "Forfait Navigo", "-50"),
            (3, None, None, None, None, None, "CHATELET", "Forfait Navigo", "1"),
            (4, "2026-07-05", None, None, None, None, "CHATELET", "Forfait Navigo", "many"),
            (5, "2026-07-05", None, None, None, None, " ", "Forfait Navigo", "1"),
        ],
        schema,
    )
    typed = cleaning.submitted_rows(raw).persist()
    assert rows(cleaning.accepted(typed), "seq", "carrier", "network", "stop_code", "zone_id", "stop", "n") == [
        (1, "100", "110", "0", 0, "CHATELET", 145000)
    ]
    assert rows(cleaning.rejected(typed), "seq", "reason") == [
        (2, "count negative"),
        (3, "day missing or malformed"),
        (4, "count missing or not a number"),
        (5, "stop missing"),
    ]


def test_request_reasons(spark):
    requests = spark.createDataFrame(
        [("CHATELET", "2026-07-01", 800, "k5"), ("CHATELET", None, 1, "k5"), ("GARE", "2026-07-01", -50, "k5"), ("GARE", "2026-07-01", 1, "k99")],
        "stop string, day string, n bigint, version string",
    )
    assert [r["reason"] for r in cleaning.request_reasons(requests).collect()] == [
        None,
        "day missing",
        "count negative",
        "unknown version",
    ]


def test_keep_first_of_a_hot_key_needs_no_window(spark):
    copies = spark.range(3000).select(
        F.lit("2025-01-01").cast("date").alias("day"),
        F.when(F.col("id") < 1000, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("stop"),
        F.lit("Imagine R").alias("category"),
        F.col("id").alias("seq"),
        (F.col("id") % 7).alias("n"),
    )
    kept = cleaning.deduplicate(copies, ["seq"])
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 2001
    assert kept.where("stop = 'HOT'").first()["seq"] == 0
    report = cleaning.dedup_report(copies, ["seq"]).first()
    assert report["rows_dropped"] == 999 and report["volume_dropped"] == sum(i % 7 for i in range(1000))


def test_reload_leaves_the_previous_version_readable(spark, tmp_path):
    first = sinks.reload_table(spark.range(3).toDF("n"), str(tmp_path / "t"))
    second = sinks.reload_table(spark.range(5).toDF("n"), str(tmp_path / "t"))
    assert spark.read.parquet(first).count() == 3 and spark.read.parquet(second).count() == 5


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaning_reads_texts_as_the_published_patterns_do(spark):
    white = [chr(i) for i in (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    odd = ["", " ", "​", "﻿7", "\x1c7", "007", "7.", ".5", ".", "+7", "-7.9", "1e3", "1E+2", "e", "+", "1e", "100D", "1f", "NaN", "Infinity", "0x1p3", "1 2", "7\n", "٧", "1e400", "99999999999999999999"]
    days = ["1997-02-28", "1997-02-30", "1997-2-28", "0000-01-01", "0001-01-01", "9999-12-31", "+1997-01-01", "1997-01-1T", "1997-01-01T00", "31/12/1999", "٠1997-01-01", " 1997-01-01 \n"]
    texts = [*odd, *days, None, *[f"{w}7{w}" for w in white], *[f"{w}{w} a{w}b {w}" for w in white]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    trimmed = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    number = F.when(trimmed.rlike(text.NUMBER), trimmed.try_cast("double"))
    day = F.try_to_date(F.when(trimmed.rlike(r"^\d{4}-\d{2}-\d{2}$"), trimmed), "yyyy-MM-dd")
    got = df.select("i", text.strip(F.col("t")).alias("s"), text.number(F.col("t")).alias("n"), cleaning.parse_day(F.col("t")).cast("string").alias("d"))
    want = df.select("i", trimmed.alias("s"), number.alias("n"), day.cast("string").alias("d"))
    assert got.orderBy("i").collect() == want.orderBy("i").collect()


def test_a_text_is_trimmed_without_a_pattern_and_read_once(spark):
    raw = spark.createDataFrame([("1", " a")], "n string, stop string").repartition(2)
    assert "regexp_replace" not in plan_of(raw.select(text.strip(F.col("stop"))))
    assert plan_of(raw.select(text.number(F.col("n")))).count("trim(") == 1
    assert plan_of(raw.select(cleaning.parse_day(F.col("n")))).count("trim(") == 1


def test_no_stage_is_left_to_the_interpreter(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
