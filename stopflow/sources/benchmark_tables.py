"""Validations, calendar, requests and raw submissions derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.config import RAW_HEADER, UNDEFINED
from stopflow.sources.sinks import write_raw


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )


def _category():
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "N", F.lit(UNDEFINED)).when(flag == "A", F.lit("Forfait Navigo")).otherwise(F.lit("Imagine R"))
    )


def validations(spark: SparkSession, folder: str, stop: str = "n_name") -> DataFrame:
    """One row per line item; `stop` may be a nation (few, long series) or a supplier key."""
    return _lines(spark, folder).select(
        F.to_date("l_shipdate").alias("day"),
        F.col("n_regionkey").cast("string").alias("carrier"),
        F.col("n_nationkey").cast("string").alias("network"),
        F.col("s_suppkey").cast("string").alias("stop_code"),
        F.col("s_suppkey").alias("zone_id"),
        F.col(stop).cast("string").alias("stop"),
        _category().alias("category"),
        F.col("l_quantity").cast("bigint").alias("n"),
    )


def supplier_validations(spark: SparkSession, folder: str) -> DataFrame:
    return validations(spark, folder, "s_suppkey")


def sequenced_validations(spark: SparkSession, folder: str) -> DataFrame:
    """Validations with the surrogate key a database would have given them."""
    return _lines(spark, folder).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.to_date("l_shipdate").alias("day"),
        F.col("n_regionkey").cast("string").alias("carrier"),
        F.col("n_nationkey").cast("string").alias("network"),
        F.col("s_suppkey").cast("string").alias("stop_code"),
        F.col("s_suppkey").alias("zone_id"),
        F.col("n_name").alias("stop"),
        _category().alias("category"),
        F.col("l_quantity").cast("bigint").alias("n"),
    )


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """(day, type) over the days of the data."""
    bounds = table(spark, folder, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("a"), F.to_date(F.max("l_shipdate")).alias("b")
    )
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("day"))
    month, date = F.month("day"), F.dayofmonth("day")
    holiday = F.date_format("day", "MM-dd").isin(
        "01-01", "05-01", "05-08", "07-14", "08-15", "11-01", "11-11", "12-25"
    )
    summer = ((month == 7) & (date >= 5)) | (month == 8)
    return days.select(
        "day",
        F.when(holiday, F.lit("ferie"))
        .when((month == 9) & (date <= 3), F.lit("rentree"))
        .when(summer | ((month == 12) & (date >= 20)), F.lit("vacances"))
        .otherwise(F.lit("normal"))
        .alias("type"),
    )


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw text rows with the faults the loaders must repair, keyed by `seq`."""
    line, price = F.col("l_linenumber"), F.col("l_quantity")
    carrier = F.col("n_regionkey").cast("string")
    count = F.col("l_quantity").cast("bigint").cast("string")
    flag = F.col("l_returnflag")
    return _lines(spark, folder).select(
        (F.col("l_orderkey") * 8 + line).alias("seq"),
        F.when((line == 7) & (price >= 49), F.lit("31/12/1999"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("day"),
        F.when(line == 2, F.concat(carrier, F.lit(".0"))).when(line == 5, F.lit(None)).otherwise(carrier).alias("carrier"),
        F.when(line == 3, F.concat(F.lit(" R"), F.col("n_nationkey").cast("string"), F.lit("\u00a0")))
        .otherwise(F.col("n_nationkey").cast("string"))
        .alias("network"),
        F.when(line == 4, F.concat(F.col("s_suppkey").cast("string"), F.lit("D")))
        .otherwise(F.col("s_suppkey").cast("string"))
        .alias("stop_code"),
        F.when(line == 6, F.lit(None)).otherwise(F.col("s_suppkey").cast("string")).alias("zone_id"),
        F.when(line == 1, F.concat(F.lit("\u00a0 "), F.lower("n_name"), F.lit(" ")))
        .when((line == 2) & (price >= 50), F.lit(None))
        .otherwise(F.col("n_name"))
        .alias("stop"),
        F.when(flag == "N", F.lit(UNDEFINED))
        .when(flag == "A", F.lit("Contrat Solidarite Transport"))
        .otherwise(F.lit("Imagine R "))
        .alias("category"),
        F.when((line == 3) & (price >= 45), F.lit("abc"))
        .when(line == 4, F.concat(count, F.lit(".7")))
        .when((line == 5) & (price < 5), F.concat(F.lit("-"), count))
        .otherwise(count)
        .alias("n"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction requests and observed counts: one per order."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    priority = F.col("o_orderpriority")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("request_id"),
            F.when((priority == "1-URGENT") & (F.col("o_orderstatus") == "P"), F.lit("no such stop"))
            .otherwise(F.concat(F.lit(" "), F.lower("n_name")))
            .alias("stop"),
            F.when((priority == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit(None).cast("date"))
            .otherwise(F.date_add(F.to_date("o_orderdate"), 120))
            .alias("day"),
            (F.floor(F.col("o_totalprice") / 2000) - 5).cast("bigint").alias("n"),
            F.when(priority == "2-HIGH", F.lit("k2"))
            .when(priority == "3-MEDIUM", F.lit("k99"))
            .otherwise(F.lit("k5"))
            .alias("version"),
        )
    )


def event_submissions(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream seen as submitted validation rows."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("day"),
        F.col("user_id").cast("string").alias("stop"),
        F.col("event_type").alias("category"),
        F.lit(1).cast("bigint").alias("n"),
    )


def write_quarter_files(spark: SparkSession, folder: str, target: str) -> dict[str, str]:
    """Submissions as four semicolon files whose columns are in two different orders."""
    rows = submissions(spark, folder)
    quarter = F.quarter(F.coalesce(F.try_to_date("day", "yyyy-MM-dd"), F.lit("1999-12-31").cast("date")))
    names = list(RAW_HEADER)
    swapped = [*names[:4], "LIBELLE_ARRET", "ID_ZDC", *names[6:]]
    renamed = rows.select(quarter.alias("quarter"), *[F.col(b).alias(a) for a, b in RAW_HEADER.items()])
    paths = {}
    for kind, numbers, order in (("plain", (1, 3), names), ("swapped", (2, 4), swapped)):
        write_raw(renamed.where(F.col("quarter").isin(*numbers)).select("quarter", *order), f"{target}/{kind}", "quarter")
        paths.update({f"T{number}": f"{target}/{kind}/quarter={number}" for number in numbers})
    return dict(sorted(paths.items()))
