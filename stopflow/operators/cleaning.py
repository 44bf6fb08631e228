"""Cleaning, validation, stacking, deduplication and load checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopflow.config import CATEGORIES, CATEGORY_FIXES, SUBMISSION_DEFAULTS, UNDEFINED, VALIDATIONS
from stopflow.functions import text

CODES = ["carrier", "network", "stop_code"]
KEY = ["day", "stop", "category"]


def parse_day(c: Column, strict: bool = False) -> Column:
    """ISO dates only. Strict parsing raises; otherwise a bad date is NULL and can be set aside."""
    if strict:
        return F.to_date(c, "yyyy-MM-dd")
    return F.regexp_extract(text.strip(c), r"^\d{4}-\d{2}-\d{2}$", 0).try_cast("date")


def fix_category(c: Column) -> Column:
    fixed = c
    for wrong, right in CATEGORY_FIXES.items():
        fixed = F.when(fixed == wrong, F.lit(right)).otherwise(fixed)
    return fixed


def clean_rows(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed validations from text columns; extra columns are kept."""
    columns = {
        "day": parse_day(F.col("day"), strict),
        **{c: text.code(F.col(c)) for c in CODES},
        "zone_id": text.count_or_zero(F.col("zone_id")),
        "stop": text.strip(F.col("stop")),
        "category": fix_category(text.strip(F.col("category"))),
        "n": text.count_or_zero(F.col("n")),
    }
    return raw.withColumns(columns)


def corrected_categories(raw: DataFrame) -> DataFrame:
    """Rows whose category text is replaced, per wrong spelling."""
    wrong = text.strip(F.col("category"))
    return raw.where(wrong.isin(list(CATEGORY_FIXES))).groupBy(wrong.alias("category")).agg(F.count("*").alias("rows"))


def usable(rows: DataFrame) -> DataFrame:
    """Rows with a day, a stop and a category; the others belong in quarantine."""
    return rows.where(F.col("day").isNotNull() & F.col("stop").isNotNull() & F.col("category").isNotNull())


def with_reason(rows: DataFrame) -> DataFrame:
    """Add `reason`: why a submitted row is rejected, NULL when it is valid."""
    return rows.withColumn(
        "reason",
        F.when(F.col("day").isNull(), F.lit("day missing or malformed"))
        .when(F.coalesce("stop", F.lit("")) == "", F.lit("stop missing"))
        .when(F.coalesce("category", F.lit("")) == "", F.lit("category missing"))
        .when(F.col("n").isNull(), F.lit("count missing or not a number"))
        .when(F.col("n") < 0, F.lit("count negative")),
    )


def submitted_rows(raw: DataFrame) -> DataFrame:
    """Submitted text rows typed without repair, defaults filled in, with `reason`.

    Unlike a bulk load, an unreadable count is a reason to reject, not a zero.
    """
    defaults = SUBMISSION_DEFAULTS
    typed = raw.withColumns(
        {
            "day": parse_day(F.col("day")),
            **{c: F.coalesce(text.strip(F.col(c)), F.lit(defaults[c])) for c in CODES},
            "zone_id": F.coalesce(text.number(F.col("zone_id")).try_cast("bigint"), F.lit(defaults["zone_id"]).cast("bigint")),
            "stop": text.stop_name(F.col("stop")),
            "category": text.strip(F.col("category")),
            "n": text.number(F.col("n")).try_cast("bigint"),
        }
    )
    return with_reason(typed)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNull()).drop("reason")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reason").isNotNull())


def request_reasons(requests: DataFrame, versions: tuple[str, ...] = ("k2", "k5")) -> DataFrame:
    """Reasons to refuse a prediction request."""
    return requests.withColumn(
        "reason",
        F.when(F.col("stop").isNull(), F.lit("stop missing"))
        .when(F.col("day").isNull(), F.lit("day missing"))
        .when(F.col("n") < 0, F.lit("count negative"))
        .when(~F.col("version").isin(*versions), F.lit("unknown version")),
    )


def flag_defined(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_defined", F.col("category") != UNDEFINED)


def filter_defined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("category") != UNDEFINED)


def stop_period(rows: DataFrame, stop: str, first: str, last: str) -> DataFrame:
    """One stop between two days, both included; both predicates reach the file scan."""
    return rows.where((F.col("stop") == stop) & F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def project(rows: DataFrame) -> DataFrame:
    return rows.select(*VALIDATIONS.fieldNames())


def keep_first(rows: DataFrame, order: list[str], keys: list[str] = KEY) -> DataFrame:
    """First row of each key in a total order, with the size and volume of its group.

    Written as a minimum over structs instead of a row number: the minimum is
    combined before the shuffle, so a key holding a third of all rows sends one
    row per task.
    """
    payload = [c for c in rows.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *payload)).alias("first")
    grouped = rows.groupBy(*keys).agg(first, F.count("*").alias("copies"), F.sum("n").alias("volume"))
    return grouped.select(*keys, "first.*", "copies", "volume")


def deduplicate(rows: DataFrame, order: list[str]) -> DataFrame:
    return keep_first(rows, order).select(*rows.columns)


def dedup_report(rows: DataFrame, order: list[str]) -> DataFrame:
    """How many rows and how much volume deduplication drops."""
    kept = keep_first(rows, order)
    return kept.agg(
        F.sum("copies").alias("rows_read"),
        F.count("*").alias("rows_kept"),
        F.sum(F.col("copies") - 1).alias("rows_dropped"),
        F.sum(F.col("volume") - F.col("n")).alias("volume_dropped"),
    )


def sort_load(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows by day and stop, then in a total order.

    The range sort also cuts inside a hot (day, stop), because the rest of the
    order takes part in the ranges. `deduplicate` does not need it.
    """
    return rows.orderBy("day", "stop", *order)


def stack(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of the named parts, matched by column name."""
    named = [df.withColumn("source", F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def verify_load(rows: DataFrame, expected_rows: int | None = None, days: int = 365) -> DataFrame:
    """Counts, bounds and whether they match the expectation (7 categories, a full year)."""
    summary = rows.agg(
        F.count("*").alias("rows"),
        F.countDistinct("day").alias("days"),
        F.countDistinct("stop").alias("stops"),
        F.countDistinct("category").alias("categories"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )
    checks = {
        "categories_ok": F.col("categories") == len(CATEGORIES),
        "days_ok": F.col("days") == days,
        "rows_ok": F.lit(True) if expected_rows is None else F.col("rows") == expected_rows,
    }
    return summary.withColumns(checks)


def latest_rows(rows: DataFrame, k: int = 10) -> DataFrame:
    """Newest rows by surrogate key, ties broken by the remaining columns."""
    rest = [c for c in rows.columns if c != "seq"]
    return rows.orderBy(F.desc("seq"), *rest).limit(k)


def null_profile(rows: DataFrame) -> DataFrame:
    """(column, nulls, percent) from a single pass."""
    counts = rows.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in rows.columns])
    long = counts.unpivot(["_rows"], rows.columns, "column", "nulls")
    share = F.round(F.try_divide(F.col("nulls") * 100.0, F.col("_rows")), 2)
    return long.select("column", "nulls", F.coalesce(share, F.lit(0.0)).alias("percent"))


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """Number of rows equal to an earlier row on every column."""
    groups = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def dataset_inventory(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows, days, bounds and months of each named dataset."""
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.count("*").alias("rows"),
            F.countDistinct("day").alias("days"),
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.array_join(F.array_sort(F.collect_set(F.month("day"))), ",").alias("months"),
        )
        for name, df in datasets.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
