"""Exact order statistics and running totals over a global order.

`percentile` keeps every distinct value of a group in one task. These helpers
first collapse equal values, then cut the value axis at approximate quantiles,
so that no task ever holds more than one slice.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000


def slice_edges(df: DataFrame, column: str, rows: int) -> list[float]:
    """Cut points giving slices of about ROWS_PER_SLICE rows; empty for small data."""
    slices = rows // ROWS_PER_SLICE + 1
    if slices == 1:
        return []
    marks = [i / slices for i in range(1, slices)]
    return sorted(set(df.approxQuantile(column, marks, 1.0 / (4 * slices))))


def with_slice(df: DataFrame, column: str, edges: list[float], name: str = "_slice") -> DataFrame:
    """Number of the slice a value lies in; equal values share a slice."""
    if not edges:
        # NaN sorts last, in a slice of its own.
        return df.withColumn(name, F.when(F.isnan(column), 1.0).otherwise(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df)


def running_totals(df: DataFrame, groups: list[str], column: str, sums: list[str]) -> DataFrame:
    """Per group, add `<s>_before` (total of s over smaller values), `<s>_total` and `next_value`.

    `df` has one row per (groups, column) and a `_slice`. The totals of whole
    slices are a table of one row per group and million rows, joined on the keys by
    which the windows inside a slice are dealt anyway.
    """
    keys = [*groups, "_slice"]
    in_order = Window.partitionBy(*groups).orderBy("_slice")
    ahead = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*groups)
    slices = df.groupBy(*keys).agg(*[F.sum(s).alias(f"{s}_slice") for s in sums], F.min(column).alias("first"))
    slices = slices.select(
        *keys,
        *[F.coalesce(F.sum(f"{s}_slice").over(ahead), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(f"{s}_slice").over(everything).alias(f"{s}_total") for s in sums],
        F.lead("first").over(in_order).alias("next_first"),
    )
    inside = Window.partitionBy(*keys).orderBy(column)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(slices, keys)
    out = out.withColumns(
        {
            "next_value": F.coalesce(F.lead(column).over(inside), F.col("next_first")),
            **{f"{s}_before": F.coalesce(F.sum(s).over(before), F.lit(0)) + F.col(f"{s}_offset") for s in sums},
        }
    )
    return out.drop("next_first", "_slice", *[f"{s}_offset" for s in sums])


def with_slices(counts: DataFrame, column: str = "value") -> DataFrame:
    """Cut collapsed counts at quantiles of their values; one slice when they are few."""
    counts = counts.persist()
    return with_slice(counts, column, slice_edges(counts, column, counts.count()))


def exact_quantiles(df: DataFrame, column: str, shares: list[float], groups: list[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles of a column: (groups, share, value) rows."""
    groups = groups or []
    present = df.where(F.col(column).isNotNull())
    counts = present.groupBy(*groups, F.col(column).cast("double").alias("value")).agg(F.count("*").alias("rows"))
    ranked = running_totals(with_slices(counts), groups, "value", ["rows"])
    share = F.explode(F.array(*[F.lit(float(q)) for q in shares]))
    # A value covers the positions [rows_before, rows_before + rows); only the one
    # or two values covering the wanted position are kept.
    position = F.col("share") * (F.col("rows_total") - 1)
    low, high = F.floor(position), F.ceil(position)

    def covers(p):
        return (F.col("rows_before") <= p) & (p < F.col("rows_before") + F.col("rows"))

    hits = ranked.withColumn("share", share).where(covers(low) | covers(high))
    ends = hits.groupBy(*groups, "share").agg(
        F.max(F.when(covers(low), F.col("value"))).alias("low"),
        F.max(F.when(covers(high), F.col("value"))).alias("high"),
        F.max(position - low).alias("part"),
    )
    return ends.select(*groups, "share", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("value"))


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    row = exact_quantiles(df, column, [share]).first()
    return None if row is None else row["value"]
