"""Ranks over a whole table without ordering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopflow.session import materialize


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add `name`: 0, 1, ... by `order`, which must not tie.

    Rows are dealt by ranges of the order; what is added up afterwards is one
    number per range, so its join is a broadcast of as many rows as partitions.
    """
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges"
    ).withColumn("_range", F.shiftright("_at", 33))
    sizes = placed.groupBy("_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = F.coalesce(F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", (earlier - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")
