"""Pieces that several operators share: table access, batch maps, stored steps, components."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.session import scratch_path

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that a Python worker is handed at a time; by default 10,000 rows are, whatever they hold.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BATCH = 4 << 20
#: For rows of megabytes: Parquet's writer otherwise gathers 100 of them in a page before it looks at their bytes, and 128 MB in a row group.
WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}
VECTORED = "parquet.hadoop.vectored.io.enabled"

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
}


def table(spark: SparkSession, folder: str, name: str, in_parts: bool = False) -> DataFrame:
    """`in_parts`: a column of a row group comes in buffers of 8 MB, by default in one as long as it is, and as much outside the heap."""
    return spark.read.options(**({VECTORED: "false"} if in_parts else {})).parquet(f"{folder}/{name}.parquet")


def map_batches(df: DataFrame, schema: list[tuple[str, str]], start: Callable) -> DataFrame:
    """Rows through Python, an Arrow batch at a time.

    `start()` runs once in each task and returns a function from the batch's
    columns (one list each) to the output's columns (one list each); outputs
    need not have as many rows as inputs.
    """
    fields = pa.schema([(name, ARROW[kind]) for name, kind in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            out = work(*[column.to_pylist() for column in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=field.type) for values, field in zip(out, fields, strict=True)], schema=fields
            )

    return df.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in schema))


def hidden(docs: DataFrame, *used: str) -> tuple[DataFrame, dict[str, Column]]:
    """docs with all columns but those used under names that clash with nothing, and by name what gives them back."""
    inner = [c if c in used else f"_caller_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*inner), {c: F.col(name).alias(c) for c, name in zip(docs.columns, inner, strict=True)}


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> str:
    """Python workers are handed at most SMALL_BATCH bytes at a time from now on, or what the session allows if that is less; gives the old bound."""
    before = spark.conf.get(BATCH_BYTES)
    size, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", before.lower()).groups()
    if int(size) << 10 * "_kmgtp".find(unit or "_") > SMALL_BATCH:
        spark.conf.set(BATCH_BYTES, str(SMALL_BATCH))
    return before


class Stored:
    """A table written to the shared folder, with a way to remove it once it is not needed.

    `small`: Python workers are handed small batches while it is written.
    `wide`: its rows hold megabytes, so bytes of pages and row groups are looked at after every row.
    """

    def __init__(self, df: DataFrame, name: str, small: bool = False, wide: bool = False):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        schema = df.schema
        # The shuffle files that only this write needed go when it ends, not when the driver collects its garbage.
        before = {CLEAN_UP: self.spark.conf.get(CLEAN_UP, "false")}
        self.spark.conf.set(CLEAN_UP, "true")
        if small:
            before[BATCH_BYTES] = small_batches(self.spark)
        try:
            df.write.options(**(WIDE_ROWS if wide else {})).parquet(self.path)
        finally:
            for setting, value in before.items():
                self.spark.conf.set(setting, value)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def remove(self) -> None:
        _remove(self.spark, self.path)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b long): component is the smallest node reachable.

    Alternating large-star and small-star steps, each two equi-joins and
    combining aggregations; the edge set of each round is written to the
    shared folder. A hub's edges are never gathered: its minimum is a combined
    aggregate and the join on it may be split by adaptive execution.
    """
    current = Stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        e = current.df
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Each neighbour larger than the node is linked to the smallest of its neighbourhood.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(down.select("a", F.col("m").alias("b")))
        following = Stored(small.distinct(), "edges")
        current.remove()
        current = following
        now = current.df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError("components have not converged")
    stars = current.df
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
