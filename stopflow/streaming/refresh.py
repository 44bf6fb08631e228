"""Submitted rows as a file stream: validate, deduplicate, append, refresh features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stopflow.operators.cleaning import accepted, rejected, with_reason
from stopflow.operators.features import CODES, features_of_days, stop_day
from stopflow.session import materialize, remove_table


def submitted_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else None


def _unseen(batch: DataFrame, path: str, number: int, key: list[str], days: list) -> DataFrame:
    """Rows whose key is in no other batch of the stored table; only folders of the batch's own days are read."""
    spark = batch.sparkSession
    stored = _read(spark, path, StructType([*batch.schema.fields, StructField("batch", LongType())]))
    if stored is None:
        return batch
    known = [day for day in days if day is not None]
    same = F.col("day").isin(known) if known else F.lit(False)
    other = stored.where((same | F.col("day").isNull()) if None in days else same).where(F.col("batch") != number)
    # An unreadable day is part of the key like any other.
    mine, theirs = batch.alias("mine"), other.select("day", *[c for c in key if c != "day"]).alias("theirs")
    equal = [F.col(f"mine.{c}").eqNullSafe(F.col(f"theirs.{c}")) for c in ["day", *[c for c in key if c != "day"]]]
    return mine.join(theirs, reduce(Column.__and__, equal), "left_anti")


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that rows have, replacing what these held and nothing else; a hot one is split over tasks."""
    dealt = rows.hint("rebalance", *[F.col(p) for p in partitions])
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


class FeatureStore:
    """The feature table kept up to date with the stops that batches touch.

    `days` holds what each batch adds to a (stop, day), `features` the result, both
    in folders by a hash of the stop. Sums and smallest codes of batches combine to
    those of all rows, so a batch costs the history of its stops' folders at stop-day
    grain, not a scan of raw rows; lags, medians and maxima of a stop depend on that
    stop alone. A repeated batch replaces its own share.
    """

    def __init__(self, root: str, calendar: DataFrame | None, codes: DataFrame, folders: int = 64):
        self.days, self.features = f"{root}/days", f"{root}/features"
        self.calendar, self.codes, self.folders = calendar, codes, folders

    def take_in(self, rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        folder = F.pmod(F.xxhash64("stop"), F.lit(self.folders)).alias("folder")
        share = stop_day(rows).select("*", folder, F.lit(number).cast("long").alias("batch")).persist()
        touched = [r["folder"] for r in share.select("folder").distinct().collect()]
        if touched:
            _replace(share, self.days, "folder", "batch")
            history = _read(spark, self.days, share.schema).where(F.col("folder").isin(touched))
            daily = history.groupBy("folder", "stop", "day").agg(F.sum("n").alias("n"), *[F.min(c).alias(c) for c in CODES])
            _replace(features_of_days(daily, self.calendar, self.codes), self.features, "folder")
        share.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.features).drop("folder")


def run_refresh(stream: DataFrame, table: str, quarantine: str, checkpoint: str, key: list[str], store: FeatureStore | None = None) -> None:
    """Take in everything available, then stop.

    A row goes to the table or to the quarantine once, by its key and day, however
    late it comes: it is compared with what is stored of its day, not with a
    watermark. Output is written under its day and batch number, so a batch
    repeated after a failure replaces its own output instead of adding to it.
    `store` is brought up to date with the accepted rows of each batch.
    """

    def take_in(batch: DataFrame, number: int) -> None:
        # Written, not cached: writing to a table drops whatever was cached from reading it.
        unique = materialize(batch.dropDuplicates(list(dict.fromkeys(["day", *key]))), "batch")
        days = [r["day"] for r in unique.select("day").distinct().collect()]  # as many as the calendar has, at most
        new = unique
        for path in (table, quarantine):
            new = _unseen(new, path, number, key, days)
        checked = materialize(with_reason(new).withColumn("batch", F.lit(number).cast("long")), "checked")
        _replace(accepted(checked), table, "day", "batch")
        _replace(rejected(checked), quarantine, "day", "batch")
        if store is not None:
            store.take_in(accepted(checked), number)
        for staged in (unique, checked):
            remove_table(staged)

    query = (
        stream.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
