"""Writers: features, appended rows, reloads and training-run metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.config import PUBLISHED_FEATURE_NAMES


def write_features(features: DataFrame, path: str) -> None:
    """Partitioned by year and month, sorted by stop so that row groups prune on it."""
    (
        features.repartition("year", "month", F.pmod(F.xxhash64("stop"), F.lit(16)))
        .sortWithinPartitions("year", "month", "stop", "day")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(path)
    )


def publish_features(features: DataFrame, path: str) -> None:
    """The same table under its published column names."""
    write_columns = [F.col(a).alias(b) for a, b in PUBLISHED_FEATURE_NAMES.items()]
    features.select(*write_columns).write.mode("overwrite").parquet(path)


def write_raw(rows: DataFrame, path: str, *folders: str) -> None:
    """Semicolon text with a header, spaces kept as they are, in folders by the given columns."""
    rows.write.partitionBy(*folders).csv(path, sep=";", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_jdbc(rows: DataFrame, url: str, table: str, batch: int = 10_000, **options) -> None:
    """Database append in lots of `batch` rows."""
    rows.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch), **options})


def reload_table(rows: DataFrame, root: str) -> str:
    """Replace a table by a complete new version and return its path.

    Readers of the previous version are not disturbed, and a failed load leaves
    it as it was: the new path is only returned after the write has finished.
    """
    version = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(version)
    return version


def run_metrics(spark: SparkSession, run: str, model: str, params: dict, metrics: dict) -> DataFrame:
    """Long table (run, model, kind, name, value) describing one training run."""
    rows = [(run, model, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, model, "metric", k, str(float(v))) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run string, model string, kind string, name string, value string")


def append_run(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("append").parquet(path)
