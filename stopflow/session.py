"""Session defaults, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a generated method beyond which HotSpot interprets it; Spark's own bound is eight times as high.
COMPILED = "8000"
HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


def build_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stopflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application.

    Stages whose generated code would never be compiled run operator by operator, unless the session says otherwise.
    """
    if spark.conf.get(HUGE_METHOD, "65535") == "65535":
        spark.conf.set(HUGE_METHOD, COMPILED)
    context = spark.sparkContext
    if not getattr(context, "_stopflow_shipped", False):
        package = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="stopflow-package-")) / "stopflow"
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        context._stopflow_shipped = True
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; in local mode, when none is named, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="stopflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/stopflow/{uuid.uuid4().hex}/{name}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that is not needed any more, wherever it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage by writing to the shared folder, so lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(schema).parquet(path)
    stored._stopflow_path = path
    return stored


def remove_table(stored: DataFrame) -> None:
    """Remove what `materialize` wrote, once nothing reads it any more."""
    remove_path(stored.sparkSession, stored._stopflow_path)


def spread(df: DataFrame) -> DataFrame:
    """A stored table read in few pieces, redistributed so that training uses every core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def renewed(df: DataFrame) -> DataFrame:
    """The same columns under new identities, so that a table can be cogrouped with one derived from it."""
    return df.toDF(*df.columns)


def join_lookup(
    rows: DataFrame, lookup: DataFrame, keys: str | list[str], how: str = "left", max_rows: int = 200_000
) -> DataFrame:
    """Join rows to a table holding one row per key, whatever the size and skew.

    The lookup is broadcast only once counted to be within `max_rows`. Beyond
    that both sides are dealt by the keys; the partition of a hot key is split
    by adaptive execution on the side of the rows, and only the lookup's rows of
    that partition are read more than once.
    """
    keys = [keys] if isinstance(keys, str) else keys
    lookup = lookup.persist()
    if lookup.count() <= max_rows:
        return rows.join(F.broadcast(lookup), keys, how)
    return rows.join(lookup.hint("merge"), keys, how)
