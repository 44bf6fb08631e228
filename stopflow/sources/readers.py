"""Reading raw files, tables, features and the calendar."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stopflow.config import CALENDAR_FILE, HOLIDAY, RAW_HEADER, VACATION_TYPES
from stopflow.functions import text


class MissingColumns(ValueError):
    """A raw file lacks required columns."""


def read_raw_file(spark: SparkSession, path: str) -> DataFrame:
    """One semicolon file as text columns, selected by header name.

    Files differ in column order, so each is read alone: reading several at once
    maps columns by position. Header names are trimmed before the check.
    """
    df = spark.read.csv(path, sep=";", header=True, encoding="UTF-8")
    df = df.toDF(*[name.lstrip("﻿").strip() for name in df.columns])
    missing = [name for name in RAW_HEADER if name not in df.columns]
    if missing:
        raise MissingColumns(f"{path}: {missing}")
    return df.select(*[F.col(raw).alias(name) for raw, name in RAW_HEADER.items()])


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The trimmed column names of a file, or of every file of a folder: one line of each is read, without a job."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for status in files.globStatus(root):
        inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        for file in inside:
            if file.isDirectory() or file.getPath().getName().startswith(("_", ".")):
                continue
            codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
            codec, stream = codecs.getCodec(file.getPath()), files.open(file.getPath())
            stream = codec.createInputStream(stream) if codec else stream
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
            reader.close()
            if line is not None:
                out[file.getPath().toString()] = [name.strip().strip('"').strip() for name in line.lstrip("\ufeff").split(";")]
    return out


def read_raw_files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Named raw files stacked by column name, with the name kept in `source`.

    Files are grouped by the order of their columns, and each order (one or two,
    as a rule) is one scan of all its files with the columns named beforehand;
    the path that Spark keeps with each row tells the source.
    """
    orders: dict[tuple, dict[str, str]] = {}
    for source, path in paths.items():
        for file, names in _headers(spark, path).items():
            missing = [name for name in RAW_HEADER if name not in names]
            if missing:
                raise MissingColumns(f"{file}: {missing}")
            orders.setdefault(tuple(names), {})[file] = source
    scans = []
    for names, files in orders.items():
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        rows = spark.read.csv(list(files), schema=schema, sep=";", header=True, encoding="UTF-8")
        folders: dict[str, list[str]] = {}
        for file, source in files.items():
            folders.setdefault(source, []).append(file)
        place = F.url_decode(F.regexp_replace("_metadata.file_path", "^[a-z0-9]+:/+", "/"))
        source = F.coalesce(*[F.when(place.isin([_plain_path(f) for f in found]), F.lit(name)) for name, found in folders.items()])
        picked = [F.col(f"c{names.index(raw)}").alias(name) for raw, name in RAW_HEADER.items()]
        scans.append(rows.select(*picked, source.alias("source")))
    return reduce(DataFrame.unionByName, scans)


def _plain_path(path: str) -> str:
    """A path without scheme and host's slashes, as rows tell it."""
    return re.sub("^[a-z0-9]+:/+", "/", path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, lower: str, upper: str, partitions: int, **options) -> DataFrame:
    """Database scan split by day ranges, so that no single task reads the table."""
    return spark.read.jdbc(
        url,
        table,
        column="JOUR",
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature table; readers that need an order sort by (stop, day) themselves."""
    return spark.read.parquet(path).withColumn("day", F.to_date("day"))


def calendar_days(days: DataFrame) -> DataFrame:
    """(day, type) to one row per day with the two flags."""
    return days.groupBy("day").agg(
        F.max(F.col("type") == HOLIDAY).alias("is_holiday"),
        F.max(F.col("type").isin(VACATION_TYPES)).alias("is_vacation"),
    )


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True, schema=CALENDAR_FILE, sep=",", encoding="UTF-8")
    return rows.select(
        F.to_date(text.strip(F.col("date")), "yyyy-MM-dd").alias("day"),
        text.strip(F.col("type")).alias("type"),
        "description",
    )
