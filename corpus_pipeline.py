"""A training-data pipeline over `documents`: classify, deduplicate, redact, pack.

Each stage reads what its predecessor kept and writes it as Parquet; all but the
last return the columns of `documents`, whatever else is among them. A null text
scores like an empty one, becomes empty where lines are taken out, and is packed
as one piece of one token; repeated rows stay until near copies go, of which the
row of the smallest id stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.llm import line_dedup, ngram_join, packing, pii, quality
from stopflow.llm.common import Stored, small_batches, table


def _counted(docs: DataFrame) -> DataFrame:
    """docs with n_chars, where there is such a column, following the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    From this stage on, Python workers of the caller's session are handed small batches.
    """
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go from all of them."""
    return _counted(line_dedup.without_frequent_lines(docs))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, one per group stays: that of the smallest id."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the names of their kinds."""
    return _counted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences of 2048."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_common_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("PII", redact),
    ("best-fit packing", pack),
]

#: SQL can express neither the classifier nor the packing; tests compare every stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        stored = Stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        if before is not None:
            before.remove()
        docs, before = stored.df, stored
    return docs
