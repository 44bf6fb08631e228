"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopflow.llm import bpe, cap_filters, line_dedup, merkle, ngram_join, oracle, packing, periodic_runs, pii, quality, suffix_dedup, suffix_shards, token_counts, topk
from stopflow.llm.common import table


def op1_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.link_vectors(table(spark, folder, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    counts = [pii.of_kind("_base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.spelled("_base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.spelled("_spans").alias("spans"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, folder, "documents"), keep_bytes=False)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = line_dedup.drop_frequent_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


def op7_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = topk.scaled(table(spark, folder, "embeddings"))
    return topk.exact_topk(rows, rows.where("vec_id % 100 = 0"))


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, folder, "documents"), alter=periodic_runs.planted)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    length, start, period = longest["length"], -longest["col2"], -longest["col3"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    without_breaks = merkle.leaf_digest(text=F.replace("text", F.lit("\n"), F.lit("")))
    proofs = merkle.manifest(table(spark, folder, "documents"), F.when(tampered, without_breaks))
    siblings = F.sha2(merkle.siblings(F.col("before"), F.col("after")).cast("binary"), 256)
    found = merkle.folded(F.coalesce("changed", "leaf"), F.col("before"), F.col("after"))
    done = proofs.select("doc_id", "leaf", "subroot", "root", siblings.alias("proof_sha256"), found.alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_shards.find_benchmark(table(spark, folder, "documents", in_parts=True), table(spark, folder, "benchmark"))
    hit = suffix_shards.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


QUERIES = {
    name: query
    for name, query in sorted(globals().items(), key=lambda item: item[0])
    if name.startswith("op") and callable(query)
}
SQL: dict[str, str] = oracle.QUERIES
