"""The operators of this subpackage over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (centroids, classifier, html, licenses, linededup, mixing, oracle, packing, quality, simhash,
                          suffix, topk, units, whitening)
from tidewell.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.fp_hex(F.col("fp")).alias("fingerprint"), "component_id",
                        "component_size")


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(max_repeats=mixing.MAX_REPEATS))
    return mixed.select("row.doc_id", "row.source", "n_tokens", "epoch", "block", "ord", "weight", "alpha")


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "n_lines", "n_exclaims", "failures")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % topk.EVERY == 0)
    return topk.top_k(vectors, queries, topk.K).select(
        "query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").cast("int").alias("distance"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "n_lines", "n_dropped", "text")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.dedup(table(spark, sf_dir, "documents"), min_bytes=units.MIN_BYTES).select(
        "row.doc_id", "n_units", "n_removed", "removed", "text")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        centroids.digest_col().alias("centroid_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = [op1_simhash_near_dedup, op2_temperature_mixing, op3_html_consensus, op4_quality_ledger, op5_exact_topk,
           op6_best_fit_packing, op7_line_dedup, op8_license_scan, op9_suffix_dedup, op10_substring_dedup,
           op11_quality_classifier, op12_embedding_whitening, op13_centroid_clustering]
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
