"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import oracles
from shelfwise.llm.centroids import cluster_vectors
from shelfwise.llm.embeddings import near_vectors
from shelfwise.llm.exact import exact_copies
from shelfwise.llm.language import languages
from shelfwise.llm.lines import near_lines
from shelfwise.llm.merkle import manifest
from shelfwise.llm.minhash import near_copies
from shelfwise.llm.mixing import mix
from shelfwise.llm.packing import pack
from shelfwise.llm.quality import graded_documents
from shelfwise.llm.substrings import remove_repeats
from shelfwise.llm.suffixes import remove_repeated_bytes
from shelfwise.llm.tokencount import count_documents
from shelfwise.session import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = near_lines(_table(spark, sf_dir, "documents"))
    return lines.withColumn("line_sha256", F.sha2("line", 256)).drop("line")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(_table(spark, sf_dir, "documents")).drop("begins", "ends")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(_table(spark, sf_dir, "documents"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_documents(_table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(_table(spark, sf_dir, "documents"), tampered)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository; it imports this package in turn

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_token_counts, op3_embedding_near_dedup, op4_source_mixing, op5_minhash_near_dedup, op6_line_dedup, op7_substring_dedup, op8_quality_classifier, op9_suffix_array_dedup, op10_exact_dedup, op11_language_id, op12_centroid_clustering, op13_merkle_manifest, pipeline)}

ORACLE_SQL = {
    "op4_source_mixing": oracles.MIX,
    "op10_exact_dedup": oracles.EXACT_COPIES,
    "op12_centroid_clustering": oracles.CLUSTERS,
    "op13_merkle_manifest": oracles.MANIFEST,
}
