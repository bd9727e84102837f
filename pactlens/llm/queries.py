"""Named queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm import (
    bpe, exact, langid, licences, linkgraph, neardup, negatives, packing, phrases, ppm, quality, substring,
)
from pactlens.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted_languages(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = exact.exact_copies(table(spark, sf_dir, "documents"))
    return copies.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sequence; the id and position rows are given by their checksums."""
    return packing.packed_sequences(table(spark, sf_dir, "documents")).select(
        "sequence_id",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
        "cu_seqlens",
        "segments",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_report(table(spark, sf_dir, "documents"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judged_urls(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scored(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_language_id,
        op3_byte_bpe,
        op4_exact_dedup,
        op5_license_scan,
        op6_packed_matrices,
        op7_substring_dedup,
        op8_minhash_dedup,
        op9_best_fit_packing,
        op10_url_filter,
        op11_hard_negatives,
        op12_collocations,
        op13_lm_scores,
    )
}

#: Counterparts in DuckDB where SQL can say it and is quick enough over whole tables.
ORACLE = {
    "op5_license_scan": licences.oracle_sql(),
    "op11_hard_negatives": negatives.oracle_sql(),
    "op12_collocations": phrases.oracle_sql(),
    "op4_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)
    """,
}
