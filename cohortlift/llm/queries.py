"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, embed_dedup, licenses, line_dedup, merkle, ngram_join, packing, pii, quality, repair, suffix, syncmers


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(_read(spark, sf_dir, "documents"), tokenizer_path())
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    placed = packing.pack(pieces)
    return placed.select("doc_id", F.col("piece").cast("int"), "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats_digest(_read(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_read(spark, sf_dir, "documents")))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_read(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(_read(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select(
        "doc_id", "host", "path", "evidence", "site_probability", "probability", "kept"
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in the directory source/lang."""
    return licenses.scan(_read(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair(repair.damaged(turns), turns)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.report(_read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_pii": op4_pii,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op5_ngram_jaccard_join": ngram_join.join_sql(),
    "op6_line_dedup": line_dedup.dedup_sql(),
    "op9_license_scan": licenses.scan_sql("concat_ws('/', source, lang)"),
    "op10_benchmark_decontamination": decontam.overlaps_sql(),
    "op13_merkle_manifest": merkle.audit_sql(),
}
