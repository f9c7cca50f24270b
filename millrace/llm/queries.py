"""Queries of the numbered operators, each over its whole table with production parameters, and SQL where SQL can express them."""

from __future__ import annotations

import importlib
import os

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chunks, filter_audit, langid, license_scan, minhash, mixing, packing, pii, quality, sentencepiece_bpe, sharding, whitening


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file: under MILLRACE_TOKENIZERS if set, else where the installed package has it."""
    folder = os.environ.get("MILLRACE_TOKENIZERS")
    return f"{folder}/{name}" if folder else importlib.import_module("public_tokenizers").path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = importlib.import_module("public_tokenizers")
    # id 50256 is this vocabulary's free end id
    return packing.packed_documents(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN, 50256, how=packing.pack_binary)


QUERIES = {
    "op1_quality_rules": lambda spark, d: quality.quality_report(documents(spark, d)),
    "op2_license_scan": lambda spark, d: license_scan.license_scan(documents(spark, d)),
    "op3_language_id": lambda spark, d: langid.language_id(documents(spark, d)),
    "op4_token_packing": packed,
    "op5_sentencepiece": lambda spark, d: sentencepiece_bpe.encode_digests(documents(spark, d), tokenizer_path("piece_bpe_32k.model")),
    "op6_minhash_dedup": lambda spark, d: minhash.near_duplicates(documents(spark, d), k=3, percent=85),
    "op7_pii_pseudonyms": lambda spark, d: pii.pii_report(documents(spark, d)),
    "op8_fingerprints": lambda spark, d: chunks.neighbour_fingerprints(documents(spark, d)),
    "op9_mixing": lambda spark, d: mixing.mix_report(documents(spark, d)),
    "op10_sharding": lambda spark, d: sharding.shard_report(documents(spark, d)),
    "op11_byte_bpe": lambda spark, d: byte_bpe.encode_report(documents(spark, d), tokenizer_path("byte_bpe_50k.json")),
    "op12_filter_audit": lambda spark, d: filter_audit.filter_audit(documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")),
    "op13_whitening": lambda spark, d: whitening.whiten(spark.read.parquet(f"{d}/embeddings.parquet")),
    # the parts of results that SQL can say
    "base_license_places": lambda spark, d: license_scan.license_scan(documents(spark, d)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"),
    "base_edited_texts": lambda spark, d: chunks.neighbour_fingerprints(documents(spark, d)).select("doc_id", "n_chars", "edited_sha256"),
}

ORACLE_SQL = {
    "base_license_places": license_scan.BASE_SQL, "base_edited_texts": chunks.EDITED_SQL, "op10_sharding": sharding.ORACLE_SQL,
    "op1_quality_rules": quality.ORACLE_SQL, "op6_minhash_dedup": minhash.ORACLE_SQL, "op9_mixing": mixing.ORACLE_SQL, "op12_filter_audit": filter_audit.ORACLE_SQL,
}
