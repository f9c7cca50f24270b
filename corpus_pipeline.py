"""The corpus pipeline: quality rules, near-dedup, pseudonyms, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept and gives a DataFrame; the driver writes it
and reads it again for the next stage. All but the last give the columns of documents, extra ones included, and read doc_id, text
and source alone.

Defined results: a null, empty or wordless text has too few words and goes in the first stage, very long ones are judged, compared
and encoded whole; of near copies and equal rows one row stays, rows that share an id and differ in text all stay, as do rows
without an id; a null source is a source of its own in the mix; ties are settled by each operator's own order; an empty table
gives an empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import minhash, mixing, pii, quality, sentencepiece_bpe
from millrace.llm.queries import tokenizer_path
from millrace.sources.tables import scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.quality_filter(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words to a shingle, similarity 0.8 or more."""
    return minhash.keep_one(docs, k=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms for personal data and secrets."""
    return pii.pseudonymize(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the text decoded from them, for every copy."""
    return sentencepiece_bpe.encode_digests(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_dedup", dedup_stage),
    ("pii_pseudonyms", pii_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

#: SQL can't express the pseudonyms and the encoding; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. What a stage wrote on its way goes when its rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = table(stage(spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
