"""The corpus pipeline: documents to token digests, one operator of ``courtside.llm`` per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again before the next one. All but the last return the
columns of ``documents``. An empty table passes through every stage; a stage
without its reference data (labels, benchmark) keeps everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import langid
from courtside.llm.common import crc_mod, stored, table
from courtside.llm.lsa_decontam import without_leaks
from courtside.llm.queries import piece_model
from courtside.llm.sentencepiece_codec import codec_digests
from courtside.llm.simhash_dedup import keep_one
from courtside.llm.suffix_dedup import without_repeated_bytes


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language stay; those without a letter, or below the calibrated bound, go."""
    return langid.accepted_rows(docs, langid.train(docs, crc_mod(F.col("doc_id"), 4) != 2))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 4-word-shingle fingerprints linked within 4 bits stays."""
    return keep_one(docs, 4, 4)


REPEAT_BYTES = 250  # a passage of 50 words, spaces counted


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of REPEAT_BYTES that also start elsewhere are cut out; every document stays with its rest."""
    return without_repeated_bytes(docs, REPEAT_BYTES)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, decoded text and source spans of what is left, as digests."""
    return codec_digests(docs, piece_model())


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_codec", sentencepiece_codec),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
