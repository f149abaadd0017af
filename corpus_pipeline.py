"""The corpus pipeline: from raw documents to token ids.

``STAGES`` are functions of (spark, docs, sf_dir); each reads what the one before it has kept, written as
Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import decontamination, line_dedup, quality_rules, sentencepiece_codec, simhash
from barlab.llm.common import table
from barlab.llm.registry import PIECE_MODEL
from barlab.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of lines stay at their first occurrence only."""
    return line_dedup.dedup_passages(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    found = sentencepiece_codec.encode_decode(docs, PIECE_MODEL)
    return found.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SimHash, the voters' estimation and SentencePiece have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None
