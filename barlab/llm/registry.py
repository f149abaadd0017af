"""The corpus queries and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import (
    collocations, conversation_trie, decontamination, license_scan, license_templates, line_dedup, oracles, pii, quality_classifier, quality_rules, secret_scan,
    sentencepiece_codec, simhash, token_files, vector_search,
)
from barlab.llm.common import table
from barlab.session import shared_folder

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir), license_templates.TEMPLATES)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a host here, and the documents of one language under it are a path."""
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaned texts by digest, and what was removed from each."""
    found = line_dedup.dedup_passages(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
        "n_chunks_removed", "n_lines_removed",
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(documents(spark, sf_dir))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_verdicts(documents(spark, sf_dir))
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_report(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/barlab/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(documents(spark, sf_dir), path, WORD_VOCABULARY, end_id=1)
    return token_files.with_checksums(token_files.read_tokens(spark, path))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepiece_codec.encode_decode(documents(spark, sf_dir), PIECE_MODEL)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fixed patterns find; the whole result is ``op5_secret_scan``."""
    return op5_secret_scan(spark, sf_dir).drop("spans")


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fixed patterns find; the whole result is ``op8_pii``."""
    return op8_pii(spark, sf_dir).drop("spans")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and base tests; the whole result is ``op7_quality_rules``."""
    return op7_quality_rules(spark, sf_dir).drop("kept")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_line_dedup": op4_line_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii": op8_pii,
    "op9_token_files": op9_token_files,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_collocations": op11_collocations,
    "op12_top_products": op12_top_products,
    "op13_conversation_trie": op13_conversation_trie,
    "secret_base": secret_base,
    "pii_base": pii_base,
    "quality_base": quality_base,
}
ORACLES: dict[str, str] = {
    "op2_decontamination": decontamination.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_top_products": vector_search.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
    "secret_base": oracles.SECRETS,
    "pii_base": oracles.PERSONAL,
    "quality_base": oracles.COUNTS,
}
