"""Registered queries ``opN_<name>`` of this subpackage: each applies one operator with
production parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embedding_dedup, fill_in_middle, html_text, language_id, line_quality, ngram_join, packing, quality_rules, spot_signatures, substring_dedup, token_counts, vector_codes
from .common import table

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Id that ends each packed document.
END_ID = 2


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = bpe.count_documents(docs, BYTE_RANKS, public_tokenizers.PATTERN, keep=[])
    return token_counts.limits(token_counts.length_histogram(counts))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    found = quality_rules.judge(docs)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    content = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.classify(docs.drop("lang"), content)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


def op8_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    model = line_quality.train(docs, labels.where(~language_id.held_out()))
    return line_quality.classify(docs, model).select("doc_id", language_id.held_out().alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"), width=35)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_neighbours(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": vector_codes.sql(), "op12_fill_in_middle": fill_in_middle.SQL, "op13_spot_signatures": spot_signatures.sql()}
