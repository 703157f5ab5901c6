"""Corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of ``documents``. Rows with a null text count as empty texts; an
empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.llm import language_id, line_quality, ngram_join, packing, substring_dedup
from newsweave.llm.common import table
from newsweave.llm.queries import END_ID, WORD_TOKENIZER
from newsweave.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier predicts to be of quality 1, by labels outside the
    held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = line_quality.train(docs, labels.where(~language_id.held_out()))
    return line_quality.classify(docs, model).where("predicted = 1").select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; what the classifier rejects goes."""
    content = language_id.train(docs.where(~language_id.held_out()))
    return language_id.classify(docs, content).where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8), the one
    with the smallest id; documents without words or id are groups of their own."""
    found = ngram_join.near_duplicates(docs, k=5, percent=80)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 35 or more words that occur more than once."""
    return substring_dedup.remove(docs, width=35).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, in sequences of at most 4096."""
    return packing.pack(docs, WORD_TOKENIZER, END_ID)


STAGES = [("quality classifier", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates),
          ("substring dedup", substrings), ("packing", packed)]

#: Trained models and a tokenizer take part, so SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is a Parquet table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    top = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
    return docs
