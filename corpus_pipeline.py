"""Corpus pipeline over ``documents``: language, repeated lines, near duplicates, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its result is written as Parquet in the shared scratch folder
and read back.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, decontam, langid, line_dedup, minhash
from ledgerline.llm.common import stored, table

LEAST_SCORE = 0.5
SIMILAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or a likely language go.

    Null and empty texts have no letters.  Each row is judged by its own text, so repeated rows stay or go together;
    equally likely languages go to the first by name.
    """
    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.keep_recognised(docs, model, LEAST_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated three-line passages; ``n_chars`` follows the text.

    The first occurrence, by document id and place, keeps its lines; rows equal in id and text are one occurrence
    and are treated alike.
    """
    return line_dedup.rewrite(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Null ids come last, equal ids are told apart by a hash of the text; documents without words all stay.
    """
    return minhash.keep_one(docs, SIMILAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text; items of fewer than five words count where exactly their words stand.
    """
    return decontam.without_passages(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token ids (little-endian 32-bit) of each document, and a digest of their decoded text.

    One row per row; a null text has no ids.
    """
    return bpe.encode_and_check(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

# Language probabilities and near-duplicate groups over several stages are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
