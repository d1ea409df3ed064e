"""The corpus pipeline: stages over ``documents``, each one written and read by the next.

language: texts in no learned language (or without a letter) go; the model learns
from the stage's own input. lines: repeated runs of lines are cut out. near_copies:
one document of each group of near duplicates (five-word shingles, Jaccard similarity
of 0.8 or more) stays, the one with the smallest id.
substrings: strings of 400 bytes and
passages of 51 words that occur elsewhere are cut out. pack: what is
left becomes windows of tokens. Documents left without a word go; ``n_chars``
follows the text. Clean documents pass every stage unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import frames, language, lines, nearcopies, packing, suffixes

#: Passages of over 50 words are cut out if they occur elsewhere.
PASSAGE_WORDS = 51
WORD = "[^\\x20\\x09-\\x0D]"


def _tidy(docs: DataFrame) -> DataFrame:
    """Drop texts without a word and bring ``n_chars`` up to date."""
    left = docs.filter(F.col("text").rlike(WORD))
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.prepare(spark)
    return language.keep_known(docs, language.fit_documents(docs))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.prepare(spark)
    return _tidy(lines.dedup_lines(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.prepare(spark)
    return nearcopies.keep_first(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.prepare(spark)
    return _tidy(suffixes.dedup_substrings(docs, passage_words=PASSAGE_WORDS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    frames.prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("language", known_language),
    ("lines", repeated_lines),
    ("near_copies", near_copies),
    ("substrings", repeated_substrings),
    ("pack", pack),
]
#: Learned models, fingerprints and tokenizers have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frames.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
