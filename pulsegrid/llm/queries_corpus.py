"""Registered queries of the corpus operators (11, 12, 13)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import alignment, divergence, recompression
from pulsegrid.llm.frames import documents


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        documents(spark, sf_dir).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), digest=True,
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recompression.repeated_windows(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", (F.col("n_words") - F.col("n_removed")).alias("n_kept"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {
    "op11_alignment": op11_alignment,
    "op12_recompression": op12_recompression,
    "op13_divergence": op13_divergence,
}
CHECKS = {"op13_divergence": divergence.CHECK}
