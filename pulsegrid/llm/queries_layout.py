"""Registered queries of the layout operators (5, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import lines, sharding
from pulsegrid.llm.frames import documents

SHARDS = 24


def op5_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sharding.shard_by_bytes(docs, SHARDS).select(
        "doc_id", "size", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lines.dedup_lines(docs, lines="n_lines", removed="n_removed_lines").select(
        "doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256")
    )


QUERIES = {"op5_histogram_shards": op5_histogram_shards, "op7_line_chunks": op7_line_chunks}
CHECKS = {"op7_line_chunks": lines.CHECK}
