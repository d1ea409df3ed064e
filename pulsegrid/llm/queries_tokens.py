"""Registered queries of the token operators (1, 6, 8)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, orc_tokens, packing
from pulsegrid.llm.frames import documents, shared_dir


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return bpe.encode(docs, path, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), path, with_ids=False)


def op8_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "token-orc")
    path = public_tokenizers.path("word_bpe_49k.json")
    orc_tokens.write_tokens(documents(spark, sf_dir), path, out)
    rows = orc_tokens.digests(orc_tokens.read_tokens(spark, out))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op6_packing": op6_packing,
    "op8_token_orc": op8_token_orc,
}
CHECKS: dict[str, str] = {}
