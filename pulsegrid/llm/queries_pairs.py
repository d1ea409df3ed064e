"""Registered queries of the similarity operators (2, 3, 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import simhash, suffixes, vptree
from pulsegrid.llm.frames import documents, prepare


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_vp_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vptree.valid_vectors(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return vptree.nearest(rows, rows.filter("id % 20 = 0"), k=20)


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.removal_report(documents(spark, sf_dir).select("doc_id", "text"))
    return found.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


QUERIES = {
    "op9_suffix_repeats": op9_suffix_repeats,
    "op2_vp_tree_neighbours": op2_vp_tree_neighbours,
    "op3_simhash_groups": op3_simhash_groups,
}
CHECKS: dict[str, str] = {}
