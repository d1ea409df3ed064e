"""Registered queries of the text operators (4, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import language, quality
from pulsegrid.llm.frames import documents


def op10_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.judge(documents(spark, sf_dir), labels)
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit_documents(docs)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op4_language": op4_language,
    "op10_quality_forest": op10_quality_forest,
}
CHECKS: dict[str, str] = {}
