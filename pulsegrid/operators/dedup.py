"""One row per key, chosen by a complete order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key under ``order``.

    The rank-1 filter is applied before the exchange too (window group limit),
    so a key with a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedup_executions(df: DataFrame) -> DataFrame:
    """(request_id, tracking_id) once, latest end first; remaining ties by the row values."""
    rest = [
        F.col(c).desc_nulls_last() for c in ("duration_ms", "node_id", "data_source", "query_type")
        if c in df.columns
    ]
    return latest_wins(df, ["request_id", "tracking_id"], [F.col("end_ts").desc_nulls_last(), *rest])


def earliest_per_key(df: DataFrame, keys: list[str], time: str, tie: list[str]) -> DataFrame:
    order = [F.col(time).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]]
    return latest_wins(df, keys, order)


def latest_per_key(df: DataFrame, keys: list[str], time: str, tie: list[str]) -> DataFrame:
    order = [F.col(time).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in tie]]
    return latest_wins(df, keys, order)
