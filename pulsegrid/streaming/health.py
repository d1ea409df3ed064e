"""Windows, deduplication and joins on streams of executions and heartbeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsegrid.functions import scalars as S
from pulsegrid.operators.rollups import n_rows, p95
from pulsegrid.streaming.stateful import Outages, use_rocksdb


def dedup(executions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Replays inside the watermark dropped; state is bounded by the delay."""
    return executions.withWatermark("end_ts", delay).dropDuplicatesWithinWatermark(["request_id", "tracking_id"])


def _window_counts(executions: DataFrame, window, delay: str) -> DataFrame:
    grouped = executions.withWatermark("end_ts", delay).groupBy("node_id", window.alias("w")).agg(
        n_rows().alias("query_count"),
        F.count_if(~F.col("success")).alias("error_count"),
        F.avg("duration_ms").alias("duration_avg"),
        p95(F.col("duration_ms")).alias("duration_p95_ms"),
    )
    return grouped.select(
        "node_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "query_count",
        "error_count",
        F.round("duration_avg", 2).alias("duration_avg_ms"),
        "duration_p95_ms",
        S.percent(F.col("error_count"), F.col("query_count")).alias("error_rate_pct"),
    )


def health_5min(executions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return _window_counts(executions, F.window("end_ts", "5 minutes"), delay)


def sliding_error_rate(executions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return _window_counts(executions, F.window("end_ts", "5 minutes", "1 minute"), delay)


def identity_join(
    executions: DataFrame, monitoring: DataFrame, bound: str = "10 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """Executions with a monitoring row of the same request up to ``bound`` later.

    Unmatched executions come out once the watermark passes the bound.
    """
    left = executions.withWatermark("end_ts", delay)
    right = monitoring.withWatermark("mon_ts", delay)
    return left.join(
        right,
        F.expr(f"request_id = operation_id AND mon_ts >= end_ts AND mon_ts <= end_ts + INTERVAL {bound}"),
        "left_outer",
    )


def offline_events(heartbeats: DataFrame, threshold: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """LIVE at the first heartbeat after a silence, OFFLINE when ``threshold`` passes without one.

    LIVE comes out when the watermark passes that heartbeat, so no earlier one can
    still arrive and the signal is ``delay`` late at most; OFFLINE when it passes the
    last heartbeat plus the threshold, with the number of heartbeats in between.
    Each node changes state once per outage, whatever the arrival order.
    """
    use_rocksdb(heartbeats.sparkSession)
    gap_us = heartbeats.sparkSession.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {threshold})").first()[0]
    beats = heartbeats.withWatermark("collected_at", delay).select(
        "node_id", "collected_at", F.unix_micros("collected_at").alias("us")
    )
    kind = heartbeats.schema["node_id"].dataType.simpleString()
    events = beats.groupBy("node_id").transformWithStateInPandas(
        Outages(int(gap_us)),
        f"node_id {kind}, state string, at_us bigint, heartbeats bigint, last_us bigint",
        "Append",
        "EventTime",
    )
    return events.select(
        "node_id", "state", F.timestamp_micros("at_us").alias("at"), "heartbeats",
        F.timestamp_micros("last_us").alias("last_seen"),
    )

