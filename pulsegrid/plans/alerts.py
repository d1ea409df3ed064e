"""Alert rules: tables in, alert rows out.

Every rule returns ``rule, entity, fired_at, severity, value, message`` so the
rules can be united, counted per day and passed through the circuit breaker.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.operators import series as T, stability as W

#: Message templates per rule.
TEMPLATES = {
    "gateway-offline": "Gateway {node_id} offline: no heartbeat for {heartbeat_age_minutes}m.",
    "spool-low": "Spool disk on {host_id} is at {spool_free_pct}% free.",
    "spool-forecast": "Gateway {host_id} spool disk forecast to hit {min_forecast}GB within 2h.",
    "spool-critical": "Spool disk on {host_id} at {spool_free_pct}% free. Immediate action required.",
    "credential-drift": "Datasource {datasource_id} not live for the last {polls} collection intervals.",
    "error-rate-spike": "Gateway {node_id} error rate is {error_rate_pct}% ({error_count_5min} errors in last 5 minutes).",
    "cpu-anomaly": "Gateway {node_id} CPU anomaly (score {score}) vs seasonal baseline.",
    "process-runaway": "Runaway process on {host_id} ({node_id}): peak {peak_working_set_mb}MB across {distinct_processes} processes.",
    "network-saturation": "Gateway {node_id} NIC utilization is {network_utilization_pct_avg}%, latency {latency_ms_p95}ms (P95).",
}
STREAM_NOTE = " Note: streaming mode is on; the reported spool size may be inaccurate."


def render(template: str, df: DataFrame) -> Column:
    """Placeholders filled from the row; doubles with one decimal, nulls as ``?``."""
    kinds = dict(df.dtypes)
    parts = []
    for text, name in re.findall(r"([^{]*)(?:\{(\w+)\})?", template):
        if text:
            parts.append(F.lit(text))
        if name:
            value = F.round(name, 1) if kinds[name] == "double" else F.col(name)
            parts.append(F.coalesce(value.cast("string"), F.lit("?")))
    return F.concat(*parts)


def _alerts(df: DataFrame, rule: str, entity: str, fired_at: Column, severity: Column, value: Column,
            message: Column | None = None) -> DataFrame:
    text = render(TEMPLATES[rule], df) if message is None else message
    return df.select(
        F.lit(rule).alias("rule"),
        F.col(entity).cast("string").alias("entity"),
        fired_at.alias("fired_at"),
        severity.alias("severity"),
        value.cast("double").alias("value"),
        text.alias("message"),
    )


def gateway_offline(health: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Nodes whose last live heartbeat is too old at ``as_of``."""
    late = health.filter(F.col("heartbeat_age_minutes") > cfg.offline_minutes)
    return _alerts(late, "gateway-offline", "node_id", as_of, F.lit("critical"), F.col("heartbeat_age_minutes"))


def gateway_offline_transitions(heartbeats: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """One alert per outage: at last heartbeat plus the threshold, once until the node is back."""
    limit = int(cfg.offline_minutes * 60)
    ended = W.gaps(heartbeats, ["node_id"], "collected_at").filter(F.col("gap_s") > limit).select(
        "node_id", F.col("prev_sec").alias("last_sec"), F.timestamp_seconds("sec").alias("back_at")
    )
    last = heartbeats.groupBy("node_id").agg(F.unix_timestamp(F.max("collected_at")).alias("last_sec"))
    open_ = last.filter(F.unix_timestamp(as_of) - F.col("last_sec") > limit).select(
        "node_id", "last_sec", F.lit(None).cast("timestamp").alias("back_at")
    )
    return ended.unionByName(open_).select(
        F.lit("gateway-offline").alias("rule"),
        "node_id",
        F.timestamp_seconds(F.col("last_sec") + limit).alias("fired_at"),
        "back_at",
    )


def spool_low(spool: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    low = spool.filter(F.col("spool_free_pct") < cfg.spool_warn_pct)
    note = F.when(F.col("spool_stream_mode_warn"), F.lit(STREAM_NOTE)).otherwise(F.lit(""))
    severity = F.when(F.col("spool_free_pct") < cfg.spool_error_pct, "critical").otherwise("warning")
    return _alerts(low, "spool-low", "host_id", as_of, severity, F.col("spool_free_pct"),
                   F.concat(render(TEMPLATES["spool-low"], low), note))


def spool_critical(spool: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    """Second-tier rule: rows carry the tier and that a person must approve."""
    low = spool.filter(F.col("spool_free_pct") < cfg.spool_error_pct)
    return _alerts(low, "spool-critical", "host_id", as_of, F.lit("critical"), F.col("spool_free_pct")).withColumns(
        {"tier": F.lit(2), "needs_approval": F.lit(True)}
    )


def spool_forecast(forecasts: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    breach = T.forecast_floor_breach(forecasts, ["host_id"], cfg.spool_floor_gb)
    return _alerts(breach, "spool-forecast", "host_id", F.col("first_breach"), F.lit("warning"), F.round("min_forecast", 4))


def credential_drift(polls: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Runs of bad polls; fires when the run reaches the configured length."""
    bad = polls.withColumn("bad", F.col("status").isin("Unknown", "Error"))
    runs = W.consecutive_bad(bad, ["datasource_id"], "collected_at", ["record_id"], "bad", cfg.bad_polls)
    return _alerts(runs, "credential-drift", "datasource_id", F.col("fired_at"), F.lit("warning"), F.col("polls"))


def error_rate_spike(health_5min: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    hot = health_5min.filter(
        (F.col("error_rate_pct") > cfg.error_rate_pct)
        & (F.col("query_count_5min") > cfg.error_rate_min_queries)
    )
    return _alerts(hot, "error-rate-spike", "node_id", F.col("window_start"), F.lit("critical"), F.col("error_rate_pct"))


def cpu_anomaly(scored: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    hits = T.anomaly_filter(scored, cfg.anomaly_score)
    return _alerts(hits, "cpu-anomaly", "node_id", F.col("bin"), F.lit("warning"), F.round("score", 4))


def runaway_process(process_health: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    hot = process_health.filter(F.col("peak_working_set_mb") > cfg.runaway_mb)
    return _alerts(hot, "process-runaway", "node_id", as_of, F.lit("warning"), F.col("peak_working_set_mb"))


def network_saturation(health: DataFrame, as_of: Column, cfg: Settings = DEFAULTS) -> DataFrame:
    hot = health.filter(F.col("network_utilization_pct_avg") > cfg.network_saturation_pct)
    return _alerts(hot, "network-saturation", "node_id", as_of, F.lit("warning"), F.col("network_utilization_pct_avg"))


def backtest(alerts: DataFrame) -> DataFrame:
    """How often each rule fired per day and entity count."""
    return alerts.groupBy("rule", F.to_date("fired_at").alias("day")).agg(
        F.count(F.lit(1)).alias("fires"), F.count_distinct("entity").alias("entities")
    )
