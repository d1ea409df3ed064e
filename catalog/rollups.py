"""Aggregation queries and their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import AS_OF_SQL, VIEWS
from catalog.registry import add
from pulsegrid.operators import joins as J, rollups as R, sketches
from pulsegrid.operators.dedup import dedup_executions
from pulsegrid.plans import correlate as C

VIEWS["execs"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id, tracking_id
    ORDER BY end_ts DESC, duration_ms DESC, node_id DESC, data_source DESC, query_type DESC) AS rn
  FROM executions) WHERE rn = 1"""


def execs(spark, sf_dir):
    """Executions after replay removal: what the gold tables count."""
    return dedup_executions(B.executions(spark, sf_dir))


def perf_sql(by: str) -> str:
    return f"""
SELECT {by}, date_trunc('hour', end_ts) AS hour_utc, count(*) AS query_count,
       CAST(count(*) FILTER (WHERE NOT success) AS BIGINT) AS error_count,
       round(count(*) FILTER (WHERE NOT success) * CAST(100 AS DOUBLE) / count(*), 2) AS error_rate_pct,
       round(avg(duration_ms), 0) AS duration_avg_ms,
       CAST(quantile_disc(duration_ms, 0.95) AS DOUBLE) AS duration_p95_ms,
       max(duration_ms) AS duration_max_ms,
       CAST(sum(spool_bytes) AS BIGINT) AS spool_total_bytes_sum,
       round(avg(spool_write_ms), 0) AS spool_writing_ms_avg,
       round(avg(data_read_ms), 0) AS data_reading_ms_avg,
       round(avg(disk_read_bps), 2) AS disk_read_bps_avg,
       round(avg(disk_write_bps), 2) AS disk_write_bps_avg,
       round(count(*) FILTER (WHERE spool_bytes > 0) * CAST(100 AS DOUBLE) / count(*), 2) AS spooled_pct,
       CAST(date_trunc('hour', end_ts) AS DATE) AS partition_date
FROM execs GROUP BY {by}, date_trunc('hour', end_ts)"""


VIEWS["gold_perf"] = perf_sql("node_id, data_source, query_type")

add(
    "query_performance_hourly",
    lambda s, d: R.query_performance(execs(s, d)),
    "SELECT * FROM gold_perf",
)
add(
    "query_performance_by_artifact",
    lambda s, d: R.query_performance(execs(s, d), ["artifact_id", "data_source", "query_type"]),
    perf_sql("artifact_id, data_source, query_type"),
)

# ---- health ---------------------------------------------------------------------

VIEWS["health5"] = """
SELECT node_id, time_bucket(INTERVAL 5 MINUTE, end_ts) AS window_start,
  count(*) AS query_count_5min, count(*) FILTER (WHERE NOT success) AS error_count_5min,
  round(avg(duration_ms), 2) AS duration_avg_ms,
  CAST(quantile_disc(duration_ms, 0.95) AS BIGINT) AS duration_p95_ms,
  round(count(*) FILTER (WHERE NOT success) * CAST(100 AS DOUBLE) / count(*), 2) AS error_rate_pct
FROM execs GROUP BY 1, 2"""
VIEWS["latest5"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY node_id
  ORDER BY window_start DESC) AS rn FROM health5) WHERE rn = 1"""
VIEWS["heartbeat"] = f"""
SELECT node_id, collected_at AS last_heartbeat_utc, cluster_name, node_name, host_id,
  status AS status_current, version,
  round((floor(epoch({AS_OF_SQL})) - floor(epoch(collected_at))) / CAST(60 AS DOUBLE), 4) AS heartbeat_age_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY collected_at DESC, record_id DESC) AS rn
  FROM inventory WHERE status = 'Live') WHERE rn = 1"""
VIEWS["counter_avg"] = """
SELECT node_id, round(avg(gateway_cpu), 4) AS cpu_pct_avg, round(avg(gateway_mem_kb), 2) AS mem_kb_avg,
  round(avg(system_cpu), 4) AS system_cpu_avg, max(counter_ts) AS last_counter_utc
FROM counters GROUP BY 1"""
VIEWS["spool_now"] = """
SELECT host_id, free_pct AS spool_free_pct, spool_dir_bytes AS spool_dir_size_bytes,
  CASE WHEN free_pct <= 5 THEN 'ERROR' WHEN free_pct <= 15 THEN 'WARNING' ELSE 'OK' END AS spool_alert_level,
  stream_mode_warn AS spool_stream_mode_warn
FROM (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY collected_at DESC, record_id DESC) AS rn
  FROM spool) WHERE rn = 1"""
VIEWS["net_avg"] = """
SELECT node_id, round(avg(bytes_per_s_max), 2) AS nic_bytes_per_sec_avg,
  round(avg(latency_ms), 4) AS latency_ms_avg, quantile_disc(latency_ms, 0.95) AS latency_ms_p95,
  round(avg(utilization_pct_max), 4) AS network_utilization_pct_avg
FROM net_correlated GROUP BY 1"""
VIEWS["gold_health"] = """
SELECT h.*, w.* EXCLUDE (node_id), c.* EXCLUDE (node_id), s.* EXCLUDE (host_id), n.* EXCLUDE (node_id),
  CAST(h.last_heartbeat_utc AS DATE) AS partition_date
FROM heartbeat h LEFT JOIN latest5 w ON h.node_id = w.node_id
LEFT JOIN counter_avg c ON h.node_id = c.node_id
LEFT JOIN spool_now s ON h.host_id = s.host_id
LEFT JOIN net_avg n ON h.node_id = n.node_id"""
VIEWS["node_cluster"] = """
SELECT node_id, cluster_id, cluster_name FROM (SELECT *, row_number() OVER (PARTITION BY node_id
  ORDER BY collected_at DESC, record_id DESC, cluster_id DESC) AS rn FROM inventory) WHERE rn = 1"""
VIEWS["node_hours"] = """
SELECT e.node_id, date_trunc('hour', end_ts) AS hour_utc, count(*) AS n FROM execs e GROUP BY 1, 2"""
VIEWS["gold_load"] = """
SELECT cluster_id, cluster_name, hour_utc, count(*) AS node_count,
  round(avg(n), 4) AS node_query_mean, round(stddev_samp(n), 4) AS node_query_stddev,
  max(n) AS max_node_queries, CAST(sum(n) AS BIGINT) AS total_cluster_queries,
  CASE WHEN count(*) > 1 THEN round(stddev_samp(n) / avg(n), 3) END AS queries_per_node_cv,
  CASE WHEN count(*) = 1 THEN 'SINGLE_NODE_OR_NO_DATA'
       WHEN round(stddev_samp(n) / avg(n), 3) > 0.8 THEN 'SEVERELY_SKEWED'
       WHEN round(stddev_samp(n) / avg(n), 3) > 0.5 THEN 'MODERATELY_SKEWED'
       WHEN round(stddev_samp(n) / avg(n), 3) > 0.2 THEN 'SLIGHTLY_SKEWED'
       ELSE 'BALANCED' END AS load_skew_classification,
  first(x.node_id ORDER BY n DESC, x.node_id) AS hottest_node_id,
  round(CAST(max(n) AS DOUBLE) / sum(n) * 100, 1) AS hottest_node_query_pct,
  CAST(hour_utc AS DATE) AS partition_date
FROM node_hours x JOIN node_cluster c ON x.node_id = c.node_id
GROUP BY cluster_id, cluster_name, hour_utc"""
VIEWS["gold_process"] = """
SELECT node_id, host_id, max(working_set_mb) AS peak_working_set_mb,
  round(avg(working_set_mb), 4) AS avg_working_set_mb, max(cpu_pct) AS peak_cpu_pct,
  count(DISTINCT process_id) AS distinct_processes,
  count(*) FILTER (WHERE is_container) AS container_samples,
  max(working_set_mb) > 6000 AS runaway_container
FROM processes GROUP BY 1, 2"""


def health(s, d):
    return R.gateway_health(
        execs(s, d), B.inventory(s, d), B.counters(s, d), B.spool(s, d),
        C.silver_network_correlated(execs(s, d), B.network(s, d)), B.as_of(),
    )


def load(s, d):
    return R.cluster_load(execs(s, d), R.cluster_map(B.inventory(s, d)))


add("health_5min", lambda s, d: R.health_5min(execs(s, d)), "SELECT * FROM health5")
add("latest_window_per_node", lambda s, d: R.latest_window_per_node(execs(s, d)), "SELECT * FROM latest5")
add("heartbeat_age", lambda s, d: R.heartbeat_age(B.inventory(s, d), B.as_of()), "SELECT * FROM heartbeat")
add("counter_rollup", lambda s, d: R.counter_rollup(B.counters(s, d)), "SELECT * FROM counter_avg")
add("spool_latest", lambda s, d: R.spool_latest(B.spool(s, d)), "SELECT * FROM spool_now")
add(
    "network_rollup",
    lambda s, d: R.network_rollup(C.silver_network_correlated(execs(s, d), B.network(s, d))),
    "SELECT * FROM net_avg",
)
add("nic_representative", lambda s, d: R.nic_representative(B.network(s, d)), "SELECT * FROM nics")
add("gateway_health", health, "SELECT * FROM gold_health")
add("health_star_join", lambda s, d: health(s, d).select(
    "node_id", "node_name", "query_count_5min", "cpu_pct_avg", "spool_free_pct", "latency_ms_p95"),
    """SELECT node_id, node_name, query_count_5min, cpu_pct_avg, spool_free_pct, latency_ms_p95
       FROM gold_health""")
add("cluster_load", load, "SELECT * FROM gold_load")
add(
    "max_row_self_join",
    lambda s, d: load(s, d).select("cluster_id", "hour_utc", "hottest_node_id", "max_node_queries"),
    "SELECT cluster_id, hour_utc, hottest_node_id, max_node_queries FROM gold_load",
)
add(
    "dimension_lookup",
    lambda s, d: J.dimension_lookup(
        execs(s, d).select("request_id", "tracking_id", "node_id", "end_ts"),
        R.cluster_map(B.inventory(s, d)), "node_id",
    ),
    """SELECT e.request_id, e.tracking_id, e.node_id, e.end_ts, c.cluster_id, c.cluster_name
       FROM execs e JOIN node_cluster c ON e.node_id = c.node_id""",
)
add(
    "load_skew_window",
    lambda s, d: R.load_skew(J.lookback(execs(s, d), "end_ts", B.as_of(), 3600)),
    f"""SELECT round(stddev_samp(n) / avg(n), 4) AS load_skew_cv, count(*) AS nodes,
       coalesce(stddev_samp(n) / avg(n) > 0.5, false) AS skew_alert
       FROM (SELECT node_id, count(*) AS n FROM execs WHERE end_ts > {AS_OF_SQL} - INTERVAL 1 HOUR GROUP BY 1)""",
)
add(
    "load_skew_all",
    lambda s, d: R.load_skew(execs(s, d), threshold=0.01),
    """SELECT round(stddev_samp(n) / avg(n), 4) AS load_skew_cv, count(*) AS nodes,
       coalesce(stddev_samp(n) / avg(n) > 0.01, false) AS skew_alert
       FROM (SELECT node_id, count(*) AS n FROM execs GROUP BY 1)""",
)
add(
    "max_min_skew",
    lambda s, d: R.max_min_skew(execs(s, d)),
    """SELECT max(n) AS max_node_queries, min(n) AS min_node_queries,
       round(CAST(max(n) AS DOUBLE) / min(n), 4) AS max_min_ratio,
       round(max(CAST(bad AS DOUBLE) / n) * 100, 2) AS worst_failure_pct
       FROM (SELECT node_id, count(*) AS n, count(*) FILTER (WHERE NOT success) AS bad FROM execs GROUP BY 1)""",
)
add("process_health", lambda s, d: R.process_health(B.processes(s, d)), "SELECT * FROM gold_process")
VIEWS["owned_execs"] = """
SELECT e.request_id, e.query_type, o.executing_user, o.item_name
FROM executions e LEFT JOIN owner_one o ON e.request_id = o.operation_id"""
RATE_SQL = """count(*) AS total_queries,
  count(*) FILTER (WHERE coalesce(executing_user, '') <> '') AS attributed_queries,
  count(DISTINCT nullif(executing_user, '')) AS distinct_users,
  count(DISTINCT nullif(item_name, '')) AS distinct_items,
  round(CAST(count(*) FILTER (WHERE coalesce(executing_user, '') <> '') AS DOUBLE) * 100 / count(*), 1) AS match_rate_pct"""


def owned(s, d):
    return J.identity_left_join(B.executions(s, d), B.monitoring(s, d))


add("match_rate", lambda s, d: R.match_rate(owned(s, d)), f"SELECT {RATE_SQL} FROM owned_execs")
add(
    "match_rate_by_type",
    lambda s, d: R.match_rate(owned(s, d), ["query_type"]).orderBy(F.col("total_queries").desc(), "query_type"),
    f"SELECT query_type, {RATE_SQL} FROM owned_execs GROUP BY 1 ORDER BY total_queries DESC, query_type",
)
add(
    "distinct_count_exact",
    lambda s, d: execs(s, d).groupBy("node_id").agg(
        F.count_distinct("artifact_id").alias("artifacts"),
        F.count_distinct("tracking_id").alias("tracking_ids"),
    ),
    """SELECT node_id, count(DISTINCT artifact_id) AS artifacts, count(DISTINCT tracking_id) AS tracking_ids
       FROM execs GROUP BY 1""",
)
add(
    "distinct_count_approx",
    lambda s, d: execs(s, d).groupBy("node_id").agg(
        F.approx_count_distinct("artifact_id", 0.01).alias("artifacts")
    ),
    "SELECT node_id, count(DISTINCT artifact_id) AS artifacts FROM execs GROUP BY 1",
)
add(
    "distinct_users_of_periods",
    lambda s, d: sketches.distinct_values(
        sketches.daily_sketches(B.activities(s, d), "activity_ts", "user_id", ["operation"]),
        ["operation", F.year("partition_date").alias("year")], "users").drop("users_error"),
    """SELECT operation, CAST(year(activity_ts) AS INTEGER) AS year, count(DISTINCT user_id) AS users
       FROM activities GROUP BY 1, 2""",
)
add(
    "active_users_change_from_sketches",
    lambda s, d: sketches.month_change(sketches.daily_sketches(B.activities(s, d), "activity_ts", "user_id"), "users"),
    """WITH m AS (SELECT CAST(date_trunc('month', activity_ts) AS DATE) AS month, count(DISTINCT user_id) AS users
       FROM activities GROUP BY 1)
       SELECT c.*, p.users AS previous, round(CAST(c.users - p.users AS DOUBLE) / p.users * 100, 2) AS change_pct
       FROM m c LEFT JOIN m p ON c.month = p.month + INTERVAL 1 MONTH""",
)
add(
    "capacity_daily",
    lambda s, d: R.capacity_usage(B.capacities(s, d), ["capacity_id", "sku", "usage_date"]),
    """SELECT capacity_id, sku, usage_date, round(sum(cu_seconds), 4) AS cu_seconds
       FROM capacities GROUP BY 1, 2, 3""",
)
add(
    "source_routing",
    lambda s, d: R.source_routing(execs(s, d)),
    """SELECT data_source, node_id, cluster_id, count(*) AS queries, CAST(sum(spool_bytes) AS BIGINT) AS spool_bytes,
       round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY data_source), 2) AS source_share_pct
       FROM execs GROUP BY 1, 2, 3""",
)
add(
    "retry_profile",
    lambda s, d: R.retry_profile(B.executions(s, d)),
    """SELECT request_id, count(*) AS attempts, count(DISTINCT tracking_id) AS tracking_ids,
       count(*) FILTER (WHERE NOT success) AS failed_attempts,
       last(success ORDER BY end_ts, duration_ms, success) AS last_success FROM executions GROUP BY 1""",
)
add(
    "time_split_breakdown",
    lambda s, d: R.time_split(execs(s, d), ["data_source"]),
    """SELECT data_source, CAST(sum(duration_ms) AS BIGINT) AS duration_ms,
       round(CAST(sum(data_read_ms) AS DOUBLE) * 100 / sum(duration_ms), 2) AS read_pct,
       round(CAST(sum(processing_ms) AS DOUBLE) * 100 / sum(duration_ms), 2) AS processing_pct,
       round(CAST(sum(spool_write_ms) + sum(spool_read_ms) AS DOUBLE) * 100 / sum(duration_ms), 2) AS spool_pct
       FROM execs GROUP BY 1""",
)
VIEWS["dim_now"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY node_id
  ORDER BY collected_at DESC, record_id DESC) AS rn FROM inventory) WHERE rn = 1"""
add(
    "dim_gateway_profile",
    lambda s, d: R.fleet_profile(R.newest_of(B.inventory(s, d), ["node_id"], "collected_at", ["record_id"])),
    """SELECT version, status, cluster_name, count(*) AS nodes,
       CAST(grouping_id(version, status, cluster_name) AS INTEGER) AS level
       FROM dim_now GROUP BY CUBE (version, status, cluster_name)""",
)
add(
    "audit_call_rollup",
    lambda s, d: R.audit_rollup(B.call_audit(s, d)),
    """SELECT api_path, status_code, count(*) AS calls, CAST(sum(row_count) AS BIGINT) AS rows,
       round(CAST(sum(CASE WHEN status_code <> 200 THEN count(*) ELSE 0 END) OVER (PARTITION BY api_path) AS DOUBLE)
         * 100 / sum(count(*)) OVER (PARTITION BY api_path), 2) AS path_failure_pct
       FROM call_audit GROUP BY 1, 2""",
)
add(
    "job_durations",
    lambda s, d: R.job_durations(B.call_audit(s, d)),
    """SELECT job_id, min(audit_ts) FILTER (WHERE job_event = 'START') AS started,
       max(audit_ts) FILTER (WHERE job_event = 'END') AS ended,
       CAST(floor(epoch(max(audit_ts) FILTER (WHERE job_event = 'END'))) -
            floor(epoch(min(audit_ts) FILTER (WHERE job_event = 'START'))) AS BIGINT) AS seconds
       FROM call_audit GROUP BY 1""",
)
add(
    "fingerprint_rollup",
    lambda s, d: R.fingerprint_rollup(execs(s, d)),
    """SELECT sha256(shape) AS fingerprint, shape, count(*) AS queries,
       round(avg(duration_ms), 2) AS duration_avg_ms,
       CAST(quantile_disc(duration_ms, 0.95) AS BIGINT) AS duration_p95_ms,
       round(count(*) FILTER (WHERE NOT success) * CAST(100 AS DOUBLE) / count(*), 2) AS failure_pct,
       CAST(quantile_disc(duration_ms, 0.95) AS BIGINT) * count(*) AS impact
       FROM (SELECT *, data_source || '|' || query_type || '|' ||
         CAST(floor(log10(duration_ms + 1)) AS BIGINT) AS shape FROM execs) GROUP BY shape""",
)
add(
    "basic_and_conditional_aggs",
    lambda s, d: execs(s, d).groupBy("data_source").agg(
        *R.named_aggs(
            count="n", sums={"total_ms": F.col("duration_ms")},
            lows={"low_ms": F.col("duration_ms")}, highs={"high_ms": F.col("duration_ms")},
            counts_if={"failures": ~F.col("success")},
            distincts={"nodes": F.when(~F.col("success"), F.col("node_id"))},
        ),
        F.round(F.avg("duration_ms"), 3).alias("mean_ms"),
        F.round(F.stddev_samp("duration_ms"), 3).alias("deviation_ms"),
        F.sum(F.when(F.col("spool_bytes") > 0, 1).otherwise(0)).alias("spooled"),
    ),
    """SELECT data_source, count(*) AS n, CAST(sum(duration_ms) AS BIGINT) AS total_ms,
       min(duration_ms) AS low_ms, max(duration_ms) AS high_ms,
       count(*) FILTER (WHERE NOT success) AS failures,
       count(DISTINCT CASE WHEN NOT success THEN node_id END) AS nodes,
       round(avg(duration_ms), 3) AS mean_ms, round(stddev_samp(duration_ms), 3) AS deviation_ms,
       CAST(sum(CASE WHEN spool_bytes > 0 THEN 1 ELSE 0 END) AS BIGINT) AS spooled
       FROM execs GROUP BY 1""",
)
