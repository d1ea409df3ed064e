"""Correlation queries: silver tables and the joins they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import AS_OF_SQL, VIEWS
from catalog.registry import add
from catalog.rollups import execs
from pulsegrid.operators import joins as J
from pulsegrid.operators.timejoin import nearest_match, window_match_counts
from pulsegrid.plans import correlate as C

VIEWS["starts_decoded"] = """
SELECT *, c::JSON->>'$.artifactId' AS artifact_id, c::JSON->>'$.artifactKind' AS artifact_type
FROM (SELECT *, CASE WHEN trim(evaluation_context) LIKE '{%' THEN trim(evaluation_context)
        WHEN trim(evaluation_context) = '' THEN NULL
        ELSE decode(from_base64(evaluation_context)) END AS c FROM starts)"""
VIEWS["first_start"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY start_ts, artifact_id, artifact_type) AS rn FROM starts_decoded) WHERE rn = 1"""
VIEWS["silver_exec"] = """
SELECT e.* EXCLUDE (artifact_id), s.start_ts, s.artifact_id, s.artifact_type,
       e.spool_bytes > 0 AS is_spooled, CAST(e.end_ts AS DATE) AS partition_date
FROM execs e LEFT JOIN first_start s ON e.request_id = s.request_id"""


def silver(s, d):
    return C.silver_query_execution(B.executions(s, d), B.starts(s, d))


add("silver_query_execution", silver, "SELECT * FROM silver_exec")
add(
    "decode_context",
    lambda s, d: C.decoded_starts(B.starts(s, d)).select("record_id", "artifact_id", "artifact_type"),
    "SELECT record_id, artifact_id, artifact_type FROM starts_decoded",
)
add(
    "start_exec_join",
    lambda s, d: J.start_exec_join(
        execs(s, d).select("request_id", "tracking_id", "end_ts"), C.decoded_starts(B.starts(s, d))
    ),
    """SELECT e.request_id, e.tracking_id, e.end_ts, s.start_ts, s.artifact_id, s.artifact_type
       FROM execs e LEFT JOIN first_start s ON e.request_id = s.request_id""",
)


add(
    "start_exec_join_composite",
    lambda s, d: J.start_exec_join_composite(B.starts(s, d), B.executions(s, d)),
    """SELECT s.node_id, s.tracking_id, s.request_id AS start_request_id,
       e.request_id AS exec_request_id, s.start_ts, e.end_ts,
       round(CASE WHEN spool_write_ms > 0 THEN CAST(spool_bytes AS DOUBLE) / spool_write_ms END, 4) AS write_bytes_per_ms,
       round(CASE WHEN spool_read_ms > 0 THEN CAST(spool_bytes AS DOUBLE) / spool_read_ms END, 4) AS read_bytes_per_ms,
       round(CASE WHEN duration_ms <> 0 THEN CAST(spool_write_ms AS DOUBLE) / duration_ms END, 4) AS spool_share
       FROM starts s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY node_id, tracking_id
          ORDER BY end_ts DESC, request_id DESC) AS rn FROM executions) e
       ON s.node_id = e.node_id AND s.tracking_id = e.tracking_id AND e.rn = 1""",
)

# ---- identity ---------------------------------------------------------------
OWNER = "operation_name IN ('QueryEnd', 'ExecutionMetrics', 'RefreshEnd')"
VIEWS["owner_rows"] = f"SELECT * FROM monitoring WHERE {OWNER}"
VIEWS["owner_one"] = f"""
SELECT operation_id, executing_user, item_name FROM (
  SELECT *, row_number() OVER (PARTITION BY operation_id ORDER BY mon_ts DESC, record_id DESC) AS rn
  FROM monitoring WHERE {OWNER}) WHERE rn = 1"""
VIEWS["identity"] = """
SELECT e.end_ts, e.node_id, m.executing_user, m.item_name, m.workspace_id, e.data_source,
       e.query_type, e.duration_ms AS gateway_duration_ms, m.cpu_ms AS engine_cpu_ms,
       e.spool_bytes AS spooled_bytes, e.success, e.error_message, e.request_id, e.tracking_id,
       m.operation_name
FROM executions e JOIN owner_rows m ON e.request_id = m.operation_id"""


def identity(s, d):
    return J.identity_join(B.executions(s, d), B.monitoring(s, d))


add("identity_join", identity, "SELECT * FROM identity")
add(
    "identity_join_lookback",
    lambda s, d: J.identity_join(
        J.lookback(B.executions(s, d), "end_ts", B.as_of(), 5 * 86400),
        J.lookback(B.monitoring(s, d), "mon_ts", B.as_of(), 30 * 86400),
        workspaces=[1, 2, 3, 4, 5, 6, 7, 8],
    ),
    f"""SELECT e.end_ts, e.node_id, m.executing_user, m.item_name, m.workspace_id, e.data_source,
       e.query_type, e.duration_ms AS gateway_duration_ms, m.cpu_ms AS engine_cpu_ms,
       e.spool_bytes AS spooled_bytes, e.success, e.error_message, e.request_id, e.tracking_id,
       m.operation_name
       FROM executions e JOIN monitoring m ON e.request_id = m.operation_id
       WHERE e.end_ts > {AS_OF_SQL} - INTERVAL 5 DAY AND m.mon_ts > {AS_OF_SQL} - INTERVAL 30 DAY
         AND m.workspace_id BETWEEN 1 AND 8 AND m.{OWNER}""",
)
add(
    "identity_left_join",
    lambda s, d: J.identity_left_join(B.executions(s, d), B.monitoring(s, d)).select(
        "request_id", "end_ts", "query_type", "executing_user", "item_name"
    ),
    """SELECT e.request_id, e.end_ts, e.query_type, o.executing_user, o.item_name
       FROM executions e LEFT JOIN owner_one o ON e.request_id = o.operation_id""",
)
add(
    "distinct_right_before_join",
    lambda s, d: B.executions(s, d).select("request_id", "end_ts").join(
        J.owner_rows(B.monitoring(s, d))
        .select(F.col("operation_id").alias("request_id"), "executing_user", "item_name")
        .dropDuplicates(),
        "request_id",
        "left",
    ),
    f"""SELECT e.request_id, e.end_ts, m.executing_user, m.item_name FROM executions e LEFT JOIN
       (SELECT DISTINCT operation_id, executing_user, item_name FROM monitoring WHERE {OWNER}) m
       ON e.request_id = m.operation_id""",
)
add(
    "unattributed_sample",
    lambda s, d: J.unattributed(B.executions(s, d), B.monitoring(s, d))
    .select("end_ts", "request_id", "query_type", "node_id")
    .orderBy(F.col("end_ts").desc(), "request_id")
    .limit(25),
    f"""SELECT end_ts, request_id, query_type, node_id FROM executions
       WHERE request_id NOT IN (SELECT operation_id FROM monitoring WHERE {OWNER}
          AND coalesce(executing_user, '') <> '')
       ORDER BY end_ts DESC, request_id LIMIT 25""",
)
add(
    "inline_keys_join",
    lambda s, d: J.inline_keys_join(
        B.executions(s, d).filter("success = false").select("request_id").distinct(), B.monitoring(s, d)
    ),
    """SELECT k.request_id, o.executing_user, o.item_name
       FROM (SELECT DISTINCT request_id FROM executions WHERE NOT success) k
       LEFT JOIN owner_one o ON k.request_id = o.operation_id""",
)

# ---- joins on time ------------------------------------------------------------
VIEWS["failed_execs"] = "SELECT * FROM silver_exec WHERE NOT success"
NEAR_COLS = "request_id, tracking_id"


def nearest_sql(left, left_time, right, right_time, back, ahead, tie, on="", keys=NEAR_COLS):
    """Best pair per left key, by brute force."""
    equal = f" AND {on}" if on else ""
    gap = f"CAST(floor(epoch(l.{left_time})) - floor(epoch(r.{right_time})) AS BIGINT)"
    left_keys = ", ".join(f"l.{k.strip()}" for k in keys.split(","))
    return f"""
SELECT * FROM (SELECT {left_keys}, r.* EXCLUDE ({{drop}}), abs({gap}) AS gap,
    row_number() OVER (PARTITION BY {left_keys} ORDER BY abs({gap}), r.{right_time}, {tie}) AS rn
  FROM {left} l JOIN {right} r ON {gap} <= {back} AND {gap} >= -{ahead}{equal}) WHERE rn = 1"""


VIEWS["near_refresh"] = nearest_sql(
    "failed_execs", "end_ts", "refreshes", "end_ts", 30, 30, "r.request_id"
).format(drop="request_id, start_ts, end_ts").replace(
    "r.* EXCLUDE", "r.start_ts AS refresh_start_ts, r.end_ts AS refresh_end_ts, r.* EXCLUDE"
)
VIEWS["exact_refresh"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id
  ORDER BY end_ts DESC, dataset_id DESC, start_ts DESC) AS rn FROM refreshes) WHERE rn = 1"""
VIEWS["tiered"] = """
SELECT f.request_id, f.tracking_id, f.node_id, f.host_id, f.data_source, f.query_type, f.end_ts,
  f.error_message, f.artifact_id, f.spool_bytes,
  coalesce(x.dataset_id, n.dataset_id) AS refresh_dataset_id,
  coalesce(x.workspace_id, n.workspace_id) AS refresh_workspace_id,
  coalesce(x.status, n.status) AS refresh_status,
  coalesce(x.start_ts, n.refresh_start_ts) AS refresh_start_ts,
  coalesce(x.end_ts, n.refresh_end_ts) AS refresh_end_ts,
  coalesce(x.service_exception, n.service_exception) AS refresh_service_exception,
  CASE WHEN x.request_id IS NULL THEN n.gap END AS refresh_gap_s,
  CASE WHEN x.request_id IS NOT NULL THEN 'EXACT_REQUESTID'
       WHEN n.request_id IS NOT NULL THEN 'TIME_WINDOW' ELSE 'GATEWAY_ONLY' END AS triage_confidence,
  x.request_id IS NOT NULL OR n.request_id IS NOT NULL AS failure_layer_refresh
FROM failed_execs f LEFT JOIN exact_refresh x ON f.request_id = x.request_id
LEFT JOIN near_refresh n ON f.request_id = n.request_id AND f.tracking_id = n.tracking_id"""
VIEWS["serious_events"] = "SELECT * FROM os_events WHERE level IN ('Error', 'Warning')"
VIEWS["near_event"] = nearest_sql(
    "failed_execs", "end_ts", "serious_events", "evt_time", 120, 120, "r.record_id",
    on="l.host_id = r.host_id",
).format(drop="record_id")
VIEWS["triage"] = """
SELECT t.*, e.evt_time, e.os_event_id, e.level, e.gap AS os_event_gap_s,
  e.request_id IS NOT NULL AS failure_layer_os_event,
  CASE WHEN e.request_id IS NOT NULL THEN 'HOST_ONLY' END AS os_event_confidence,
  CASE WHEN e.request_id IS NOT NULL THEN 'OS_SERVICE_EVENT'
       WHEN t.failure_layer_refresh THEN 'SERVICE_REFRESH_ERROR'
       WHEN t.error_message IS NOT NULL THEN 'GATEWAY_LOG_ERROR' ELSE 'UNKNOWN' END AS failure_layer,
  CAST(t.end_ts AS DATE) AS partition_date
FROM tiered t LEFT JOIN near_event e ON t.request_id = e.request_id AND t.tracking_id = e.tracking_id"""


def failures(s, d):
    return C.failed(silver(s, d)).select(
        "request_id", "tracking_id", "node_id", "host_id", "data_source", "query_type", "end_ts",
        "error_message", "artifact_id", "spool_bytes",
    )


def triage(s, d):
    return C.silver_triage(silver(s, d), B.refreshes(s, d), B.os_events(s, d))


add("silver_triage", triage, "SELECT * FROM triage")
add(
    "tiered_match",
    lambda s, d: C.tiered_match(failures(s, d), B.refreshes(s, d)),
    "SELECT * FROM tiered",
)
add(
    "host_time_event_join",
    lambda s, d: C.host_event_match(failures(s, d), B.os_events(s, d)).select(
        "request_id", "tracking_id", "evt_time", "os_event_id", "level", "os_event_gap_s",
        "failure_layer_os_event", "os_event_confidence",
    ),
    """SELECT request_id, tracking_id, evt_time, os_event_id, level, os_event_gap_s,
       failure_layer_os_event, os_event_confidence FROM triage""",
)
add(
    "anti_join_unmatched",
    lambda s, d: J.unmatched(failures(s, d), B.refreshes(s, d), "request_id").select(
        "request_id", "tracking_id", "end_ts"
    ),
    """SELECT request_id, tracking_id, end_ts FROM failed_execs
       WHERE request_id NOT IN (SELECT request_id FROM refreshes)""",
)
add(
    "time_window_join",
    lambda s, d: window_match_counts(
        execs(s, d).select("request_id", "tracking_id", "host_id", "end_ts"),
        B.network(s, d), "end_ts", "collected_at", 300, on=[("host_id", "host_id")],
    ),
    """SELECT l.request_id, l.tracking_id, l.host_id, l.end_ts, count(r.host_id) AS matches
       FROM execs l LEFT JOIN network r ON l.host_id = r.host_id
         AND abs(floor(epoch(l.end_ts)) - floor(epoch(r.collected_at))) <= 300
       GROUP BY ALL""",
)
add(
    "nearest_match_join",
    lambda s, d: nearest_match(
        failures(s, d).select("request_id", "tracking_id", "end_ts"),
        B.refreshes(s, d).withColumnsRenamed({"end_ts": "refresh_end", "request_id": "refresh_request"}),
        "end_ts", "refresh_end", 30,
        payload=["refresh_request", "dataset_id", "refresh_end"], tie=["refresh_request"],
    ),
    """SELECT f.request_id, f.tracking_id, f.end_ts, n.refresh_request, n.dataset_id,
       n.refresh_end_ts AS refresh_end, n.gap AS gap_s FROM failed_execs f LEFT JOIN
       (""" + nearest_sql("failed_execs", "end_ts", "refreshes", "end_ts", 30, 30, "r.request_id")
    .replace("r.* EXCLUDE ({drop})", "r.request_id AS refresh_request, r.dataset_id, r.end_ts AS refresh_end_ts")
    + """) n ON f.request_id = n.request_id AND f.tracking_id = n.tracking_id""",
)
add(
    "interval_band_join",
    lambda s, d: nearest_match(
        execs(s, d).select("request_id", "tracking_id", "end_ts"),
        B.refreshes(s, d).select(
            F.col("request_id").alias("refresh_request"), "dataset_id",
            F.col("start_ts").alias("refresh_start"),
        ),
        "end_ts", "refresh_start", 600, payload=["refresh_request", "dataset_id", "refresh_start"],
        tie=["refresh_request"], forward_s=0,
    ),
    """SELECT f.request_id, f.tracking_id, f.end_ts, n.refresh_request, n.dataset_id, n.refresh_start,
       n.gap AS gap_s FROM execs f LEFT JOIN
       (""" + nearest_sql("execs", "end_ts", "refreshes", "start_ts", 600, 0, "r.request_id")
    .replace("r.* EXCLUDE ({drop})", "r.request_id AS refresh_request, r.dataset_id, r.start_ts AS refresh_start")
    + """) n ON f.request_id = n.request_id AND f.tracking_id = n.tracking_id""",
)

# ---- identity attribution and network context -------------------------------------
VIEWS["open_execs"] = "SELECT * FROM silver_exec WHERE artifact_id IS NULL AND start_ts IS NOT NULL"
VIEWS["near_activity"] = nearest_sql(
    "open_execs", "start_ts", "activity_events", "activity_ts", 60, 60, "r.activity_id",
    on="l.artifact_hint = r.activity_artifact",
).replace("r.* EXCLUDE ({drop})", "r.*")
VIEWS["attribution"] = f"""
SELECT e.request_id, e.tracking_id, e.node_id, e.start_ts, e.end_ts, e.data_source, e.query_type,
  e.duration_ms, e.success, e.artifact_id, e.artifact_type, a.activity_id, a.user_alias,
  a.activity_workspace, a.gap AS activity_gap_s, o.executing_user, o.item_name,
  CASE WHEN e.artifact_id IS NOT NULL THEN 'EVALUATION_CONTEXT'
       WHEN a.activity_id IS NOT NULL THEN 'FUZZY_TIME_WINDOW' ELSE 'UNATTRIBUTED' END AS attribution_confidence,
  CASE WHEN e.artifact_id IS NOT NULL THEN '{C.NOTES["EVALUATION_CONTEXT"]}'
       WHEN a.activity_id IS NOT NULL THEN '{C.NOTES["FUZZY_TIME_WINDOW"]}'
       ELSE '{C.NOTES["UNATTRIBUTED"]}' END AS attribution_method_note,
  '{C.DISCLAIMER}' AS attribution_disclaimer, CAST(e.end_ts AS DATE) AS partition_date
FROM silver_exec e LEFT JOIN near_activity a ON e.request_id = a.request_id AND e.tracking_id = a.tracking_id
LEFT JOIN owner_one o ON e.request_id = o.operation_id"""
VIEWS["nics"] = """
SELECT host_id, collected_at, max(bytes_per_s) AS bytes_per_s_max,
  max(utilization_pct) AS utilization_pct_max, max(latency_ms) AS latency_ms,
  max(bandwidth_bps) AS bandwidth_bps FROM network GROUP BY 1, 2"""
VIEWS["near_nic"] = nearest_sql(
    "execs", "end_ts", "nics", "collected_at", 300, 300, "r.bytes_per_s_max", on="l.host_id = r.host_id"
).replace("r.* EXCLUDE ({drop})", "r.*")
VIEWS["net_correlated"] = """
SELECT e.request_id, e.tracking_id, e.node_id, e.host_id, e.data_source, e.query_type, e.end_ts,
  e.duration_ms, e.spool_bytes, e.success, e.error_message, n.bytes_per_s_max,
  n.utilization_pct_max, n.latency_ms, n.bandwidth_bps, n.gap AS network_gap_s,
  round(CASE WHEN e.spool_bytes > 0 AND n.bytes_per_s_max > 0 AND e.duration_ms > 0 THEN
    e.spool_bytes / (CAST(e.duration_ms AS DOUBLE) / 1000 * n.bytes_per_s_max) END, 6)
    AS network_throughput_efficiency,
  CAST(e.end_ts AS DATE) AS partition_date
FROM execs e LEFT JOIN near_nic n ON e.request_id = n.request_id AND e.tracking_id = n.tracking_id"""


def attribution(s, d):
    return C.silver_identity_attribution(silver(s, d), B.activity_events(s, d), B.monitoring(s, d))


def net_correlated(s, d):
    return C.silver_network_correlated(execs(s, d), B.network(s, d))


add("silver_identity_attribution", attribution, "SELECT * FROM attribution")
add(
    "fuzzy_activity_join",
    lambda s, d: C.fuzzy_activity_match(
        silver(s, d).filter("artifact_id IS NULL").select(
            "request_id", "tracking_id", "start_ts", "artifact_hint"
        ),
        B.activity_events(s, d),
    ),
    """SELECT e.request_id, e.tracking_id, e.start_ts, e.artifact_hint, a.activity_id, a.user_alias,
       a.activity_workspace, a.gap AS activity_gap_s FROM silver_exec e LEFT JOIN near_activity a
       ON e.request_id = a.request_id AND e.tracking_id = a.tracking_id WHERE e.artifact_id IS NULL""",
)
add("silver_network_correlated", net_correlated, "SELECT * FROM net_correlated")

# ---- enrichment and reach of an outage -------------------------------------------------
def _models(s, d):
    """One model per artifact number: the name comes from the first matching customer segment."""
    return (
        B.read(s, d, "customer")
        .groupBy((F.col("c_custkey") % 6).alias("model_id"))
        .agg(F.min("c_mktsegment").alias("model_name"))
    )


def _enriched_fact(s, d):
    refresh = B.refreshes(s, d).select(
        F.col("dataset_id").alias("refresh_model_id"), F.col("start_ts").alias("refresh_start")
    )
    users = B.monitoring(s, d).select(
        F.upper("item_name").alias("activity_item"),
        F.col("mon_ts").alias("activity_ts"),
        F.col("executing_user").alias("activity_user"),
    )
    base = execs(s, d).select("request_id", "tracking_id", "end_ts", "data_source")
    return C.enriched_fact(base, refresh, _models(s, d), users)


VIEWS["models"] = """SELECT CAST(c_custkey % 6 AS BIGINT) AS model_id, min(c_mktsegment) AS model_name
FROM customer GROUP BY 1"""
VIEWS["banded"] = """SELECT f.request_id, f.tracking_id, f.end_ts, f.data_source,
  n.refresh_model_id, n.refresh_start, n.gap AS refresh_gap_s FROM execs f LEFT JOIN
  (""" + nearest_sql("execs", "end_ts", "refreshes", "start_ts", 600, 0, "r.dataset_id").replace(
    "r.* EXCLUDE ({drop})", "r.dataset_id AS refresh_model_id, r.start_ts AS refresh_start"
) + """) n ON f.request_id = n.request_id AND f.tracking_id = n.tracking_id"""
VIEWS["named"] = "SELECT b.*, m.model_id, m.model_name FROM banded b LEFT JOIN models m ON b.refresh_model_id = m.model_id"
VIEWS["user_acts"] = "SELECT upper(item_name) AS activity_item, mon_ts AS activity_ts, executing_user AS activity_user FROM monitoring"
add(
    "enriched_fact",
    _enriched_fact,
    """SELECT n.*, a.activity_user, a.gap AS activity_gap_s FROM named n LEFT JOIN
       (""" + nearest_sql("named", "end_ts", "user_acts", "activity_ts", 600, 0, "r.activity_user",
                          on="lower(l.model_name) = lower(r.activity_item)").replace(
        "r.* EXCLUDE ({drop})", "r.activity_user") + """) a
       ON n.request_id = a.request_id AND n.tracking_id = a.tracking_id""",
)
add(
    "case_insensitive_join",
    lambda s, d: J.case_insensitive_join(
        B.read(s, d, "customer").select("c_custkey", "c_mktsegment"),
        _models(s, d).withColumn("model_name", F.upper("model_name")),
        "c_mktsegment", "model_name",
    ).groupBy("model_name").agg(F.count_distinct("c_custkey").alias("customers")),
    """SELECT upper(model_name) AS model_name, count(DISTINCT c_custkey) AS customers
       FROM customer JOIN models ON lower(c_mktsegment) = lower(model_name) GROUP BY 1""",
)
