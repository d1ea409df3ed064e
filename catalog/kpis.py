"""KPI measures, report pages and alert rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import AS_OF_SQL, VIEWS
from catalog.correlation import attribution, triage
from catalog.registry import add
from catalog.rollups import execs, health, load
from catalog.series import cpu5_series, spool_forecast
from pulsegrid.config import DEFAULTS
from pulsegrid.functions import scalars as S
from pulsegrid.operators import history as K, rollups as R, series as T, stability as W
from pulsegrid.plans import alerts as A, measures as M


def datasources(s, d):
    return R.newest_of(B.datasource_polls(s, d), ["datasource_id"], "collected_at", ["record_id"])


def refreshables(s, d):
    return B.refreshables(s, d).withColumn("duration_seconds", S.refresh_seconds(F.col("start_ts"), F.col("end_ts")))


TABLES = {
    "health": health,
    "performance": lambda s, d: R.query_performance(execs(s, d)),
    "load": load,
    "dimension": lambda s, d: K.current_dimension(B.inventory(s, d)),
    "attribution": attribution,
    "triage": triage,
    "process": lambda s, d: R.process_health(B.processes(s, d)),
    "items": B.items,
    "activities": B.activities,
    "refreshables": refreshables,
    "capacities": B.capacities,
    "datasources": datasources,
    "executions": execs,
    "counters": B.counters,
    "spool": B.spool,
    "network": B.network,
    "processes": B.processes,
}
VIEWS["ds_now"] = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY datasource_id
  ORDER BY collected_at DESC, record_id DESC) AS rn FROM datasource_polls) WHERE rn = 1"""
VIEWS["refresh_gold"] = """SELECT *, coalesce(greatest(0, epoch(end_ts) - epoch(start_ts)), 0) AS duration_seconds
  FROM refreshables"""
VIEWS["dim_gold"] = "SELECT *, status AS status_current FROM dim_now"
VIEW_OF = {
    "health": "gold_health", "performance": "gold_perf", "load": "gold_load", "dimension": "dim_gold",
    "attribution": "attribution", "triage": "triage", "process": "gold_process", "items": "items",
    "activities": "activities", "refreshables": "refresh_gold", "capacities": "capacities",
    "datasources": "ds_now", "executions": "execs", "counters": "counters", "spool": "spool", "network": "network",
    "processes": "processes",
}


class Lazy(dict):
    """Builds a gold table when a measure first asks for it."""

    def __init__(self, spark, sf_dir):
        super().__init__()
        self.source = (spark, sf_dir)

    def __missing__(self, name):
        self[name] = TABLES[name](*self.source)
        return self[name]


def ctx():
    return M.Context(B.as_of())


def share(cond):
    return f"coalesce(count(*) FILTER (WHERE {cond}) * CAST(100 AS DOUBLE) / nullif(count(*), 0), 0)"


def counted(cond):
    return f"count(*) FILTER (WHERE {cond})"


AGE = f"datediff('minute', max(last_heartbeat_utc), {AS_OF_SQL})"
UTIL = "avg(network_utilization_pct_avg)"
UNATTR = "attribution_confidence = 'UNATTRIBUTED'"
# measure -> (field to group by, SQL aggregate)
SQLS = {
    "heartbeat_age_minutes": ("node_id", AGE),
    "gateway_status": ("node_id", f"CASE WHEN {AGE} > 10 THEN 'OFFLINE' WHEN {AGE} > 5 THEN 'Degraded' ELSE 'Live' END"),
    "nodes_offline": ("cluster_name", counted("heartbeat_age_minutes > 10")),
    "error_rate_5min_pct": ("", f"round(avg(error_rate_pct) FILTER (WHERE partition_date = CAST({AS_OF_SQL} AS DATE)), 4)"),
    "avg_gateway_cpu_pct": ("cluster_name", "round(avg(cpu_pct_avg), 4)"),
    "avg_gateway_mem_mb": ("cluster_name", "round(coalesce(avg(mem_kb_avg) / 1024, 0), 4)"),
    "system_gateway_cpu_gap_pct": ("cluster_name", "round(avg(system_cpu_avg) - avg(cpu_pct_avg), 4)"),
    "spool_free_space_pct": ("node_id", "min(spool_free_pct)"),
    "spool_disk_status": ("node_id", "CASE WHEN min(spool_free_pct) IS NULL THEN 'Unknown' WHEN min(spool_free_pct) <= 5 THEN 'CRITICAL' WHEN min(spool_free_pct) <= 15 THEN 'LOW' ELSE 'OK' END"),
    "network_utilization_pct": ("cluster_name", f"round({UTIL}, 4)"),
    "network_latency_p95_ms": ("cluster_name", "max(latency_ms_p95)"),
    "network_status": ("node_id", f"CASE WHEN {UTIL} IS NULL THEN 'Unknown' WHEN {UTIL} >= 80 THEN 'SATURATED' WHEN {UTIL} >= 60 THEN 'HIGH' ELSE 'OK' END"),
    "avg_query_duration_ms": ("data_source", "round(avg(duration_avg_ms), 4)"),
    "max_query_duration_ms": ("data_source", "max(duration_max_ms)"),
    "gateway_error_rate_pct": ("node_id", "round(CAST(sum(error_count) AS DOUBLE) / sum(query_count) * 100, 4)"),
    "spool_throughput_mb_s": ("node_id", "round(coalesce((sum(spool_total_bytes_sum) / CAST(1048576 AS DOUBLE)) / nullif(sum(spool_writing_ms_avg * query_count) / 1000, 0), 0), 4)"),
    "total_queries": ("node_id", "CAST(sum(query_count) AS BIGINT)"),
    "total_errors": ("node_id", "CAST(sum(error_count) AS BIGINT)"),
    "total_data_spooled_gb": ("data_source", "round(sum(spool_total_bytes_sum) / CAST(1073741824 AS DOUBLE), 6)"),
    "spooled_query_pct": ("query_type", "round(avg(spooled_pct), 4)"),
    "cluster_load_skew": ("cluster_name", "round(avg(queries_per_node_cv), 4)"),
    "hottest_node_query_pct": ("cluster_name", "round(avg(hottest_node_query_pct), 4)"),
    "node_count": ("", "count(DISTINCT node_id)"),
    "cluster_count": ("version", "count(DISTINCT cluster_id)"),
    "attribution_fuzzy_time_window_pct": ("query_type", "round(" + share("attribution_confidence = 'FUZZY_TIME_WINDOW'") + ", 4)"),
    "attribution_unattributed_pct": ("query_type", f"round({share(UNATTR)}, 4)"),
    "attribution_match_rate_pct": ("data_source", "round(" + share("attribution_confidence <> 'UNATTRIBUTED'") + ", 4)"),
    "attribution_coverage_pct": ("", f"round(100 - {share(UNATTR)}, 4)"),
    "triage_coverage_pct": ("data_source", "round(" + share("triage_confidence IN ('EXACT_REQUESTID', 'TIME_WINDOW')") + ", 4)"),
    "failures_with_os_event": ("node_id", counted("failure_layer_os_event")),
    "failure_layer": ("node_id", "CASE WHEN count(DISTINCT failure_layer) = 1 THEN min(failure_layer) ELSE 'Multiple' END"),
    "peak_process_working_set_mb": ("node_id", "max(peak_working_set_mb)"),
    "runaway_processes": ("", counted("runaway_container")),
    "avg_process_working_set_mb": ("", "round(avg(avg_working_set_mb), 3)"),
    "active_items": ("capacity_id", "count(*)"),
    "capacity_count": ("", "count(DISTINCT capacity_id)"),
    "workspace_count": ("item_kind", "count(DISTINCT workspace_id)"),
    "activities": ("operation", "count(*)"),
    "unique_active_users": ("operation", "count(DISTINCT user_id)"),
    "avg_refresh_duration_min": ("workspace_id", "round(avg(duration_seconds / 60), 4)"),
    "refresh_success_pct": ("workspace_id", "round(" + share("status = 'Completed'") + ", 4)"),
    "refresh_failure_count": ("workspace_id", counted("status = 'Failed'")),
    "cu_consumption": ("capacity_id", "round(sum(cu_seconds), 4)"),
    "datasources_in_error": ("cluster_name", counted("status = 'Error'")),
    "datasource_count": ("datasource_type", "count(DISTINCT datasource_id)"),
    "failure_rate_pct": ("data_source", "round(" + share("NOT success") + ", 4)"),
    "sampled_cpu_pct": ("node_id", "round(avg(gateway_cpu), 4)"),
    "sampled_spool_free_pct": ("host_id", "min(free_pct)"),
    "sampled_utilization_pct": ("host_id", "round(avg(utilization_pct), 4)"),
    "sampled_latency_p95_ms": ("host_id", "round(quantile_cont(latency_ms, 0.95), 4)"),
    "sampled_working_set_mb": ("node_id", "max(working_set_mb)"),
}
SQLS["attribution_evaluation_context_pct"] = (
    "query_type", "round(" + share("attribution_confidence = 'EVALUATION_CONTEXT'") + ", 4)")


def add_measure(name, by, aggregate):
    view = VIEW_OF[M.MEASURES[name].table]
    keys = [by] if by else []
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    add(f"measure_{name}", lambda s, d: M.evaluate(Lazy(s, d), name, ctx(), keys),
        f"SELECT {head}{aggregate} AS {name} FROM {view}{tail}")


for _name, (_by, _aggregate) in SQLS.items():
    add_measure(_name, _by, _aggregate)

add("measure_p95_query_duration_ms",
    lambda s, d: M.evaluate(Lazy(s, d), "p95_query_duration_ms", ctx(), ["data_source"]),
    "SELECT data_source, round(quantile_cont(duration_p95_ms, 0.95), 4) AS p95_query_duration_ms FROM gold_perf GROUP BY 1")
# the kinds of the given items stand for the five tenant item kinds
KINDS = {"report_count": "Report", "semantic_model_count": "SemanticModel", "notebook_count": "Notebook",
         "pipeline_count": "DataPipeline", "lakehouse_count": "Lakehouse"}


def tenant_items(s, d):
    kinds = F.array(*[F.lit(k) for k in KINDS.values()])
    return B.items(s, d).withColumn("item_kind", F.element_at(kinds, (F.length("item_kind") % 5 + 1).cast("int")))


VIEWS["tenant_items"] = """SELECT * REPLACE (['Report', 'SemanticModel', 'Notebook', 'DataPipeline', 'Lakehouse']
  [length(item_kind) % 5 + 1] AS item_kind) FROM items"""
add("measure_item_kind_counts",
    lambda s, d: M.evaluate_many({"items": tenant_items(s, d)}, list(KINDS), ctx(), ["capacity_id"]),
    "SELECT capacity_id, " + ", ".join(f"count(*) FILTER (WHERE item_kind = '{k}') AS {n}" for n, k in KINDS.items())
    + " FROM tenant_items GROUP BY 1")


def change_sql(view, month, aggregate, name):
    return f"""WITH m AS (SELECT CAST(date_trunc('month', {month}) AS DATE) AS month, {aggregate} AS {name} FROM {view} GROUP BY 1)
       SELECT c.*, p.{name} AS previous, round(CAST(c.{name} - p.{name} AS DOUBLE) / p.{name} * 100, 2) AS change_pct
       FROM m c LEFT JOIN m p ON c.month = p.month + INTERVAL 1 MONTH"""


add("measure_activities_mom_pct", lambda s, d: M.month_change(Lazy(s, d), "activities", ctx(), "activity_ts"),
    change_sql("activities", "activity_ts", "count(*)", "activities"))
add("measure_active_users_mom_pct", lambda s, d: M.month_change(Lazy(s, d), "unique_active_users", ctx(), "activity_ts"),
    change_sql("activities", "activity_ts", "count(DISTINCT user_id)", "unique_active_users"))
add("measure_cu_mom_pct", lambda s, d: M.month_change(Lazy(s, d), "cu_consumption", ctx(), "usage_date"),
    change_sql("capacities", "usage_date", "round(sum(cu_seconds), 4)", "cu_consumption"))
VIEWS["risk_counts"] = """
SELECT *, nodes_offline + spool_critical + network_saturated + datasources_in_error AS open_risk_count,
  CASE WHEN nodes_offline > 0 THEN 'Gateway node offline' WHEN spool_critical > 0 THEN 'Spool disk critical'
       WHEN network_saturated > 0 THEN 'Network saturated' WHEN datasources_in_error > 0 THEN 'Datasource credential error'
       ELSE 'No open risks' END AS top_risk
FROM (SELECT count(*) FILTER (WHERE heartbeat_age_minutes > 10) AS nodes_offline,
  count(*) FILTER (WHERE spool_free_pct <= 5) AS spool_critical,
  count(*) FILTER (WHERE network_utilization_pct_avg >= 80) AS network_saturated,
  (SELECT count(*) FROM ds_now WHERE status = 'Error') AS datasources_in_error FROM gold_health)"""
add("measure_open_risk_count",
    lambda s, d: M.risks(Lazy(s, d), ctx()).drop("top_risk"), "SELECT * EXCLUDE (top_risk) FROM risk_counts")
add("measure_top_risk", lambda s, d: M.risks(Lazy(s, d), ctx()).select("top_risk"), "SELECT top_risk FROM risk_counts")
add("dataset_reliability", lambda s, d: M.dataset_reliability(refreshables(s, d), 60.0),
    """SELECT dataset_id, count(*) AS refreshes,
       round(count(*) FILTER (WHERE status = 'Completed') * CAST(100 AS DOUBLE) / count(*), 2) AS success_pct,
       round(avg(duration_seconds), 2) AS avg_seconds,
       round(count(*) FILTER (WHERE status = 'Completed') * CAST(100 AS DOUBLE) / count(*), 2) < 60 AS slo_breach
       FROM refresh_gold GROUP BY 1""")
add("capacity_pulse", lambda s, d: M.capacity_pulse(B.capacities(s, d), 200.0),
    """SELECT capacity_id, usage_date, round(sum(cu_seconds), 2) AS cu_seconds,
       round(round(sum(cu_seconds), 2) / 200 * 100, 2) AS budget_pct, round(sum(cu_seconds), 2) > 200 AS over_budget
       FROM capacities GROUP BY 1, 2""")


def page_sql(page):
    parts = []
    for v in M.PAGES[page]:
        if v.measure in M.RISKS:
            view, value = "risk_counts", v.measure
        elif v.measure == "p95_query_duration_ms":
            view, value = "gold_perf", "round(quantile_cont(duration_p95_ms, 0.95), 4)"
        else:
            view = VIEW_OF[v.table or M.MEASURES[v.measure].table]
            value = "count(*)" if v.measure is None else (
                counted(f"item_kind = '{KINDS[v.measure]}'") if v.measure in KINDS else SQLS[v.measure][1])
        if v.change:
            parts.append(f"""SELECT '{v.title}' AS visual, CAST(month AS VARCHAR) AS label, CAST(change_pct AS DOUBLE) AS value
              FROM ({change_sql(view, v.day_of, value, "n")})""")
            continue
        fields = [f"CAST({v.day_of} AS DATE)"] if v.day_of else list(v.by)
        label = " || ' | ' || ".join(f"coalesce(CAST({f} AS VARCHAR), '(blank)')" for f in fields) or "''"
        if v.measure in M.TEXTS:
            label, value = value, "NULL"
        group = f" GROUP BY {', '.join(fields)}" if fields else ""
        parts.append(f"SELECT '{v.title}' AS visual, {label} AS label, CAST({value} AS DOUBLE) AS value FROM {view}{group}")
    return "\nUNION ALL ".join(parts)


for _page in M.PAGES:
    add(f"page_{_page}", (lambda p: lambda s, d: M.page_feed(Lazy(s, d), p, ctx()))(_page), page_sql(_page))

# ---- alert rules -------------------------------------------------------------------------
def txt(column, digits=None):
    value = f"round({column}, 1)" if digits else column
    return f"coalesce(CAST({value} AS VARCHAR), '?')"


def alert_sql(rule, entity, fired, severity, value, message, source):
    return f"""SELECT '{rule}' AS rule, CAST({entity} AS VARCHAR) AS entity, {fired} AS fired_at, {severity} AS severity,
       CAST({value} AS DOUBLE) AS value, {message} AS message FROM {source}"""


OFFLINE_SQL = alert_sql(
    "gateway-offline", "node_id", AS_OF_SQL, "'critical'", "heartbeat_age_minutes",
    f"'Gateway ' || {txt('node_id')} || ' offline: no heartbeat for ' || {txt('heartbeat_age_minutes', 1)} || 'm.'",
    "heartbeat WHERE heartbeat_age_minutes > 10")
add("alert_gateway_offline",
    lambda s, d: A.gateway_offline(R.heartbeat_age(B.inventory(s, d), B.as_of()), B.as_of()), OFFLINE_SQL)
add("alert_message_render",
    lambda s, d: R.heartbeat_age(B.inventory(s, d), B.as_of()).transform(
        lambda df: df.select("node_id", A.render("{node_name} of {cluster_name} ({version}): {heartbeat_age_minutes} min", df).alias("message"))),
    f"""SELECT node_id, node_name || ' of ' || cluster_name || ' (' || version || '): ' ||
       {txt('heartbeat_age_minutes', 1)} || ' min' AS message FROM heartbeat""")
add("alert_gateway_offline_transitions",
    lambda s, d: A.gateway_offline_transitions(B.inventory(s, d).filter("status = 'Live'"), B.as_of(), DEFAULTS.with_overrides(offline_minutes=180.0)),
    f"""SELECT 'gateway-offline' AS rule, node_id, TIMESTAMP '1970-01-01 00:00:00' + (sec - gap_s + 10800) * INTERVAL 1 SECOND AS fired_at,
       TIMESTAMP '1970-01-01 00:00:00' + sec * INTERVAL 1 SECOND AS back_at FROM beats WHERE gap_s > 10800
       UNION ALL SELECT 'gateway-offline', node_id, TIMESTAMP '1970-01-01 00:00:00' + (max(sec) + 10800) * INTERVAL 1 SECOND, NULL
       FROM beats GROUP BY node_id HAVING epoch({AS_OF_SQL}) - max(sec) > 10800""")
LOW_PCT = 40.0
add("alert_spool_low",
    lambda s, d: A.spool_low(R.spool_latest(B.spool(s, d)), B.as_of(), DEFAULTS.with_overrides(spool_warn_pct=90.0, spool_error_pct=LOW_PCT)),
    alert_sql("spool-low", "host_id", AS_OF_SQL, "CASE WHEN spool_free_pct < 40 THEN 'critical' ELSE 'warning' END", "spool_free_pct",
              f"'Spool disk on ' || {txt('host_id')} || ' is at ' || {txt('spool_free_pct', 1)} || '% free.' || "
              f"CASE WHEN spool_stream_mode_warn THEN '{A.STREAM_NOTE}' ELSE '' END", "spool_now WHERE spool_free_pct < 90"))
add("alert_spool_critical",
    lambda s, d: A.spool_critical(R.spool_latest(B.spool(s, d)), B.as_of(), DEFAULTS.with_overrides(spool_error_pct=60.0)),
    alert_sql("spool-critical", "host_id", AS_OF_SQL, "'critical'", "spool_free_pct",
              f"'Spool disk on ' || {txt('host_id')} || ' at ' || {txt('spool_free_pct', 1)} || '% free. Immediate action required.'",
              "spool_now WHERE spool_free_pct < 60").replace(" AS message", " AS message, 2 AS tier, true AS needs_approval"))
add("alert_spool_forecast", lambda s, d: A.spool_forecast(spool_forecast(s, d)),
    alert_sql("spool-forecast", "host_id", "first_breach", "'warning'", "round(lowest, 4)",
              f"'Gateway ' || {txt('host_id')} || ' spool disk forecast to hit ' || {txt('lowest', 1)} || 'GB within 2h.'",
              """(SELECT host_id, min(forecast) AS lowest, min(bin) FILTER (WHERE forecast < 10) AS first_breach
                  FROM spool_forecast GROUP BY 1 HAVING min(forecast) < 10)"""))
DRIFT_SQL = alert_sql(
    "credential-drift", "datasource_id", "third_at", "'warning'", "polls",
    f"'Datasource ' || {txt('datasource_id')} || ' not live for the last ' || {txt('polls')} || ' collection intervals.'",
    "poll_runs WHERE bad AND polls >= 3")
add("alert_credential_drift", lambda s, d: A.credential_drift(B.datasource_polls(s, d)), DRIFT_SQL)
SPIKE_SQL = alert_sql(
    "error-rate-spike", "node_id", "window_start", "'critical'", "error_rate_pct",
    f"'Gateway ' || {txt('node_id')} || ' error rate is ' || {txt('error_rate_pct', 1)} || '% (' || {txt('error_count_5min')} || ' errors in last 5 minutes).'",
    "health5 WHERE error_rate_pct > 25 AND query_count_5min > 1")
ONE = DEFAULTS.with_overrides(error_rate_min_queries=1)
add("alert_error_rate_spike", lambda s, d: A.error_rate_spike(R.health_5min(execs(s, d)), ONE), SPIKE_SQL)
CPU_SQL = alert_sql(
    "cpu-anomaly", "node_id", "bin", "'warning'", "round(score, 4)",
    f"'Gateway ' || {txt('node_id')} || ' CPU anomaly (score ' || {txt('score', 1)} || ') vs seasonal baseline.'",
    "cpu5_scored WHERE flag <> 0 AND score > 2.5")


def cpu_alerts(s, d):
    return A.cpu_anomaly(T.decompose_anomalies(cpu5_series(s, d), ["node_id"], 288))


add("alert_cpu_anomaly", cpu_alerts, CPU_SQL)
add("alert_runaway_process", lambda s, d: A.runaway_process(R.process_health(B.processes(s, d)), B.as_of()),
    alert_sql("process-runaway", "node_id", AS_OF_SQL, "'warning'", "peak_working_set_mb",
              f"'Runaway process on ' || {txt('host_id')} || ' (' || {txt('node_id')} || '): peak ' || {txt('peak_working_set_mb', 1)} || 'MB across ' || {txt('distinct_processes')} || ' processes.'",
              "gold_process WHERE peak_working_set_mb > 6000"))
add("alert_network_saturation",
    lambda s, d: A.network_saturation(health(s, d), B.as_of(), DEFAULTS.with_overrides(network_saturation_pct=20.0)),
    alert_sql("network-saturation", "node_id", AS_OF_SQL, "'warning'", "network_utilization_pct_avg",
              f"'Gateway ' || {txt('node_id')} || ' NIC utilization is ' || {txt('network_utilization_pct_avg', 1)} || '%, latency ' || {txt('latency_ms_p95', 1)} || 'ms (P95).'",
              "gold_health WHERE network_utilization_pct_avg > 20"))
add("alert_circuit_breaker",
    lambda s, d: W.circuit_breaker(B.network(s, d).filter("utilization_pct > 10").select("host_id", "collected_at", "utilization_pct"),
                                   "host_id", "collected_at", DEFAULTS.with_overrides(breaker_fires=1, breaker_window_s=3600)),
    """WITH f AS (SELECT host_id, collected_at, utilization_pct, CAST(floor(epoch(collected_at)) AS BIGINT) AS sec
         FROM network WHERE utilization_pct > 10)
       SELECT a.host_id, a.collected_at, a.utilization_pct, count(*) AS fires_in_window,
         count(*) > 1 AS suppressed, count(*) > 1 AS escalate
       FROM f a JOIN f b ON a.host_id = b.host_id AND b.sec BETWEEN a.sec - 3600 AND a.sec
       GROUP BY a.host_id, a.collected_at, a.utilization_pct""")
add("rule_backtest",
    lambda s, d: A.backtest(A.error_rate_spike(R.health_5min(execs(s, d)), ONE)
                            .unionByName(A.credential_drift(B.datasource_polls(s, d))).unionByName(cpu_alerts(s, d))),
    f"""SELECT rule, CAST(fired_at AS DATE) AS day, count(*) AS fires, count(DISTINCT entity) AS entities
        FROM ({SPIKE_SQL} UNION ALL {DRIFT_SQL} UNION ALL {CPU_SQL}) GROUP BY 1, 2""")
