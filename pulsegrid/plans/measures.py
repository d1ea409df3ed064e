"""KPI measures as named aggregates that can be grouped by any column.

``evaluate(tables, name, by, where)`` is the filter context: ``by`` is the field
on the axis, ``where`` the slicer. Measures of one table can be taken together
with ``evaluate_many``, which scans the table once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions import scalars as S
from pulsegrid.operators.quantiles import exact_quantile
from pulsegrid.operators.series import period_over_period


@dataclass(frozen=True)
class Context:
    as_of: Column
    cfg: Settings = DEFAULTS


@dataclass(frozen=True)
class Measure:
    table: str
    build: Callable[[Context], Column]
    digits: int | None = None


def _share(condition: Column) -> Column:
    return S.ratio(F.count_if(condition) * 100.0, F.count(F.lit(1)), 0.0)


def _age(c: Context) -> Column:
    minute = lambda x: F.unix_timestamp(F.date_trunc("minute", x)) / F.lit(60)
    return (minute(c.as_of) - minute(F.max("last_heartbeat_utc"))).cast("long")


def _kind(kind: str) -> Callable[[Context], Column]:
    return lambda c: F.count_if(F.col("item_kind") == kind)


def _in_state(confidence: str) -> Callable[[Context], Column]:
    return lambda c: _share(F.col("attribution_confidence") == confidence)


ROWS = lambda c: F.count(F.lit(1))
MB, GB = 1048576.0, 1073741824.0

MEASURES: dict[str, Measure] = {
    # fleet health
    "heartbeat_age_minutes": Measure("health", _age),
    "gateway_status": Measure("health", lambda c: S.node_status(_age(c), c.cfg)),
    "nodes_offline": Measure("health", lambda c: F.count_if(F.col("heartbeat_age_minutes") > c.cfg.offline_minutes)),
    "error_rate_5min_pct": Measure(
        "health", lambda c: F.avg(F.when(F.col("partition_date") == F.to_date(c.as_of), F.col("error_rate_pct"))), 4),
    "avg_gateway_cpu_pct": Measure("health", lambda c: F.avg("cpu_pct_avg"), 4),
    "avg_gateway_mem_mb": Measure("health", lambda c: F.coalesce(F.avg("mem_kb_avg") / 1024.0, F.lit(0.0)), 4),
    "system_gateway_cpu_gap_pct": Measure("health", lambda c: F.avg("system_cpu_avg") - F.avg("cpu_pct_avg"), 4),
    "spool_free_space_pct": Measure("health", lambda c: F.min("spool_free_pct")),
    "spool_disk_status": Measure("health", lambda c: S.spool_status(F.min("spool_free_pct"), c.cfg)),
    "network_utilization_pct": Measure("health", lambda c: F.avg("network_utilization_pct_avg"), 4),
    "network_latency_p95_ms": Measure("health", lambda c: F.max("latency_ms_p95")),
    "network_status": Measure("health", lambda c: S.network_status(F.avg("network_utilization_pct_avg"), c.cfg)),
    # query performance
    "avg_query_duration_ms": Measure("performance", lambda c: F.avg("duration_avg_ms"), 4),
    "max_query_duration_ms": Measure("performance", lambda c: F.max("duration_max_ms")),
    "gateway_error_rate_pct": Measure(
        "performance", lambda c: S.ratio(F.sum("error_count"), F.sum("query_count"), 0.0) * 100.0, 4),
    "spool_throughput_mb_s": Measure(
        "performance",
        lambda c: S.ratio(
            F.sum("spool_total_bytes_sum") / MB,
            F.sum(F.col("spool_writing_ms_avg") * F.col("query_count")) / 1000.0, 0.0), 4),
    "total_queries": Measure("performance", lambda c: F.sum("query_count")),
    "total_errors": Measure("performance", lambda c: F.sum("error_count")),
    "total_data_spooled_gb": Measure("performance", lambda c: F.sum("spool_total_bytes_sum") / GB, 6),
    "spooled_query_pct": Measure("performance", lambda c: F.avg("spooled_pct"), 4),
    # load
    "cluster_load_skew": Measure("load", lambda c: F.avg("queries_per_node_cv"), 4),
    "hottest_node_query_pct": Measure("load", lambda c: F.avg("hottest_node_query_pct"), 4),
    "node_count": Measure("dimension", lambda c: F.count_distinct("node_id")),
    "cluster_count": Measure("dimension", lambda c: F.count_distinct("cluster_id")),
    # attribution and triage
    "attribution_evaluation_context_pct": Measure("attribution", _in_state("EVALUATION_CONTEXT"), 4),
    "attribution_fuzzy_time_window_pct": Measure("attribution", _in_state("FUZZY_TIME_WINDOW"), 4),
    "attribution_unattributed_pct": Measure("attribution", _in_state("UNATTRIBUTED"), 4),
    "attribution_match_rate_pct": Measure(
        "attribution", lambda c: _share(F.col("attribution_confidence") != "UNATTRIBUTED"), 4),
    "attribution_coverage_pct": Measure(
        "attribution", lambda c: F.lit(100.0) - _share(F.col("attribution_confidence") == "UNATTRIBUTED"), 4),
    "triage_coverage_pct": Measure(
        "triage", lambda c: _share(F.col("triage_confidence").isin("EXACT_REQUESTID", "TIME_WINDOW")), 4),
    "failures_with_os_event": Measure("triage", lambda c: F.count_if("failure_layer_os_event")),
    "failure_layer": Measure(
        "triage",
        lambda c: F.when(F.count_distinct("failure_layer") == 1, F.min("failure_layer")).otherwise("Multiple")),
    # processes
    "peak_process_working_set_mb": Measure("process", lambda c: F.max("peak_working_set_mb")),
    "runaway_processes": Measure("process", lambda c: F.count_if("runaway_container")),
    "avg_process_working_set_mb": Measure("process", lambda c: F.avg("avg_working_set_mb"), 3),
    # tenant
    "active_items": Measure("items", ROWS),
    "capacity_count": Measure("items", lambda c: F.count_distinct("capacity_id")),
    "workspace_count": Measure("items", lambda c: F.count_distinct("workspace_id")),
    "report_count": Measure("items", _kind("Report")),
    "semantic_model_count": Measure("items", _kind("SemanticModel")),
    "notebook_count": Measure("items", _kind("Notebook")),
    "pipeline_count": Measure("items", _kind("DataPipeline")),
    "lakehouse_count": Measure("items", _kind("Lakehouse")),
    "activities": Measure("activities", ROWS),
    "unique_active_users": Measure("activities", lambda c: F.count_distinct("user_id")),
    "avg_refresh_duration_min": Measure("refreshables", lambda c: F.avg(F.col("duration_seconds") / 60.0), 4),
    "refresh_success_pct": Measure("refreshables", lambda c: _share(F.col("status") == "Completed"), 4),
    "refresh_failure_count": Measure("refreshables", lambda c: F.count_if(F.col("status") == "Failed")),
    "cu_consumption": Measure("capacities", lambda c: F.sum("cu_seconds"), 4),
    "datasources_in_error": Measure("datasources", lambda c: F.count_if(F.col("status") == "Error")),
    "datasource_count": Measure("datasources", lambda c: F.count_distinct("datasource_id")),
    # samples with their time, for lines along the date
    "sampled_cpu_pct": Measure("counters", lambda c: F.avg("gateway_cpu"), 4),
    "sampled_spool_free_pct": Measure("spool", lambda c: F.min("free_pct")),
    "sampled_utilization_pct": Measure("network", lambda c: F.avg("utilization_pct"), 4),
    "sampled_latency_p95_ms": Measure(
        "network", lambda c: F.percentile("latency_ms", F.lit(0.95)), 4),
    "sampled_working_set_mb": Measure("processes", lambda c: F.max("working_set_mb")),
    # raw fact
    "failure_rate_pct": Measure("executions", lambda c: _share(~F.col("success")), 4),
}


def _column(name: str, ctx: Context) -> Column:
    measure = MEASURES[name]
    value = measure.build(ctx)
    return (value if measure.digits is None else F.round(value, measure.digits)).alias(name)


def evaluate_many(
    tables: dict[str, DataFrame], names: list[str], ctx: Context, by: list = (), where: Column | None = None
) -> DataFrame:
    """Measures of one table in one aggregate."""
    sources = {MEASURES[n].table for n in names}
    if len(sources) != 1:
        raise ValueError(f"measures of several tables: {sorted(sources)}")
    df = tables[sources.pop()]
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*by).agg(*[_column(n, ctx) for n in names])


def evaluate(tables, name: str, ctx: Context, by: list = (), where: Column | None = None) -> DataFrame:
    if name == "p95_query_duration_ms":
        return p95_query_duration(tables["performance"], list(by), where)
    if name in RISKS:
        return risks(tables, ctx).select(name)
    return evaluate_many(tables, [name], ctx, by, where)


def p95_query_duration(performance: DataFrame, by: list[str], where: Column | None = None) -> DataFrame:
    """Inclusive 95th percentile of the hourly 95th percentiles, exact."""
    rows = performance if where is None else performance.filter(where)
    # a constant would be folded out of the joins and leave a product
    keyed = rows if by else rows.withColumn("all", F.pmod(F.xxhash64("duration_p95_ms"), F.lit(1)))
    out = exact_quantile(keyed, by or ["all"], "duration_p95_ms", 0.95)
    return out.select(*by, F.round("quantile", 4).alias("p95_query_duration_ms"))


def month_change(tables: dict[str, DataFrame], name: str, ctx: Context, time: str) -> DataFrame:
    """A measure per month with its change on the month before."""
    month = F.to_date(F.date_trunc("month", time)).alias("month")
    return period_over_period(evaluate(tables, name, ctx, [month]), "month", name)


RISKS = ("open_risk_count", "top_risk")


def risks(tables: dict[str, DataFrame], ctx: Context) -> DataFrame:
    """The four open-risk counts, their sum and the first one that applies."""
    health = tables["health"].agg(
        F.count_if(F.col("heartbeat_age_minutes") > ctx.cfg.offline_minutes).alias("nodes_offline"),
        F.count_if(F.col("spool_free_pct") <= ctx.cfg.spool_error_pct).alias("spool_critical"),
        F.count_if(F.col("network_utilization_pct_avg") >= ctx.cfg.network_saturation_pct).alias("network_saturated"),
    )
    bad = tables["datasources"].agg(F.count_if(F.col("status") == "Error")).scalar()
    counts = health.withColumn("datasources_in_error", F.coalesce(bad, F.lit(0)).cast("long"))
    names = ["nodes_offline", "spool_critical", "network_saturated", "datasources_in_error"]
    total = F.col(names[0]) + F.col(names[1]) + F.col(names[2]) + F.col(names[3])
    return counts.withColumns(
        {
            "open_risk_count": total,
            "top_risk": F.when(F.col("nodes_offline") > 0, "Gateway node offline")
            .when(F.col("spool_critical") > 0, "Spool disk critical")
            .when(F.col("network_saturated") > 0, "Network saturated")
            .when(F.col("datasources_in_error") > 0, "Datasource credential error")
            .otherwise("No open risks"),
        }
    )


def dataset_reliability(refreshables: DataFrame, min_success_pct: float = 90.0) -> DataFrame:
    """Refresh success per dataset with a flag where the objective is missed."""
    return (
        refreshables.groupBy("dataset_id")
        .agg(
            F.count(F.lit(1)).alias("refreshes"),
            F.round(_share(F.col("status") == "Completed"), 2).alias("success_pct"),
            F.round(F.avg("duration_seconds"), 2).alias("avg_seconds"),
        )
        .withColumn("slo_breach", F.col("success_pct") < min_success_pct)
    )


def capacity_pulse(capacities: DataFrame, budget: float) -> DataFrame:
    """Daily capacity use against a budget."""
    return (
        capacities.groupBy("capacity_id", "usage_date")
        .agg(F.round(F.sum("cu_seconds"), 2).alias("cu_seconds"))
        .withColumn("budget_pct", F.round(F.col("cu_seconds") / F.lit(budget) * 100.0, 2))
        .withColumn("over_budget", F.col("cu_seconds") > budget)
    )


# ---- report pages ---------------------------------------------------------------------


@dataclass(frozen=True)
class Visual:
    """One visual: a measure along fields or the days of a time, or a count of rows by fields.

    With ``change`` it is the measure's change on the month before, by month. A
    measure that is text is the label of its row.
    """

    title: str
    measure: str | None
    by: tuple[str, ...] = ()
    table: str | None = None
    day_of: str | None = None
    change: bool = False


def _cards(*measures: str) -> tuple[Visual, ...]:
    return tuple(Visual(m, m) for m in measures)


TEXTS = ("gateway_status", "spool_disk_status", "network_status", "top_risk")

PAGES: dict[str, tuple[Visual, ...]] = {
    "executive_cockpit": (
        Visual("fleet_status", None, ("status_current",), "dimension"),
        Visual("error_rate", "gateway_error_rate_pct", day_of="hour_utc"),
        Visual("match_rate", "attribution_match_rate_pct"),
        Visual("refresh_success", "refresh_success_pct"),
        *_cards("gateway_error_rate_pct", "active_items", "nodes_offline", "open_risk_count", "top_risk"),
    ),
    "tenant_overview": (
        Visual("items_by_kind", "active_items", ("item_kind",)),
        Visual("workspaces", "workspace_count"),
        Visual("capacity_items", "active_items", ("capacity_id",)),
        Visual("capacities_by_sku", None, ("sku",), "capacities"),
        *_cards("capacity_count", "report_count", "semantic_model_count", "notebook_count", "pipeline_count", "lakehouse_count"),
        Visual("activities_by_month", "activities", day_of="activity_ts"),
        Visual("activities_change", "activities", day_of="activity_ts", change=True),
        Visual("users_by_month", "unique_active_users", day_of="activity_ts"),
        Visual("users_change", "unique_active_users", day_of="activity_ts", change=True),
    ),
    "timeline": (
        Visual("activities", "activities", day_of="activity_ts"),
        Visual("unique_users", "unique_active_users", day_of="activity_ts"),
        Visual("refresh_minutes", "avg_refresh_duration_min", day_of="start_ts"),
        Visual("refresh_failures", "refresh_failure_count", day_of="start_ts"),
    ),
    "fleet_overview": (
        *_cards("node_count", "cluster_count", "avg_gateway_cpu_pct", "cluster_load_skew", "hottest_node_query_pct"),
        Visual("load_skew", "cluster_load_skew", ("cluster_name",)),
        Visual("hottest_node", "hottest_node_query_pct", ("cluster_name",)),
        Visual("fleet_matrix", None, ("node_id", "cluster_name", "version", "status_current"), "dimension"),
        Visual("latency_by_day", "sampled_latency_p95_ms", day_of="collected_at"),
    ),
    "query_identity": (
        *_cards("total_queries", "attribution_match_rate_pct", "avg_query_duration_ms", "p95_query_duration_ms",
                "gateway_error_rate_pct", "attribution_evaluation_context_pct", "attribution_fuzzy_time_window_pct",
                "attribution_unattributed_pct"),
        Visual("queries_by_source", "total_queries", ("data_source", "query_type")),
        Visual("attribution", None, ("attribution_confidence",), "attribution"),
        Visual("top_users", None, ("executing_user",), "attribution"),
        Visual("top_items", None, ("item_name",), "attribution"),
        Visual("query_detail", None, ("data_source", "query_type", "artifact_id"), "attribution"),
    ),
    "failures_triage": (
        *_cards("total_errors", "gateway_error_rate_pct", "triage_coverage_pct", "failures_with_os_event"),
        Visual("failure_layers", None, ("failure_layer",), "triage"),
        Visual("triage_detail", None, ("data_source", "error_message", "failure_layer", "triage_confidence"), "triage"),
        Visual("error_rate", "gateway_error_rate_pct", day_of="hour_utc"),
    ),
    "capacity_spool": (
        *_cards("avg_gateway_cpu_pct", "avg_gateway_mem_mb", "system_gateway_cpu_gap_pct", "spool_free_space_pct",
                "spool_disk_status", "total_data_spooled_gb"),
        Visual("cpu", "avg_gateway_cpu_pct", ("node_id",)),
        Visual("cpu_by_day", "sampled_cpu_pct", day_of="counter_ts"),
        Visual("spool_free", "spool_free_space_pct", ("node_id",)),
        Visual("spool_free_by_day", "sampled_spool_free_pct", day_of="collected_at"),
        Visual("spooled_gb", "total_data_spooled_gb", ("node_id",)),
        Visual("spool_throughput", "spool_throughput_mb_s", ("node_id",)),
        Visual("duration", "avg_query_duration_ms", ("node_id",)),
    ),
    "process_health": (
        *_cards("peak_process_working_set_mb", "runaway_processes", "avg_process_working_set_mb"),
        Visual("peak_working_set", "peak_process_working_set_mb", ("node_id",)),
        Visual("runaway", "runaway_processes", ("node_id",)),
        Visual("working_set_by_day", "sampled_working_set_mb", day_of="collected_at"),
    ),
    "network_bandwidth": (
        *_cards("network_utilization_pct", "network_status", "network_latency_p95_ms"),
        Visual("utilization", "network_utilization_pct", ("node_id",)),
        Visual("latency_p95", "network_latency_p95_ms", ("node_id",)),
        Visual("utilization_by_day", "sampled_utilization_pct", day_of="collected_at"),
        Visual("latency_by_day", "sampled_latency_p95_ms", day_of="collected_at"),
        Visual("spooled_gb", "total_data_spooled_gb", ("node_id",)),
    ),
    "datasource_health": (
        Visual("count", "datasource_count"),
        Visual("in_error", "datasources_in_error"),
        Visual("status_detail", None, ("datasource_name", "datasource_type", "status", "collected_at"), "datasources"),
        Visual("status_by_cluster", None, ("cluster_name", "status"), "datasources"),
    ),
    "refresh_analytics": (
        *_cards("refresh_success_pct", "refresh_failure_count", "avg_refresh_duration_min"),
        Visual("failures_by_dataset", "refresh_failure_count", ("dataset_id",)),
        Visual("minutes_by_dataset", "avg_refresh_duration_min", ("dataset_id",)),
        Visual("refresh_detail", None, ("workspace_id", "dataset_id", "status"), "refreshables"),
    ),
}


def _rows(tables: dict[str, DataFrame], v: Visual, ctx: Context) -> DataFrame:
    """(visual, label, value) of one visual."""
    names = ["month"] if v.change else ["day"] if v.day_of else list(v.by)
    if v.change:
        rows = month_change(tables, v.measure, ctx, v.day_of).select("month", F.col("change_pct").alias("value"))
    else:
        fields = [F.to_date(v.day_of).alias("day")] if v.day_of else [F.col(c) for c in v.by]
        if v.measure is None:
            rows = tables[v.table].groupBy(*fields).agg(F.count(F.lit(1)).alias("value"))
        else:
            rows = evaluate(tables, v.measure, ctx, fields).withColumnRenamed(v.measure, "value")
    label = F.concat_ws(" | ", *[F.coalesce(F.col(n).cast("string"), F.lit("(blank)")) for n in names])
    text = v.measure in TEXTS
    return rows.select(
        F.lit(v.title).alias("visual"),
        (F.col("value") if text else label).alias("label"),
        (F.lit(None) if text else F.col("value")).cast("double").alias("value"),
    )


def _cards_of(tables: dict[str, DataFrame], table: str, cards: list[Visual], ctx: Context) -> DataFrame:
    """All single values of one table from one aggregate."""
    row = evaluate_many(tables, list(dict.fromkeys(v.measure for v in cards)), ctx)
    parts = [
        F.struct(
            F.lit(v.title).alias("visual"),
            (F.col(v.measure) if v.measure in TEXTS else F.lit("")).alias("label"),
            (F.lit(None) if v.measure in TEXTS else F.col(v.measure)).cast("double").alias("value"),
        )
        for v in cards
    ]
    return row.select(F.explode(F.array(*parts)).alias("v")).select("v.*")


def page_feed(tables: dict[str, DataFrame], page: str, ctx: Context) -> DataFrame:
    """All visuals of a page as rows (visual, label, value); the cards of one table share its scan."""
    cards: dict[str, list[Visual]] = {}
    parts = []
    for v in PAGES[page]:
        if v.measure in MEASURES and not v.by and not v.day_of:
            cards.setdefault(MEASURES[v.measure].table, []).append(v)
        else:
            parts.append(_rows(tables, v, ctx))
    parts += [_cards_of(tables, table, own, ctx) for table, own in cards.items()]
    feed = parts[0]
    for part in parts[1:]:
        feed = feed.unionByName(part)
    return feed
