"""Grouped aggregates: performance, health, load, processes, match rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions import scalars as S
from pulsegrid.functions.text import not_empty

#: Error bound of the percentile sketch is 1/ACCURACY of the group's rows; its
#: size is bounded, so a node with a third of all rows still fits one buffer.
ACCURACY = 10000


def n_rows() -> Column:
    return F.count(F.lit(1))


def p95(col: Column) -> Column:
    return F.percentile_approx(col, F.lit(0.95), F.lit(ACCURACY))


def failures() -> Column:
    return F.count_if(~F.col("success"))


# Name -> aggregate, the vocabulary every rollup is written in.
def named_aggs(
    count: str | None = None,
    sums: dict[str, Column] | None = None,
    means: dict[str, Column] | None = None,
    lows: dict[str, Column] | None = None,
    highs: dict[str, Column] | None = None,
    counts_if: dict[str, Column] | None = None,
    distincts: dict[str, Column] | None = None,
    deviations: dict[str, Column] | None = None,
    p95s: dict[str, Column] | None = None,
) -> list[Column]:
    """Aggregate columns by kind; ``distincts`` skip null and empty text."""
    made = [n_rows().alias(count)] if count else []
    kinds = [
        (sums, F.sum),
        (means, F.avg),
        (lows, F.min),
        (highs, F.max),
        (counts_if, F.count_if),
        (distincts, F.count_distinct),
        (deviations, F.stddev_samp),
        (p95s, p95),
    ]
    for columns, build in kinds:
        made += [build(col).alias(name) for name, col in (columns or {}).items()]
    return made


def with_spool_flag(executions: DataFrame) -> DataFrame:
    return executions.withColumn("is_spooled", F.col("spool_bytes") > 0)


def query_performance(
    executions: DataFrame, by: list[str] = ("node_id", "data_source", "query_type")
) -> DataFrame:
    """Hourly counts, error share, durations and spool use per ``by`` group."""
    rows = executions.select(
        *by,
        F.date_trunc("hour", "end_ts").alias("hour_utc"),
        "success",
        "duration_ms",
        "spool_bytes",
        "spool_write_ms",
        "data_read_ms",
        "disk_read_bps",
        "disk_write_bps",
    )
    grouped = rows.groupBy(*by, "hour_utc").agg(
        *named_aggs(
            count="query_count",
            counts_if={"error_count": ~F.col("success"), "spooled_count": F.col("spool_bytes") > 0},
            means={
                "duration_avg": F.col("duration_ms"),
                "spool_writing_avg": F.col("spool_write_ms"),
                "data_reading_avg": F.col("data_read_ms"),
                "disk_read_avg": F.col("disk_read_bps"),
                "disk_write_avg": F.col("disk_write_bps"),
            },
            highs={"duration_max_ms": F.col("duration_ms")},
            sums={"spool_total_bytes_sum": F.col("spool_bytes")},
            p95s={"duration_p95": F.col("duration_ms")},
        )
    )
    return grouped.select(
        *by,
        "hour_utc",
        "query_count",
        "error_count",
        S.percent(F.col("error_count"), F.col("query_count")).alias("error_rate_pct"),
        F.round("duration_avg", 0).alias("duration_avg_ms"),
        F.col("duration_p95").cast("double").alias("duration_p95_ms"),
        "duration_max_ms",
        "spool_total_bytes_sum",
        F.round("spool_writing_avg", 0).alias("spool_writing_ms_avg"),
        F.round("data_reading_avg", 0).alias("data_reading_ms_avg"),
        F.round("disk_read_avg", 2).alias("disk_read_bps_avg"),
        F.round("disk_write_avg", 2).alias("disk_write_bps_avg"),
        S.percent(F.col("spooled_count"), F.col("query_count")).alias("spooled_pct"),
        F.to_date("hour_utc").alias("partition_date"),
    )


def health_5min(executions: DataFrame) -> DataFrame:
    return (
        executions.groupBy("node_id", F.window("end_ts", "5 minutes").alias("w"))
        .agg(
            *named_aggs(
                count="query_count_5min",
                counts_if={"error_count_5min": ~F.col("success")},
                means={"duration_avg_ms": F.col("duration_ms")},
                p95s={"duration_p95_ms": F.col("duration_ms")},
            )
        )
        .select(
            "node_id",
            F.col("w.start").alias("window_start"),
            "query_count_5min",
            "error_count_5min",
            F.round("duration_avg_ms", 2).alias("duration_avg_ms"),
            F.col("duration_p95_ms").cast("long").alias("duration_p95_ms"),
            S.percent(F.col("error_count_5min"), F.col("query_count_5min")).alias("error_rate_pct"),
        )
    )


def newest_of(df: DataFrame, keys: list[str], time: str, tie: list[str] = ()) -> DataFrame:
    """Newest row per key as one ``max`` of a struct: combines before the exchange."""
    rest = [c for c in df.columns if c not in keys and c != time and c not in tie]
    packed = F.struct(time, *tie, *rest)
    return (
        df.groupBy(*keys)
        .agg(F.max(packed).alias("m"))
        .select(*[F.col(c) if c in keys else F.col(f"m.{c}").alias(c) for c in df.columns])
    )


def latest_window_per_node(executions: DataFrame) -> DataFrame:
    return newest_of(health_5min(executions), ["node_id"], "window_start")


def heartbeat_age(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Last ``Live`` poll per node with the names of that poll, and its age."""
    live = inventory.filter("status = 'Live'").select(
        "node_id", "collected_at", "record_id", "cluster_name", "node_name", "host_id", "status",
        "version",
    )
    return newest_of(live, ["node_id"], "collected_at", ["record_id"]).select(
        "node_id",
        F.col("collected_at").alias("last_heartbeat_utc"),
        "cluster_name",
        "node_name",
        "host_id",
        F.col("status").alias("status_current"),
        "version",
        F.round(S.minutes_between(F.col("collected_at"), as_of), 4).alias("heartbeat_age_minutes"),
    )


def counter_rollup(counters: DataFrame) -> DataFrame:
    return counters.groupBy("node_id").agg(
        F.round(F.avg("gateway_cpu"), 4).alias("cpu_pct_avg"),
        F.round(F.avg("gateway_mem_kb"), 2).alias("mem_kb_avg"),
        F.round(F.avg("system_cpu"), 4).alias("system_cpu_avg"),
        F.max("counter_ts").alias("last_counter_utc"),
    )


def spool_latest(spool: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    rows = spool.select(
        "host_id", "collected_at", "record_id", "free_pct", "spool_dir_bytes", "stream_mode_warn"
    )
    return newest_of(rows, ["host_id"], "collected_at", ["record_id"]).select(
        "host_id",
        F.col("free_pct").alias("spool_free_pct"),
        F.col("spool_dir_bytes").alias("spool_dir_size_bytes"),
        S.disk_level(F.col("free_pct"), cfg).alias("spool_alert_level"),
        F.col("stream_mode_warn").alias("spool_stream_mode_warn"),
    )


def network_rollup(correlated: DataFrame) -> DataFrame:
    """Per node over executions that found a network sample."""
    return correlated.groupBy("node_id").agg(
        F.round(F.avg("bytes_per_s_max"), 2).alias("nic_bytes_per_sec_avg"),
        F.round(F.avg("latency_ms"), 4).alias("latency_ms_avg"),
        p95(F.col("latency_ms")).alias("latency_ms_p95"),
        F.round(F.avg("utilization_pct_max"), 4).alias("network_utilization_pct_avg"),
    )


def nic_utilization(network: DataFrame, per: str = "hour") -> DataFrame:
    """Average throughput of each physical adapter per host and period, in percent of its bandwidth."""
    return (
        network.filter(S.physical_adapter(F.col("nic")))
        .groupBy("host_id", "nic", F.date_trunc(per, "collected_at").alias(per))
        .agg(F.avg("bytes_per_s").alias("b"), F.avg("bandwidth_bps").alias("w"), F.count(F.lit(1)).alias("samples"))
        .select("host_id", "nic", per, "samples", F.round(S.utilization_pct(F.col("b"), F.col("w")), 4).alias("utilization_pct"))
    )


def nic_representative(network: DataFrame) -> DataFrame:
    """One row per (host, sample time): the busiest NIC stands for the host; virtual adapters do not count."""
    real = network.filter(S.physical_adapter(F.col("nic"))) if "nic" in network.columns else network
    return real.groupBy("host_id", "collected_at").agg(
        F.max("bytes_per_s").alias("bytes_per_s_max"),
        F.max("utilization_pct").alias("utilization_pct_max"),
        F.max("latency_ms").alias("latency_ms"),
        F.max("bandwidth_bps").alias("bandwidth_bps"),
    )


def gateway_health(
    executions: DataFrame,
    inventory: DataFrame,
    counters: DataFrame,
    spool: DataFrame,
    correlated: DataFrame,
    as_of: Column,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """One row per node. Each side is unique per join key, so rows cannot multiply."""
    return (
        heartbeat_age(inventory, as_of)
        .join(latest_window_per_node(executions), "node_id", "left")
        .join(counter_rollup(counters), "node_id", "left")
        .join(spool_latest(spool, cfg), "host_id", "left")
        .join(network_rollup(correlated), "node_id", "left")
        .withColumn("partition_date", F.to_date("last_heartbeat_utc"))
    )


def cluster_map(inventory: DataFrame) -> DataFrame:
    """Newest cluster of each node."""
    rows = inventory.select("node_id", "collected_at", "record_id", "cluster_id", "cluster_name")
    return newest_of(rows, ["node_id"], "collected_at", ["record_id"]).select(
        "node_id", "cluster_id", "cluster_name"
    )


def cluster_load(
    executions: DataFrame, nodes: DataFrame, cfg: Settings = DEFAULTS
) -> DataFrame:
    """Hourly load spread over the nodes of a cluster.

    Executions shrink to node-hours before the node lookup; the hottest node
    comes out of the same aggregate, ties to the smallest id.
    """
    hourly = (
        executions.groupBy("node_id", F.date_trunc("hour", "end_ts").alias("hour_utc"))
        .agg(n_rows().alias("node_queries"))
        .join(nodes, "node_id")
    )
    grouped = hourly.groupBy("cluster_id", "cluster_name", "hour_utc").agg(
        F.count("node_id").alias("node_count"),
        F.avg("node_queries").alias("mean"),
        F.stddev_samp("node_queries").alias("deviation"),
        F.max("node_queries").alias("max_node_queries"),
        F.sum("node_queries").alias("total_cluster_queries"),
        F.min(F.struct(-F.col("node_queries"), "node_id")).alias("hot"),
    )
    cv = F.when(
        (F.col("mean") > 0) & (F.col("node_count") > 1), F.round(F.col("deviation") / F.col("mean"), 3)
    )
    return grouped.select(
        "cluster_id",
        "cluster_name",
        "hour_utc",
        "node_count",
        F.round("mean", 4).alias("node_query_mean"),
        F.round("deviation", 4).alias("node_query_stddev"),
        "max_node_queries",
        "total_cluster_queries",
        cv.alias("queries_per_node_cv"),
        S.skew_class(cv, cfg).alias("load_skew_classification"),
        F.col("hot.node_id").alias("hottest_node_id"),
        F.round(F.col("max_node_queries") / F.col("total_cluster_queries") * 100.0, 1).alias(
            "hottest_node_query_pct"
        ),
        F.to_date("hour_utc").alias("partition_date"),
    )


def load_skew(executions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Spread of load over all nodes in the rows given."""
    per_node = executions.groupBy("node_id").agg(n_rows().alias("n"))
    cv = F.try_divide(F.stddev_samp("n"), F.avg("n"))
    return per_node.agg(
        F.round(cv, 4).alias("load_skew_cv"),
        n_rows().alias("nodes"),
        F.coalesce(cv > threshold, F.lit(False)).alias("skew_alert"),
    )


def max_min_skew(executions: DataFrame) -> DataFrame:
    per_node = executions.groupBy("node_id").agg(n_rows().alias("n"), failures().alias("bad"))
    return per_node.agg(
        F.max("n").alias("max_node_queries"),
        F.min("n").alias("min_node_queries"),
        F.round(F.max("n") / F.min("n"), 4).alias("max_min_ratio"),
        F.round(F.max(F.col("bad") / F.col("n")) * 100.0, 2).alias("worst_failure_pct"),
    )


def process_health(samples: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return (
        samples.groupBy("node_id", "host_id")
        .agg(
            F.max("working_set_mb").alias("peak_working_set_mb"),
            F.round(F.avg("working_set_mb"), 4).alias("avg_working_set_mb"),
            F.max("cpu_pct").alias("peak_cpu_pct"),
            F.count_distinct("process_id").alias("distinct_processes"),
            F.count_if("is_container").alias("container_samples"),
        )
        .withColumn("runaway_container", F.col("peak_working_set_mb") > cfg.runaway_mb)
    )


def match_rate(joined: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of executions with an owner; ``joined`` has one row per execution."""
    owned = not_empty(F.col("executing_user"))
    return (
        joined.groupBy(*by)
        .agg(
            n_rows().alias("total_queries"),
            F.count_if(owned).alias("attributed_queries"),
            F.count_distinct(F.when(owned, F.col("executing_user"))).alias("distinct_users"),
            F.count_distinct(F.when(not_empty(F.col("item_name")), F.col("item_name"))).alias(
                "distinct_items"
            ),
        )
        .withColumn(
            "match_rate_pct",
            F.round(S.ratio(F.col("attributed_queries") * 100.0, F.col("total_queries")), 1),
        )
    )


def capacity_usage(usage: DataFrame, by: list[str]) -> DataFrame:
    return usage.groupBy(*by).agg(F.round(F.sum("cu_seconds"), 4).alias("cu_seconds"))


def source_routing(executions: DataFrame) -> DataFrame:
    """Volumes per (source, node, cluster) and their share of the source."""
    routes = executions.groupBy("data_source", "node_id", "cluster_id").agg(
        n_rows().alias("queries"), F.sum("spool_bytes").alias("spool_bytes")
    )
    per_source = routes.groupBy("data_source").agg(F.sum("queries").alias("source_queries"))
    return routes.join(per_source, "data_source").select(
        "data_source",
        "node_id",
        "cluster_id",
        "queries",
        "spool_bytes",
        F.round(F.col("queries") * 100.0 / F.col("source_queries"), 2).alias("source_share_pct"),
    )


def retry_profile(executions: DataFrame) -> DataFrame:
    """Attempts per request and the outcome of the last one."""
    return executions.groupBy("request_id").agg(
        n_rows().alias("attempts"),
        F.count_distinct("tracking_id").alias("tracking_ids"),
        F.count_if(~F.col("success")).alias("failed_attempts"),
        F.max_by("success", F.struct("end_ts", "duration_ms", "success")).alias("last_success"),
    )


def time_split(executions: DataFrame, by: list[str]) -> DataFrame:
    """Share of reading, processing and spooling in the duration."""
    total = F.sum("duration_ms")
    return executions.groupBy(*by).agg(
        total.alias("duration_ms"),
        F.round(S.ratio(F.sum("data_read_ms") * 100.0, total), 2).alias("read_pct"),
        F.round(S.ratio(F.sum("processing_ms") * 100.0, total), 2).alias("processing_pct"),
        F.round(
            S.ratio((F.sum("spool_write_ms") + F.sum("spool_read_ms")) * 100.0, total), 2
        ).alias("spool_pct"),
    )


def fleet_profile(dimension: DataFrame) -> DataFrame:
    """Nodes by version, status and cluster, with subtotals."""
    return (
        dimension.cube("version", "status", "cluster_name")
        .agg(n_rows().alias("nodes"), F.grouping_id().cast("int").alias("level"))
    )


def audit_rollup(audit: DataFrame) -> DataFrame:
    """API calls per path and status with the failure share of the path."""
    per_status = audit.groupBy("api_path", "status_code").agg(
        n_rows().alias("calls"), F.sum("row_count").alias("rows")
    )
    per_path = per_status.groupBy("api_path").agg(
        F.sum("calls").alias("path_calls"),
        F.sum(F.when(F.col("status_code") != 200, F.col("calls")).otherwise(0)).alias("bad"),
    )
    return per_status.join(per_path, "api_path").select(
        "api_path",
        "status_code",
        "calls",
        "rows",
        F.round(F.col("bad") * 100.0 / F.col("path_calls"), 2).alias("path_failure_pct"),
    )


def job_durations(audit: DataFrame) -> DataFrame:
    """START and END of a job paired by one aggregate."""
    return (
        audit.groupBy("job_id")
        .agg(
            F.min(F.when(F.col("job_event") == "START", F.col("audit_ts"))).alias("started"),
            F.max(F.when(F.col("job_event") == "END", F.col("audit_ts"))).alias("ended"),
        )
        .withColumn("seconds", S.epoch(F.col("ended")) - S.epoch(F.col("started")))
    )


def fingerprint_rollup(executions: DataFrame) -> DataFrame:
    """Impact per query shape; source, type and duration class stand for the text."""
    shape = F.concat_ws(
        "|",
        F.col("data_source").cast("string"),
        F.col("query_type"),
        F.floor(F.log10(F.col("duration_ms") + 1)).cast("string"),
    )
    return (
        executions.groupBy(F.sha2(shape, 256).alias("fingerprint"), shape.alias("shape"))
        .agg(
            n_rows().alias("queries"),
            F.round(F.avg("duration_ms"), 2).alias("duration_avg_ms"),
            p95(F.col("duration_ms")).alias("duration_p95_ms"),
            F.round(failures() * 100.0 / n_rows(), 2).alias("failure_pct"),
        )
        .withColumn("impact", F.col("duration_p95_ms") * F.col("queries"))
    )
