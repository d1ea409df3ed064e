"""Silver tables: executions, failure triage, identity, network context."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions import scalars as S
from pulsegrid.functions import text as X
from pulsegrid.operators import joins as J
from pulsegrid.operators.dedup import dedup_executions, latest_wins
from pulsegrid.operators.lookup import lookup_join
from pulsegrid.operators.rollups import nic_representative, with_spool_flag
from pulsegrid.operators.timejoin import nearest_match

DISCLAIMER = "Best effort only: not for compliance, billing or security audits."
NOTES = {
    "EVALUATION_CONTEXT": "Artifact named by the evaluation context of the query start.",
    "FUZZY_TIME_WINDOW": "Nearest activity on the same artifact inside the time window.",
    "UNATTRIBUTED": "Neither an evaluation context nor a close activity.",
}


def decoded_starts(starts: DataFrame) -> DataFrame:
    context = X.decode_context(F.col("evaluation_context"))
    return starts.withColumns(
        {
            "artifact_id": X.context_artifact_id(context),
            "artifact_type": X.context_artifact_type(context),
        }
    )


def silver_query_execution(executions: DataFrame, starts: DataFrame | None) -> DataFrame:
    """Replays removed, start and artifact added, spool flag and day added."""
    rows = dedup_executions(executions.drop("artifact_id"))
    if starts is None:
        joined = rows.withColumns(
            {
                "start_ts": F.lit(None).cast("timestamp"),
                "artifact_id": F.lit(None).cast("string"),
                "artifact_type": F.lit(None).cast("string"),
            }
        )
    else:
        joined = J.start_exec_join(rows, decoded_starts(starts))
    return with_spool_flag(joined).withColumn("partition_date", F.to_date("end_ts"))


def failed(silver: DataFrame) -> DataFrame:
    return silver.filter(~F.col("success"))


def latest_refresh_per_request(refreshes: DataFrame) -> DataFrame:
    return latest_wins(
        refreshes.filter(F.col("request_id").isNotNull()),
        ["request_id"],
        [F.col("end_ts").desc_nulls_last(), F.col("dataset_id").desc(), F.col("start_ts").desc()],
    )


def tiered_match(failures: DataFrame, refreshes: DataFrame | None, cfg: Settings = DEFAULTS) -> DataFrame:
    """Refresh of each failure: same request id, else nearest end time, else none.

    Both lookups hang on the same left rows, so the failures are read once per
    lookup and never split and re-united.
    """
    columns = ["dataset_id", "workspace_id", "status", "start_ts", "end_ts", "service_exception"]
    if refreshes is None:
        types = {"start_ts": "timestamp", "end_ts": "timestamp"}
        return failures.withColumns(
            {
                **{f"refresh_{c}": F.lit(None).cast(types.get(c, "string")) for c in columns},
                "refresh_gap_s": F.lit(None).cast("long"),
                "triage_confidence": F.lit("GATEWAY_ONLY"),
                "failure_layer_refresh": F.lit(False),
            }
        )
    exact = latest_refresh_per_request(refreshes).select(
        "request_id", F.struct(*columns).alias("exact")
    )
    near = refreshes.select(F.struct(*columns).alias("near"), F.col("end_ts").alias("near_ts"), "request_id")
    matched = nearest_match(
        lookup_join(failures, exact, [("request_id", "request_id")]),
        near,
        "end_ts",
        "near_ts",
        cfg.refresh_window_s,
        payload=["near"],
        tie=["request_id"],
        gap_col="near_gap_s",
    )
    is_exact, is_near = F.col("exact").isNotNull(), F.col("near").isNotNull()
    picked = F.coalesce("exact", "near")
    return matched.select(
        *failures.columns,
        *[picked[c].alias(f"refresh_{c}") for c in columns],
        F.when(~is_exact, F.col("near_gap_s")).alias("refresh_gap_s"),
        F.when(is_exact, "EXACT_REQUESTID")
        .when(is_near, "TIME_WINDOW")
        .otherwise("GATEWAY_ONLY")
        .alias("triage_confidence"),
        (is_exact | is_near).alias("failure_layer_refresh"),
    )


def host_event_match(rows: DataFrame, os_events: DataFrame | None, cfg: Settings = DEFAULTS) -> DataFrame:
    """Nearest OS error or warning of the same host."""
    if os_events is None:
        return rows.withColumns(
            {
                "evt_time": F.lit(None).cast("timestamp"),
                "os_event_id": F.lit(None).cast("int"),
                "level": F.lit(None).cast("string"),
                "os_event_gap_s": F.lit(None).cast("long"),
                "failure_layer_os_event": F.lit(False),
                "os_event_confidence": F.lit(None).cast("string"),
            }
        )
    serious = os_events.filter(F.col("level").isin("Error", "Warning"))
    matched = nearest_match(
        rows,
        serious,
        "end_ts",
        "evt_time",
        cfg.os_event_window_s,
        on=[("host_id", "host_id")],
        payload=["evt_time", "os_event_id", "level"],
        tie=["record_id"],
        gap_col="os_event_gap_s",
    )
    hit = F.col("os_event_id").isNotNull()
    return matched.withColumns(
        {
            "failure_layer_os_event": hit,
            "os_event_confidence": F.when(hit, "HOST_ONLY"),
        }
    )


def silver_triage(
    silver: DataFrame,
    refreshes: DataFrame | None,
    os_events: DataFrame | None,
    cfg: Settings = DEFAULTS,
    latency: DataFrame | None = None,
) -> DataFrame:
    """Each failure once, with its refresh, its host event and its layer.

    ``latency`` (request_id, tracking_id, latency_ms) adds the network layer.
    """
    base = failed(silver).select(
        "request_id", "tracking_id", "node_id", "host_id", "data_source", "query_type", "end_ts",
        "error_message", "artifact_id", "spool_bytes",
    )
    rows = host_event_match(tiered_match(base, refreshes, cfg), os_events, cfg)
    spike = F.lit(False)
    if latency is not None:
        rows = lookup_join(
            rows,
            latency.select("request_id", "tracking_id", "latency_ms"),
            [("request_id", "request_id"), ("tracking_id", "tracking_id")],
        )
        spike = F.coalesce(F.col("latency_ms") > cfg.latency_ms, F.lit(False))
    return rows.withColumns(
        {
            "failure_layer": F.when(F.col("failure_layer_os_event"), "OS_SERVICE_EVENT")
            .when(F.col("failure_layer_refresh"), "SERVICE_REFRESH_ERROR")
            .when(spike, "NETWORK_LATENCY_SPIKE")
            .when(F.col("error_message").isNotNull(), "GATEWAY_LOG_ERROR")
            .otherwise("UNKNOWN"),
            "partition_date": F.to_date("end_ts"),
        }
    )


def fuzzy_activity_match(rows: DataFrame, activity: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Nearest activity on the same artifact around the start of the query."""
    return nearest_match(
        rows,
        activity,
        "start_ts",
        "activity_ts",
        cfg.activity_window_s,
        on=[("artifact_hint", "activity_artifact")],
        payload=["activity_id", "user_alias", "activity_workspace"],
        tie=["activity_id"],
        gap_col="activity_gap_s",
    )


def silver_identity_attribution(
    silver: DataFrame,
    activity: DataFrame | None,
    monitoring: DataFrame | None = None,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """Every execution once with how far its owner is known."""
    base = silver.select(
        "request_id", "tracking_id", "node_id", "start_ts", "end_ts", "data_source", "query_type",
        "duration_ms", "success", "artifact_id", "artifact_type", "artifact_hint",
    )
    if activity is None:
        rows = base.withColumns(
            {
                "activity_id": F.lit(None).cast("long"),
                "user_alias": F.lit(None).cast("string"),
                "activity_workspace": F.lit(None).cast("long"),
                "activity_gap_s": F.lit(None).cast("long"),
            }
        )
    else:
        # a known artifact needs no activity: its hint is blanked so it finds none
        open_rows = base.withColumn(
            "artifact_hint", F.when(F.col("artifact_id").isNull(), F.col("artifact_hint"))
        )
        rows = fuzzy_activity_match(open_rows, activity, cfg)
    if monitoring is not None:
        rows = J.identity_left_join(rows, monitoring)
    confidence = (
        F.when(F.col("artifact_id").isNotNull(), "EVALUATION_CONTEXT")
        .when(F.col("activity_id").isNotNull(), "FUZZY_TIME_WINDOW")
        .otherwise("UNATTRIBUTED")
    )
    note = F.element_at(
        F.create_map(*[F.lit(x) for pair in NOTES.items() for x in pair]), F.col("attribution_confidence")
    )
    return (
        rows.drop("artifact_hint")
        .withColumn("attribution_confidence", confidence)
        .withColumns(
            {
                "attribution_method_note": note,
                "attribution_disclaimer": F.lit(DISCLAIMER),
                "partition_date": F.to_date("end_ts"),
            }
        )
    )


def silver_network_correlated(silver: DataFrame, network: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Every execution once with the nearest NIC sample of its host."""
    matched = nearest_match(
        silver.select(
            "request_id", "tracking_id", "node_id", "host_id", "data_source", "query_type", "end_ts",
            "duration_ms", "spool_bytes", "success", "error_message",
        ),
        nic_representative(network),
        "end_ts",
        "collected_at",
        cfg.network_window_s,
        on=[("host_id", "host_id")],
        payload=["bytes_per_s_max", "utilization_pct_max", "latency_ms", "bandwidth_bps"],
        gap_col="network_gap_s",
    )
    efficiency = S.transfer_efficiency(
        F.col("spool_bytes"), F.col("duration_ms"), F.col("bytes_per_s_max")
    )
    return matched.withColumns(
        {
            "network_throughput_efficiency": F.round(efficiency, 6),
            "partition_date": F.to_date("end_ts"),
        }
    )


def blast_radius(offline_nodes: DataFrame, executions: DataFrame) -> DataFrame:
    """Distinct artifacts that used an offline node, and how many queries they ran."""
    used = (
        executions.filter(F.col("artifact_id").isNotNull())
        .groupBy("node_id", "artifact_id")
        .agg(F.count(F.lit(1)).alias("queries"), F.max("end_ts").alias("last_used"))
    )
    return used.join(offline_nodes.select("node_id").distinct(), "node_id", "left_semi")


def enriched_fact(
    executions: DataFrame,
    refreshes: DataFrame,
    models: DataFrame,
    activity: DataFrame,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """Executions with the refresh that began shortly before their end, the model
    of that refresh and the nearest user activity on the model's name.

    The band ``start between end - 10 min and end`` looks back only.
    """
    band = nearest_match(
        executions,
        refreshes,
        "end_ts",
        "refresh_start",
        cfg.band_minutes * 60,
        payload=["refresh_model_id", "refresh_start"],
        tie=["refresh_model_id"],
        gap_col="refresh_gap_s",
        forward_s=0,
    )
    copy = models.withColumn("_model", F.col("model_id"))
    named = lookup_join(band, copy, [("refresh_model_id", "_model")]).withColumn(
        "model_key", F.lower("model_name")
    )
    return nearest_match(
        named,
        activity.withColumn("activity_key", F.lower("activity_item")),
        "end_ts",
        "activity_ts",
        cfg.band_minutes * 60,
        on=[("model_key", "activity_key")],
        payload=["activity_user"],
        tie=["activity_user"],
        gap_col="activity_gap_s",
        forward_s=0,
    ).drop("model_key")
