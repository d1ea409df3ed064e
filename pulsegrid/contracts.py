"""Column contracts of the tables, checked at layer borders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Landing header -> (engine column, type).
QUERY_EXECUTION = {
    "GatewayObjectId": ("node_id", "string"),
    "RequestId": ("request_id", "string"),
    "DataSource": ("data_source", "string"),
    "QueryTrackingId": ("tracking_id", "string"),
    "QueryExecutionEndTimeUTC": ("end_ts", "timestamp"),
    "QueryExecutionDuration(ms)": ("duration_ms", "bigint"),
    "QueryType": ("query_type", "string"),
    "DataProcessingEndTimeUTC": ("processing_end_ts", "timestamp"),
    "DataProcessingDuration(ms)": ("processing_ms", "bigint"),
    "Success": ("success", "boolean"),
    "ErrorMessage": ("error_message", "string"),
    "SpoolingDiskWritingDuration(ms)": ("spool_write_ms", "bigint"),
    "SpoolingDiskReadingDuration(ms)": ("spool_read_ms", "bigint"),
    "SpoolingTotalDataSize(bytes)": ("spool_bytes", "bigint"),
    "DataReadingAndSerializationDuration(ms)": ("data_read_ms", "bigint"),
    "DiskRead(byte/sec)": ("disk_read_bps", "double"),
    "DiskWrite(byte/sec)": ("disk_write_bps", "double"),
}
QUERY_START = {
    "GatewayObjectId": ("node_id", "string"),
    "RequestId": ("request_id", "string"),
    "QueryTrackingId": ("tracking_id", "string"),
    "QueryStartTimeUTC": ("start_ts", "timestamp"),
    "QueryType": ("query_type", "string"),
    "DataSource": ("data_source", "string"),
    "EvaluationContext": ("evaluation_context", "string"),
}
SYSTEM_COUNTER = {
    "GatewayObjectId": ("node_id", "string"),
    "CounterTimeUTC": ("counter_ts", "timestamp"),
    "SystemCPUPercent": ("system_cpu", "double"),
    "SystemMEMUsedPercent": ("system_mem_pct", "double"),
    "GatewayCPUPercent": ("gateway_cpu", "double"),
    "GatewayMEMKb": ("gateway_mem_kb", "bigint"),
}
QUERY_AGGREGATION = {
    "GatewayObjectId": ("node_id", "string"),
    "AggregationStartTimeUTC": ("window_start_ts", "timestamp"),
    "AggregationEndTimeUTC": ("window_end_ts", "timestamp"),
    "DataSource": ("data_source", "string"),
    "Success": ("success", "boolean"),
    "AverageQueryExecutionDuration(ms)": ("duration_avg_ms", "double"),
    "MaxQueryExecutionDuration(ms)": ("duration_max_ms", "bigint"),
    "MinQueryExecutionDuration(ms)": ("duration_min_ms", "bigint"),
    "QueryType": ("query_type", "string"),
    "AverageDataProcessingDuration(ms)": ("processing_avg_ms", "double"),
    "MaxDataProcessingDuration(ms)": ("processing_max_ms", "bigint"),
    "MinDataProcessingDuration(ms)": ("processing_min_ms", "bigint"),
    "Count": ("query_count", "bigint"),
}
LOG_HEADERS = {
    "QueryAggregation": QUERY_AGGREGATION,
    "QueryExecution": QUERY_EXECUTION,
    "QueryStart": QUERY_START,
    "SystemCounter": SYSTEM_COUNTER,
}

# Columns a table must have; more are allowed.
REQUIRED = {
    "bronze_query_execution": "request_id string, tracking_id string, node_id string, end_ts timestamp, "
    "duration_ms bigint, success boolean, error_message string, spool_bytes bigint, partition_date date",
    "bronze_query_start": "request_id string, start_ts timestamp, evaluation_context string",
    "bronze_system_counter": "node_id string, counter_ts timestamp, system_cpu double, gateway_cpu double, "
    "gateway_mem_kb bigint",
    "bronze_query_aggregation": "node_id string, window_start_ts timestamp, window_end_ts timestamp, "
    "data_source string, query_type string, success boolean, query_count bigint, partition_date date",
    "bronze_network_metrics": "host_id string, nic string, collected_at timestamp, bytes_per_s double, "
    "utilization_pct double, latency_ms double, bandwidth_bps double, partition_date date",
    "bronze_event_log": "host_id string, evt_time timestamp, os_event_id int, level string, message string, "
    "event_source string, partition_date date",
    "bronze_activity": "activity_id string, user_alias string, activity_ts timestamp, activity_artifact string, "
    "activity_workspace string, partition_date date",
    "bronze_monitoring": "operation_id string, operation_name string, mon_ts timestamp, record_id string, "
    "executing_user string, item_name string, workspace_id string, partition_date date",
    "bronze_disk_spool": "host_id string, collected_at timestamp, free_bytes bigint, free_pct double, "
    "spool_dir_bytes bigint, stream_mode_warn boolean, partition_date date",
    "bronze_inventory": "node_id string, cluster_id string, cluster_name string, node_name string, status string, "
    "version string, datasource_count int, collected_at timestamp, partition_date date",
    "bronze_datasources": "datasource_id string, datasource_name string, datasource_type string, "
    "cluster_name string, status string, collected_at timestamp, partition_date date",
    "bronze_refresh_history": "request_id string, dataset_id string, workspace_id string, status string, "
    "start_ts timestamp, end_ts timestamp, service_exception string, partition_date date",
    "bronze_processes": "node_id string, host_id string, process_id bigint, working_set_mb double, "
    "cpu_pct double, is_container boolean, collected_at timestamp, partition_date date",
    "gold_gateway_health": "node_id string, last_heartbeat_utc timestamp, heartbeat_age_minutes double, "
    "cpu_pct_avg double, system_cpu_avg double, mem_kb_avg double, spool_free_pct double, "
    "network_utilization_pct_avg double, latency_ms_p95 double, error_rate_pct double, partition_date date",
    "gold_query_performance": "hour_utc timestamp, data_source string, query_type string, query_count bigint, "
    "error_count bigint, error_rate_pct double, duration_avg_ms double, duration_p95_ms double, "
    "duration_max_ms bigint, spool_total_bytes_sum bigint, spool_writing_ms_avg double, spooled_pct double",
    "gold_cluster_load": "cluster_name string, queries_per_node_cv double, hottest_node_query_pct double, "
    "node_count bigint",
    "gold_dim_gateway": "node_id string, cluster_id string, cluster_name string, node_name string, "
    "status_current string, version string, valid_from timestamp, is_current boolean",
    "silver_triage": "request_id string, data_source string, error_message string, failure_layer string, "
    "triage_confidence string, failure_layer_os_event boolean",
    "silver_identity_attribution": "request_id string, artifact_id string, attribution_confidence string",
    "silver_network_correlated": "request_id string, network_throughput_efficiency double",
    "gold_process_health": "node_id string, host_id string, peak_working_set_mb double, "
    "avg_working_set_mb double, runaway_container boolean",
    "gold_datasources": "datasource_id string, datasource_name string, datasource_type string, "
    "cluster_name string, status string",
    "gold_capacities": "capacity_id string, cu_seconds double",
    "gold_activities": "activity_id string, user_id string, operation string, activity_date timestamp",
    "gold_inventory": "item_id string, item_name string, item_kind string, workspace_id string, "
    "workspace_name string, capacity_id string",
    "gold_refreshables": "dataset_id string, dataset_name string, workspace_id string, status string, "
    "duration_seconds double, refresh_date timestamp",
}


# Engine column -> name in the report model.
REPORT_NAMES = {
    "node_id": "GatewayObjectId",
    "node_name": "GatewayNodeName",
    "host_id": "HostName",
    "cluster_id": "GatewayClusterId",
    "cluster_name": "GatewayClusterName",
    "version": "Version",
    "request_id": "RequestId",
    "tracking_id": "QueryTrackingId",
    "data_source": "DataSource",
    "query_type": "QueryType",
    "error_message": "ErrorMessage",
    "executing_user": "ExecutingUser",
    "item_id": "ItemId",
    "item_name": "ItemName",
    "item_kind": "ItemKind",
    "workspace_id": "WorkspaceId",
    "workspace_name": "WorkspaceName",
    "capacity_id": "CapacityId",
    "capacity_name": "CapacityName",
    "region": "Region",
    "sku": "Sku",
    "activity_id": "ActivityId",
    "user_id": "UserId",
    "operation": "Operation",
    "activity_date": "ActivityDate",
    "dataset_id": "DatasetId",
    "dataset_name": "DatasetName",
    "refresh_date": "RefreshDate",
    "datasource_id": "DatasourceId",
    "datasource_name": "DatasourceName",
    "datasource_type": "DatasourceType",
    "last_updated": "LastUpdated",
    "status": "Status",
    "partition_date": "_partition_date",
}


def report_names(df: DataFrame) -> DataFrame:
    """Columns under the names the report model uses."""
    return df.withColumnsRenamed(REPORT_NAMES)


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(REQUIRED[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """No rows, but the contract's columns and types."""
    return spark.createDataFrame([], schema_of(table))


def contract_gaps(df: DataFrame, table: str) -> list[str]:
    """Missing columns and columns of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [
        f"{f.name} {f.dataType.simpleString()}"
        for f in schema_of(table).fields
        if have.get(f.name) != f.dataType
    ]


def contract_check(df: DataFrame, table: str) -> DataFrame:
    gaps = contract_gaps(df, table)
    if gaps:
        raise ValueError(f"{table} does not meet its contract: {', '.join(gaps)}")
    return df


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, column_type string")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Contract columns first, absent ones as typed nulls."""
    fields = schema_of(table).fields
    have = set(df.columns)
    known = [
        F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in fields
    ]
    names = {f.name for f in fields}
    return df.select(*known, *[F.col(f"`{c}`") for c in df.columns if c not in names])
