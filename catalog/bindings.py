"""Telemetry views over the given parquet tables, as DataFrames and as SQL.

``VIEWS`` holds the SQL twin of each function; ``sql`` puts the needed ones in
front of a query as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pulsegrid.session import prepare

AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
ORDERS_AS_OF = "2001-12-01 00:00:00"

VIEWS: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}  # the given tables do not change: read each footer once


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One given table; zone-less timestamps become UTC timestamps at the scan."""
    path = f"{sf_dir}/{table}.parquet"
    reader = prepare(spark).read
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = reader.schema(_SCHEMAS[path]).parquet(path)
    zoneless = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoneless}) if zoneless else df


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("user_id") % 6).alias("node_id"),
    )


VIEWS["ev"] = """
SELECT event_id, ts, user_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k,
       user_id % 6 AS node_id FROM events"""


def _error_message():
    return (
        F.when(F.col("event_type") != "error", None)
        .when(F.col("k") % 5 == 0, "Timeout expired, retry failed")
        .when(F.col("k") % 5 == 1, "Login failed for user")
        .when(F.col("k") % 5 == 2, "Spool limit exceeded")
        .when(F.col("k") % 5 == 3, "Network path not reachable")
        .otherwise("The operation was canceled.")
    )


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)
    ms = F.floor(F.col("value") * 1000).cast("long")
    k = F.col("k")
    return ev(spark, sf_dir).select(
        request.alias("request_id"),
        (request % 97).alias("tracking_id"),
        "node_id",
        F.col("node_id").alias("host_id"),
        (F.col("user_id") % 2).alias("cluster_id"),
        (k % 5).alias("data_source"),
        F.when(k % 4 == 0, "DirectQuery").otherwise("Refresh").alias("query_type"),
        F.col("ts").alias("end_ts"),
        ms.alias("duration_ms"),
        (F.col("event_type") != "error").alias("success"),
        _error_message().alias("error_message"),
        F.when(k % 3 == 0, F.lit(0)).otherwise(k.cast("long") * 1048576).alias("spool_bytes"),
        F.floor(ms / 5).alias("spool_write_ms"),
        F.floor(ms / 10).alias("spool_read_ms"),
        F.floor(ms / 4).alias("data_read_ms"),
        F.floor(ms / 2).alias("processing_ms"),
        (F.col("value") * 1000.0).alias("disk_read_bps"),
        (F.col("value") * 500.0).alias("disk_write_bps"),
        F.when(k % 4 < 3, k % 6).alias("artifact_id"),
        (k % 6).alias("artifact_hint"),
    )


VIEWS["executions"] = """
SELECT event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS request_id,
       (event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END)) % 97 AS tracking_id,
       node_id, node_id AS host_id, user_id % 2 AS cluster_id, k % 5 AS data_source,
       CASE WHEN k % 4 = 0 THEN 'DirectQuery' ELSE 'Refresh' END AS query_type,
       ts AS end_ts, CAST(floor(value * 1000) AS BIGINT) AS duration_ms,
       event_type <> 'error' AS success,
       CASE WHEN event_type <> 'error' THEN NULL
            WHEN k % 5 = 0 THEN 'Timeout expired, retry failed'
            WHEN k % 5 = 1 THEN 'Login failed for user'
            WHEN k % 5 = 2 THEN 'Spool limit exceeded'
            WHEN k % 5 = 3 THEN 'Network path not reachable'
            ELSE 'The operation was canceled.' END AS error_message,
       CASE WHEN k % 3 = 0 THEN 0 ELSE CAST(k AS BIGINT) * 1048576 END AS spool_bytes,
       CAST(floor(value * 1000) AS BIGINT) // 5 AS spool_write_ms,
       CAST(floor(value * 1000) AS BIGINT) // 10 AS spool_read_ms,
       CAST(floor(value * 1000) AS BIGINT) // 4 AS data_read_ms,
       CAST(floor(value * 1000) AS BIGINT) // 2 AS processing_ms,
       value * CAST(1000 AS DOUBLE) AS disk_read_bps, value * CAST(500 AS DOUBLE) AS disk_write_bps,
       CASE WHEN k % 4 < 3 THEN k % 6 END AS artifact_id, k % 6 AS artifact_hint
FROM ev"""


def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query starts: the context as JSON text, as base64 of it, or empty."""
    k = F.col("k")
    request = F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 1).otherwise(0)
    text = F.concat(
        F.lit('{"artifactId":"'),
        (k % 6).cast("string"),
        F.lit('","artifactKind":"'),
        F.when(k % 2 == 0, "SemanticModel").otherwise("Dataflow"),
        F.lit('"}'),
    )
    return ev(spark, sf_dir).select(
        request.alias("request_id"),
        (request % 97).alias("tracking_id"),
        "node_id",
        F.timestamp_seconds(F.unix_timestamp("ts") - 5).alias("start_ts"),
        F.when(k % 4 == 3, "")
        .when(k % 4 == 0, F.base64(text.cast("binary")))
        .otherwise(text)
        .alias("evaluation_context"),
        F.col("event_id").alias("record_id"),
    )


VIEWS["starts"] = """
SELECT r AS request_id, r % 97 AS tracking_id, node_id, event_id AS record_id,
       date_trunc('second', ts) - INTERVAL 5 SECOND AS start_ts,
       CASE WHEN k % 4 = 3 THEN '' WHEN k % 4 = 0 THEN to_base64(CAST(c AS BLOB)) ELSE c END
         AS evaluation_context
FROM (SELECT *, event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS r,
        '{"artifactId":"' || (k % 6) || '","artifactKind":"' ||
        CASE WHEN k % 2 = 0 THEN 'SemanticModel' ELSE 'Dataflow' END || '"}' AS c FROM ev)"""


def refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("event_id") % 3 == 0
    end_s = F.unix_timestamp("ts") + F.when(exact, 20).otherwise(25)
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'error' AND event_id % 3 < 2")
        .select(
            F.when(exact, F.col("event_id")).otherwise(F.col("event_id") + 1000000).alias("request_id"),
            (F.col("k") % 6).alias("dataset_id"),
            (F.col("k") % 4).alias("workspace_id"),
            F.lit("Failed").alias("status"),
            F.timestamp_seconds(end_s - F.col("k") * 12).alias("start_ts"),
            F.timestamp_seconds(end_s).alias("end_ts"),
            F.concat(F.lit('{"errorCode":"E'), F.col("k").cast("string"), F.lit('"}')).alias(
                "service_exception"
            ),
        )
    )


VIEWS["refreshes"] = """
SELECT CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id + 1000000 END AS request_id,
       k % 6 AS dataset_id, k % 4 AS workspace_id, 'Failed' AS status,
       e - k * INTERVAL 12 SECOND AS start_ts, e AS end_ts,
       '{"errorCode":"E' || k || '"}' AS service_exception
FROM (SELECT *, date_trunc('second', ts) +
        CASE WHEN event_id % 3 = 0 THEN INTERVAL 20 SECOND ELSE INTERVAL 25 SECOND END AS e
      FROM ev WHERE event_type = 'error' AND event_id % 3 < 2)"""


def os_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    late = F.col("event_type") == "error"
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'signup' OR (event_type = 'error' AND event_id % 5 = 0)")
        .select(
            F.col("node_id").alias("host_id"),
            F.timestamp_seconds(
                F.unix_timestamp("ts") + F.when(late, 60).otherwise(0)
            ).alias("evt_time"),
            (k % 40 + 7000).alias("os_event_id"),
            F.when(k % 3 == 0, "Error")
            .when(k % 3 == 1, "Warning")
            .otherwise("Information")
            .alias("level"),
            F.when(k % 2 == 0, "Application").otherwise("System").alias("event_source"),
            F.col("event_id").alias("record_id"),
        )
    )


VIEWS["os_events"] = """
SELECT node_id AS host_id,
       date_trunc('second', ts) + CASE WHEN event_type = 'error' THEN INTERVAL 60 SECOND
         ELSE INTERVAL 0 SECOND END AS evt_time,
       k % 40 + 7000 AS os_event_id,
       CASE WHEN k % 3 = 0 THEN 'Error' WHEN k % 3 = 1 THEN 'Warning' ELSE 'Information' END AS level,
       CASE WHEN k % 2 = 0 THEN 'Application' ELSE 'System' END AS event_source,
       event_id AS record_id
FROM ev WHERE event_type = 'signup' OR (event_type = 'error' AND event_id % 5 = 0)"""


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'click'")
        .select(
            F.col("node_id").alias("host_id"),
            (F.col("k") % 2).alias("nic"),
            F.col("ts").alias("collected_at"),
            (F.col("value") * 1000000.0).alias("bytes_per_s"),
            F.least(F.lit(100.0), "value").alias("utilization_pct"),
            (F.col("k") + 5).cast("double").alias("latency_ms"),
            F.lit(1000000000.0).alias("bandwidth_bps"),
        )
    )


VIEWS["network"] = """
SELECT node_id AS host_id, k % 2 AS nic, ts AS collected_at,
       value * CAST(1000000 AS DOUBLE) AS bytes_per_s,
       least(CAST(100 AS DOUBLE), value) AS utilization_pct,
       CAST(k + 5 AS DOUBLE) AS latency_ms, CAST(1000000000 AS DOUBLE) AS bandwidth_bps
FROM ev WHERE event_type = 'click'"""


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    cpu = F.least(F.lit(100.0), "value")
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'view'")
        .select(
            "node_id",
            F.col("ts").alias("counter_ts"),
            cpu.alias("system_cpu"),
            (cpu / 2).alias("gateway_cpu"),
            (F.lit(500000) + F.col("k") * 1000).cast("long").alias("gateway_mem_kb"),
        )
    )


VIEWS["counters"] = """
SELECT node_id, ts AS counter_ts, least(CAST(100 AS DOUBLE), value) AS system_cpu,
       least(CAST(100 AS DOUBLE), value) / 2 AS gateway_cpu,
       CAST(500000 + k * 1000 AS BIGINT) AS gateway_mem_kb
FROM ev WHERE event_type = 'view'"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'purchase'")
        .select(
            "node_id",
            (F.col("user_id") % 2).alias("cluster_id"),
            F.concat(F.lit("cluster-"), (F.col("user_id") % 2).cast("string")).alias("cluster_name"),
            F.concat(F.lit("host-"), F.col("node_id").cast("string")).alias("node_name"),
            F.col("node_id").alias("host_id"),
            F.col("ts").alias("collected_at"),
            F.when(F.col("k") % 10 < 8, "Live").otherwise("Offline").alias("status"),
            F.when(F.dayofmonth("ts") < 15, "v1").otherwise("v2").alias("version"),
            (F.col("k") % 9).alias("datasource_count"),
            F.col("event_id").alias("record_id"),
        )
    )


VIEWS["inventory"] = """
SELECT node_id, user_id % 2 AS cluster_id, 'cluster-' || (user_id % 2) AS cluster_name,
       'host-' || node_id AS node_name, node_id AS host_id, ts AS collected_at,
       CASE WHEN k % 10 < 8 THEN 'Live' ELSE 'Offline' END AS status,
       CASE WHEN day(ts) < 15 THEN 'v1' ELSE 'v2' END AS version,
       k % 9 AS datasource_count, event_id AS record_id
FROM ev WHERE event_type = 'purchase'"""


def spool(spark: SparkSession, sf_dir: str) -> DataFrame:
    gib = 1073741824
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'purchase'")
        .select(
            F.col("node_id").alias("host_id"),
            F.col("ts").alias("collected_at"),
            (F.col("k").cast("long") * gib).alias("free_bytes"),
            F.lit(100 * gib).cast("long").alias("total_bytes"),
            F.col("k").cast("double").alias("free_pct"),
            (F.col("k").cast("long") * 1000000).alias("spool_dir_bytes"),
            (F.col("k") % 2 == 0).alias("stream_mode_warn"),
            F.col("event_id").alias("record_id"),
        )
    )


VIEWS["spool"] = """
SELECT node_id AS host_id, ts AS collected_at, CAST(k AS BIGINT) * 1073741824 AS free_bytes,
       CAST(107374182400 AS BIGINT) AS total_bytes, CAST(k AS DOUBLE) AS free_pct,
       CAST(k AS BIGINT) * 1000000 AS spool_dir_bytes, k % 2 = 0 AS stream_mode_warn,
       event_id AS record_id
FROM ev WHERE event_type = 'purchase'"""


def processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).select(
        "node_id",
        F.col("node_id").alias("host_id"),
        F.col("k").alias("process_id"),
        F.col("ts").alias("collected_at"),
        (F.col("value") * 40.0).alias("working_set_mb"),
        F.least(F.lit(100.0), "value").alias("cpu_pct"),
        (F.col("k") % 10 > 2).alias("is_container"),
        (F.col("event_id") * 2.5 + F.col("k")).cast("double").alias("cpu_seconds"),
    )


VIEWS["processes"] = """
SELECT node_id, node_id AS host_id, k AS process_id, ts AS collected_at,
       value * CAST(40 AS DOUBLE) AS working_set_mb, least(CAST(100 AS DOUBLE), value) AS cpu_pct,
       k % 10 > 2 AS is_container, CAST(event_id * 2.5 + k AS DOUBLE) AS cpu_seconds
FROM ev"""


def monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = (
        read(spark, sf_dir, "lineitem")
        .filter(F.col("l_orderkey") % 7 != 0)
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )
    # a hash table of the orders of a partition: the lines, several times as many, are not sorted
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("shuffle_hash")
    customer = read(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    offset = (F.col("l_orderkey") * 259 + F.col("l_linenumber") * 7) % 2592000
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("l_orderkey").alias("operation_id"),
            F.when(F.col("l_linenumber") == 1, "QueryEnd")
            .when(F.col("l_linenumber") == 2, "ExecutionMetrics")
            .when(F.col("l_linenumber") == 3, "RefreshEnd")
            .otherwise("QueryBegin")
            .alias("operation_name"),
            F.timestamp_seconds(F.lit(1704067200) + offset).alias("mon_ts"),
            F.col("c_name").alias("executing_user"),
            F.col("c_mktsegment").alias("item_name"),
            F.col("c_nationkey").alias("workspace_id"),
            F.floor("l_extendedprice").cast("long").alias("cpu_ms"),
            F.col("l_linenumber").alias("record_id"),
        )
    )


VIEWS["monitoring"] = """
SELECT l_orderkey AS operation_id,
       CASE l_linenumber WHEN 1 THEN 'QueryEnd' WHEN 2 THEN 'ExecutionMetrics'
            WHEN 3 THEN 'RefreshEnd' ELSE 'QueryBegin' END AS operation_name,
       TIMESTAMP '2024-01-01 00:00:00' +
         ((l_orderkey * 259 + l_linenumber * 7) % 2592000) * INTERVAL 1 SECOND AS mon_ts,
       c_name AS executing_user, c_mktsegment AS item_name, c_nationkey AS workspace_id,
       CAST(floor(l_extendedprice) AS BIGINT) AS cpu_ms, l_linenumber AS record_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE l_orderkey % 7 <> 0"""


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        ev(spark, sf_dir)
        .filter("event_type = 'signup'")
        .select(
            F.col("event_id").alias("activity_id"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_alias"),
            (F.col("k") % 6).alias("activity_artifact"),
            F.col("ts").alias("activity_ts"),
            (F.col("k") % 7).alias("activity_workspace"),
        )
    )


VIEWS["activity_events"] = """
SELECT event_id AS activity_id, 'user-' || user_id AS user_alias, k % 6 AS activity_artifact,
       ts AS activity_ts, k % 7 AS activity_workspace
FROM ev WHERE event_type = 'signup'"""


def datasource_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        ev(spark, sf_dir)
        .filter("event_type IN ('view', 'purchase')")
        .select(
            (F.col("user_id") % 12).alias("datasource_id"),
            F.concat(F.lit("source-"), (F.col("user_id") % 12).cast("string")).alias("datasource_name"),
            F.when(F.col("user_id") % 3 == 0, "Sql").otherwise("File").alias("datasource_type"),
            F.concat(F.lit("cluster-"), (F.col("user_id") % 2).cast("string")).alias("cluster_name"),
            F.when(k % 4 == 0, "Error").when(k % 4 == 1, "Unknown").otherwise("Live").alias("status"),
            F.col("ts").alias("collected_at"),
            F.col("event_id").alias("record_id"),
        )
    )


VIEWS["datasource_polls"] = """
SELECT user_id % 12 AS datasource_id, 'source-' || (user_id % 12) AS datasource_name,
       CASE WHEN user_id % 3 = 0 THEN 'Sql' ELSE 'File' END AS datasource_type,
       'cluster-' || (user_id % 2) AS cluster_name,
       CASE WHEN k % 4 = 0 THEN 'Error' WHEN k % 4 = 1 THEN 'Unknown' ELSE 'Live' END AS status,
       ts AS collected_at, event_id AS record_id
FROM ev WHERE event_type IN ('view', 'purchase')"""


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("activity_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("operation"),
        (F.col("o_custkey") % 25).alias("workspace_id"),
        F.col("o_orderdate").alias("activity_ts"),
    )


VIEWS["activities"] = """
SELECT o_orderkey AS activity_id, o_custkey AS user_id, o_orderstatus AS operation,
       o_custkey % 25 AS workspace_id, o_orderdate AS activity_ts FROM orders"""


def refreshables(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (
        read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("end_ts"))
    )
    return (
        read(spark, sf_dir, "orders")
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").alias("refresh_id"),
            F.col("o_custkey").alias("dataset_id"),
            (F.col("o_custkey") % 25).alias("workspace_id"),
            F.when(F.col("o_orderstatus") == "F", "Failed").otherwise("Completed").alias("status"),
            F.col("o_orderdate").alias("start_ts"),
            "end_ts",
        )
    )


VIEWS["refreshables"] = """
SELECT o_orderkey AS refresh_id, o_custkey AS dataset_id, o_custkey % 25 AS workspace_id,
       CASE WHEN o_orderstatus = 'F' THEN 'Failed' ELSE 'Completed' END AS status,
       o_orderdate AS start_ts, end_ts
FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS end_ts FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey"""


def capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("capacity_id"),
        F.col("l_linestatus").alias("sku"),
        F.to_date("l_shipdate").alias("usage_date"),
        F.col("l_quantity").alias("cu_seconds"),
    )


VIEWS["capacities"] = """
SELECT l_returnflag AS capacity_id, l_linestatus AS sku, CAST(l_shipdate AS DATE) AS usage_date,
       l_quantity AS cu_seconds FROM lineitem"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("item_kind"),
        F.col("p_size").alias("workspace_id"),
        F.col("p_brand").alias("capacity_id"),
    )


VIEWS["items"] = """
SELECT p_partkey AS item_id, p_name AS item_name, p_type AS item_kind, p_size AS workspace_id,
       p_brand AS capacity_id FROM part"""


def call_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return ev(spark, sf_dir).select(
        F.concat(F.lit("api/"), "event_type").alias("api_path"),
        F.when(k % 10 < 7, 200).when(k % 10 < 9, 429).otherwise(500).alias("status_code"),
        k.cast("long").alias("row_count"),
        F.col("ts").alias("audit_ts"),
        F.floor(F.col("event_id") / 2).alias("job_id"),
        F.when(F.col("event_id") % 2 == 0, "START").otherwise("END").alias("job_event"),
    )


VIEWS["call_audit"] = """
SELECT 'api/' || event_type AS api_path,
       CASE WHEN k % 10 < 7 THEN 200 WHEN k % 10 < 9 THEN 429 ELSE 500 END AS status_code,
       CAST(k AS BIGINT) AS row_count, ts AS audit_ts, event_id // 2 AS job_id,
       CASE WHEN event_id % 2 = 0 THEN 'START' ELSE 'END' END AS job_event
FROM ev"""


def sql(body: str) -> str:
    """``body`` preceded by the views it names, each once, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in order and re.search(rf"\b(FROM|JOIN|TABLE)\s+{name}\b", text):
                visit(VIEWS[name])
                order.append(name)

    visit(body)
    head = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
    text = body.strip()
    if not head:
        return text
    if text.upper().startswith("WITH "):
        return f"WITH {head},\n{text[5:]}"
    return f"WITH {head}\n{text}"
