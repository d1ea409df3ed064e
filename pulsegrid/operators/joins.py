"""Equality joins of the correlation layer, each with one row per key on the right."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulsegrid.functions.scalars import bin_start
from pulsegrid.functions.text import is_empty
from pulsegrid.operators.dedup import earliest_per_key, latest_wins
from pulsegrid.operators.lookup import lookup_join

#: Monitoring operations that carry an owner.
OWNER_OPERATIONS = ("QueryEnd", "ExecutionMetrics", "RefreshEnd")


def lookback(df: DataFrame, time: str, as_of: Column, seconds: int) -> DataFrame:
    """Rows later than ``as_of - seconds``; ``as_of`` is always given, never the clock."""
    return df.filter(F.col(time) > as_of - F.expr(f"INTERVAL {int(seconds)} SECONDS"))


def between(df: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    return df.filter(F.col(time).between(start, end))


def optional_in(df: DataFrame, column: str, allowed: list | None) -> DataFrame:
    """An empty list means no filter."""
    return df.filter(F.col(column).isin(list(allowed))) if allowed else df


def owner_rows(
    monitoring: DataFrame, workspaces: list | None = None
) -> DataFrame:
    """Monitoring rows that can name an owner; both filters sit on the scan."""
    return optional_in(monitoring, "workspace_id", workspaces).filter(
        F.col("operation_name").isin(*OWNER_OPERATIONS)
    )


def start_exec_join(executions: DataFrame, starts: DataFrame) -> DataFrame:
    """Executions with the earliest start of their request."""
    right = earliest_per_key(
        starts.select("request_id", "start_ts", "artifact_id", "artifact_type"),
        ["request_id"],
        "start_ts",
        ["artifact_id", "artifact_type"],
    )
    return lookup_join(executions, right, [("request_id", "request_id")])


def start_exec_join_composite(starts: DataFrame, executions: DataFrame) -> DataFrame:
    """Starts with the newest execution of their (node, tracking id), plus spool rates."""
    newest = latest_wins(
        executions, ["node_id", "tracking_id"], [F.col("end_ts").desc(), F.col("request_id").desc()]
    ).select(
        "node_id", "tracking_id", F.col("request_id").alias("exec_request_id"), "end_ts",
        "spool_bytes", "spool_write_ms", "spool_read_ms", "duration_ms",
    )
    left = starts.select("node_id", "tracking_id", F.col("request_id").alias("start_request_id"), "start_ts")
    return lookup_join(left, newest, [("node_id", "node_id"), ("tracking_id", "tracking_id")]).select(
        "node_id",
        "tracking_id",
        "start_request_id",
        "exec_request_id",
        "start_ts",
        "end_ts",
        *spool_rates(
            F.col("spool_bytes"), F.col("spool_write_ms"), F.col("spool_read_ms"), F.col("duration_ms")
        ),
    )


def spool_rates(size: Column, write_ms: Column, read_ms: Column, duration_ms: Column) -> list[Column]:
    """Bytes per millisecond written and read, and the spool share of the duration."""
    return [
        F.round(F.when(write_ms > 0, size / write_ms), 4).alias("write_bytes_per_ms"),
        F.round(F.when(read_ms > 0, size / read_ms), 4).alias("read_bytes_per_ms"),
        F.round(F.try_divide(write_ms.cast("double"), duration_ms.cast("double")), 4).alias("spool_share"),
    ]


def identity_join(executions: DataFrame, monitoring: DataFrame, workspaces: list | None = None) -> DataFrame:
    """Executions with every owner row of their request.

    A plain equality join, whole on both sides; a hot request id is split by
    adaptive execution. Counting queries use ``identity_left_join`` instead.
    """
    right = owner_rows(monitoring, workspaces)
    return executions.join(right, executions.request_id == right.operation_id).select(
        "end_ts",
        "node_id",
        "executing_user",
        "item_name",
        "workspace_id",
        "data_source",
        "query_type",
        F.col("duration_ms").alias("gateway_duration_ms"),
        F.col("cpu_ms").alias("engine_cpu_ms"),
        F.col("spool_bytes").alias("spooled_bytes"),
        "success",
        "error_message",
        "request_id",
        "tracking_id",
        "operation_name",
    )


def owner_per_operation(monitoring: DataFrame, workspaces: list | None = None) -> DataFrame:
    """One owner per operation: the newest usable row."""
    rows = owner_rows(monitoring, workspaces).select(
        "operation_id", "mon_ts", "record_id", "executing_user", "item_name"
    )
    return latest_wins(
        rows, ["operation_id"], [F.col("mon_ts").desc(), F.col("record_id").desc()]
    ).select("operation_id", "executing_user", "item_name")


def identity_left_join(executions: DataFrame, monitoring: DataFrame, workspaces: list | None = None) -> DataFrame:
    """Every execution once, with its owner where one is known."""
    right = owner_per_operation(monitoring, workspaces)
    return lookup_join(executions, right, [("request_id", "operation_id")])


def unattributed(executions: DataFrame, monitoring: DataFrame) -> DataFrame:
    """Executions without an owner. Owned operations are made one row each first, so a hot one is combined in its tasks."""
    right = owner_rows(monitoring).filter(~is_empty(F.col("executing_user")))
    owned = right.select("operation_id").distinct()
    return lookup_join(executions, owned, [("request_id", "operation_id")], "left_anti")


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key the right side, made one row a key, does not have."""
    return lookup_join(left, right.select(key).distinct(), [(key, key)], "left_anti")


def case_insensitive_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equality on lower-cased text, projected so it stays an equality join."""
    a = left.withColumn("_lk", F.lower(left_key))
    b = right.withColumn("_rk", F.lower(right_key))
    return a.join(b, F.col("_lk") == F.col("_rk"), how).drop("_lk", "_rk")


def dimension_lookup(facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a dimension with one row per key: broadcast by size, else hot keys are split."""
    return lookup_join(facts, dimension, [(key, key)], how)


def relationship_join(facts: DataFrame, dimension: DataFrame, fact_key: Column, dim_key: str) -> DataFrame:
    """Many-to-one model relationship: facts keep their rows."""
    copy = dimension.withColumn("_dim_key", F.col(dim_key))
    return lookup_join(facts.withColumn("_fk", fact_key), copy, [("_fk", "_dim_key")]).drop("_fk")


def inline_keys_join(keys: DataFrame, monitoring: DataFrame) -> DataFrame:
    """A list of request ids with the owner of each, or nulls."""
    return lookup_join(keys, owner_per_operation(monitoring), [("request_id", "operation_id")])


def multi_signal_join(failed: DataFrame, network: DataFrame, counters: DataFrame, bin_s: int = 300) -> DataFrame:
    """Failures with mean latency and mean CPU of the same node and 5-minute bin."""
    rtt = network.groupBy(
        F.col("host_id").alias("node_id"), bin_start(F.col("collected_at"), bin_s).alias("bin")
    ).agg(F.avg("latency_ms").alias("avg_latency_ms"))
    cpu = counters.groupBy("node_id", bin_start(F.col("counter_ts"), bin_s).alias("bin")).agg(
        F.avg("system_cpu").alias("avg_cpu_pct")
    )
    on = [("node_id", "node_id"), ("bin", "bin")]
    binned = failed.withColumn("bin", bin_start(F.col("end_ts"), bin_s))
    return lookup_join(lookup_join(binned, rtt, on), cpu, on)


def capacity_overlay(usage: DataFrame, counters: DataFrame, bin_s: int = 3600) -> DataFrame:
    """Capacity seconds and node CPU on one time axis; either side may be missing."""
    cu = usage.groupBy(bin_start(F.col("usage_ts"), bin_s).alias("bin")).agg(
        F.round(F.sum("cu_seconds"), 4).alias("cu_seconds")
    )
    cpu = counters.groupBy(bin_start(F.col("counter_ts"), bin_s).alias("bin")).agg(
        F.round(F.avg("system_cpu"), 4).alias("system_cpu_avg")
    )
    return cu.join(cpu, "bin", "full_outer")
