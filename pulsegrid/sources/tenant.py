"""Payloads of the administration APIs: envelopes, inventories, activities."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.functions import scalars as S
from pulsegrid.functions.text import leaf_name

#: Array of a workspace and the kind of item it holds.
ITEM_ARRAYS = {
    "reports": "Report",
    "datasets": "SemanticModel",
    "dataflows": "Dataflow",
    "dashboards": "Dashboard",
    "notebooks": "Notebook",
    "pipelines": "DataPipeline",
    "lakehouses": "Lakehouse",
    "eventhouses": "Eventhouse",
    "warehouses": "Warehouse",
}
ITEM = "array<struct<id string, name string>>"
SCAN = (
    "workspaces array<struct<id string, name string, capacityId string, "
    + ", ".join(f"{a} {ITEM}" for a in ITEM_ARRAYS)
    + ">>"
)
ACTIVITY = "Id string, UserId string, Operation string, WorkspaceId string, CapacityId string, CreationTime string"
REFRESHABLE = (
    "id string, name string, group struct<id string>, capacity struct<id string>, "
    "lastRefresh struct<status string, startTime string, endTime string>"
)


def read_payload(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def flatten_scanner_inventory(scans: DataFrame) -> DataFrame:
    """One row per item of any kind; absent arrays give no rows."""
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(f"w.{array}").alias("items"))
            for array, kind in ITEM_ARRAYS.items()
        ]
    )
    return (
        scans.select(F.explode("workspaces").alias("w"))
        .select("w.id", "w.name", "w.capacityId", F.explode(kinds).alias("k"))
        .select("id", "name", "capacityId", "k.kind", F.explode("k.items").alias("i"))
        .select(
            F.col("i.id").alias("item_id"),
            F.col("i.name").alias("item_name"),
            F.col("kind").alias("item_kind"),
            F.col("id").alias("workspace_id"),
            F.col("name").alias("workspace_name"),
            F.col("capacityId").alias("capacity_id"),
        )
    )


def flatten_activities(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("Id").alias("activity_id"),
        F.col("UserId").alias("user_id"),
        F.col("Operation").alias("operation"),
        F.col("WorkspaceId").alias("workspace_id"),
        F.col("CapacityId").alias("capacity_id"),
        S.first_19(F.col("CreationTime")).alias("activity_date"),
    )


def flatten_refreshables(refs: DataFrame) -> DataFrame:
    start = F.col("lastRefresh.startTime").try_cast("timestamp")
    end = F.col("lastRefresh.endTime").try_cast("timestamp")
    return refs.select(
        F.col("id").alias("dataset_id"),
        F.col("name").alias("dataset_name"),
        F.col("group.id").alias("workspace_id"),
        F.col("capacity.id").alias("capacity_id"),
        F.coalesce("lastRefresh.status", F.lit("Unknown")).alias("status"),
        S.refresh_seconds(start, end).alias("duration_seconds"),
        S.first_19(F.col("lastRefresh.startTime")).alias("refresh_date"),
    )


#: Engine column and the leaf names it may arrive under.
CAPACITY_NAMES = {
    "capacity_id": ("capacity id", "capacityid", "capacity_id"),
    "capacity_name": ("capacity name", "capacityname"),
    "region": ("region",),
    "sku": ("sku",),
    "cu_seconds": ("cu_s", "cu (s)", "cu seconds", "cu_seconds"),
    "usage_date": ("date",),
}


def _leaf(name: str) -> str:
    """The innermost bracketed part, or the name itself, in lower case."""
    inner = re.fullmatch(r"(?:.*\[)?([^\[]*?)\]*", name, re.DOTALL)
    return inner[1].strip().lower()


def normalize_bracketed_keys(df: DataFrame, names: dict[str, tuple[str, ...]] = CAPACITY_NAMES) -> DataFrame:
    """Columns like ``Table[Column]`` under their engine names; absent ones null."""
    by_leaf = {}
    for column in df.columns:
        by_leaf.setdefault(_leaf(column), column)
    picked = []
    for ours, synonyms in names.items():
        theirs = next((by_leaf[s] for s in synonyms if s in by_leaf), None)
        picked.append((F.lit(None).cast("string") if theirs is None else F.col(f"`{theirs}`")).alias(ours))
    return df.select(*picked)


def normalize_bracketed_map(column: Column, names: dict[str, tuple[str, ...]] = CAPACITY_NAMES) -> list[Column]:
    """The same for rows held as map<string,string>."""
    leaves = F.transform_keys(column, lambda k, v: F.lower(leaf_name(k)))
    return [F.coalesce(*[leaves[s] for s in synonyms]).alias(ours) for ours, synonyms in names.items()]


# ---- envelopes -----------------------------------------------------------------------------


def envelope(df: DataFrame, entity_type: str, source: str, ingested_at: Column) -> DataFrame:
    """Whole rows as one JSON payload next to their origin."""
    return df.select(
        ingested_at.alias("ingestion_ts"),
        F.lit(entity_type).alias("entity_type"),
        F.lit(source).alias("source_file"),
        F.to_json(F.struct(*df.columns)).alias("payload"),
    )


def envelope_parse(rows: DataFrame, entity_type: str, schema: str) -> DataFrame:
    """Payloads of one entity by their declared schema; no rows still have columns."""
    parsed = F.from_json("payload", schema, {"mode": "PERMISSIVE"})
    return rows.filter(F.col("entity_type") == entity_type).select(
        "ingestion_ts", "source_file", parsed.alias("p")
    ).select("ingestion_ts", "source_file", "p.*")


#: Declared schemas of the workspace API answers.
API = {
    "groups": "value array<struct<id string, name string>>",
    "datasets": "value array<struct<id string, name string>>",
    "refreshes": "value array<struct<requestId string, status string, startTime string, endTime string>>",
    "datasources": "value array<struct<datasourceId string, gatewayId string, datasourceType string>>",
}


def api_values(rows: DataFrame, entity: str) -> DataFrame:
    """One row per element of an answer; parent ids come from the request path."""
    part = lambda name: F.nullif(F.regexp_extract("source_file", rf"{name}/([^/]+)", 1), F.lit(""))
    return (
        envelope_parse(rows, entity, API[entity])
        .select(part("groups").alias("workspace_id"), part("datasets").alias("dataset_id"), F.explode("value").alias("v"))
    )


def entity_drilldown(rows: DataFrame) -> DataFrame:
    """Workspaces, datasets, refreshes and bound datasources as one relation."""
    groups = api_values(rows, "groups").select(F.col("v.id").alias("workspace_id"), F.col("v.name").alias("workspace_name"))
    datasets = api_values(rows, "datasets").select(
        "workspace_id", F.col("v.id").alias("dataset_id"), F.col("v.name").alias("dataset_name")
    )
    refreshes = api_values(rows, "refreshes").groupBy("workspace_id", "dataset_id").agg(
        F.count(F.lit(1)).alias("refreshes"), F.count_if(F.col("v.status") == "Failed").alias("failed_refreshes")
    )
    sources = api_values(rows, "datasources").groupBy("workspace_id", "dataset_id").agg(
        F.count_distinct("v.datasourceId").alias("datasources"), F.count_distinct("v.gatewayId").alias("gateways")
    )
    keys = ["workspace_id", "dataset_id"]
    return (
        groups.join(datasets, "workspace_id", "left")
        .join(refreshes, keys, "left")
        .join(sources, keys, "left")
        .fillna(0, ["refreshes", "failed_refreshes", "datasources", "gateways"])
    )


def tenant_gold(scans: DataFrame, events: DataFrame, refs: DataFrame) -> dict[str, DataFrame]:
    return {
        "gold_inventory": flatten_scanner_inventory(scans),
        "gold_activities": flatten_activities(events),
        "gold_refreshables": flatten_refreshables(refs),
    }
