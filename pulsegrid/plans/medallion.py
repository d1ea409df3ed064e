"""Landed files to bronze, silver and gold tables on storage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.contracts import conform, contract_check, empty, schema_of
from pulsegrid.operators import history, rollups as R, sketches
from pulsegrid.operators.quality import FanoutGuard
from pulsegrid.plans import correlate as C
from pulsegrid.session import materialize, prepare
from pulsegrid.sources import tenant as T
from pulsegrid.sources.storage import BATCH, in_partitions, read_table, write_bronze, write_partitions
from pulsegrid.streaming.landing import LANDINGS, Ingest


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def __post_init__(self) -> None:
        prepare(self.spark)  # times and days are UTC from the first parse on

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame | None:
        found = read_table(self.spark, self.path(table), self.fmt)
        return found if found is None else found.drop(BATCH)

    def read_or_empty(self, table: str) -> DataFrame:
        found = self.read(table)
        return conform(found, table) if found is not None else empty(self.spark, table)

    def append(self, df: DataFrame, table: str) -> None:
        write_bronze(contract_check(df, table), self.path(table), self.fmt)

    def replace(self, df: DataFrame, table: str) -> None:
        write_partitions(df, self.path(table), ["partition_date"], self.fmt)

    def replace_whole(self, df: DataFrame, table: str) -> None:
        """For tables of the present state: no row of an earlier run survives."""
        df.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "partition_date"
        ).save(self.path(table))


def ingest(lake: Lake, landing: str, max_files: int | None = None) -> dict[str, str]:
    """Everything that landed since the last run, exactly once; see ``streaming.landing``.

    Returned are the tables that have no rows yet because no file for them has ever
    landed (aggregated logs are optional).
    """
    Ingest(lake.spark, lake.root, landing, lake.fmt, max_files=max_files).run()
    tables = {t for source in LANDINGS for feeds in source.tables.values() for t, _ in feeds}
    return {t: "PATH_NOT_FOUND" for t in sorted(tables - {"bronze_query_aggregation"}) if lake.read(t) is None}


def host_of_node(inventory: DataFrame) -> DataFrame:
    rows = inventory.select("node_id", "collected_at", F.col("node_name").alias("host_id"))
    return R.newest_of(rows.filter("node_id IS NOT NULL"), ["node_id"], "collected_at").select("node_id", "host_id")


def build_silver(
    lake: Lake, start: Column | None = None, end: Column | None = None, cfg: Settings = DEFAULTS,
    salt: str = "", plain_identities: bool = False,
) -> dict[str, tuple[int, int]]:
    """Silver tables of a date range (default: all). Returns rows in and out per table.

    User activity (``bronze_activity``) and monitoring rows (``bronze_monitoring``) name the owners of
    executions where these tables exist. Owners are stored as keyed hashes (``salt``)
    unless ``plain_identities`` asks for the names.

    Replays and matches reach over midnight, so one day more is read on either side
    and only the wanted days are written.
    """

    def bronze(table: str) -> DataFrame:
        df = lake.read_or_empty(table)
        return df if start is None else in_partitions(df, F.date_sub(F.to_date(start), 1), F.date_add(F.to_date(end), 1))

    def wanted_days(df: DataFrame) -> DataFrame:
        return df if start is None else in_partitions(df, start, end)

    hosts = host_of_node(lake.read_or_empty("bronze_inventory"))
    # no executions at all still gives every column the joins use
    raw = bronze("bronze_query_execution")
    wanted = schema_of("bronze_query_execution").fieldNames()
    extra = {c: F.lit(None).cast(t) for c, t in dict(
        data_source="string", query_type="string", spool_write_ms="bigint", spool_read_ms="bigint",
        data_read_ms="bigint", processing_ms="bigint", disk_read_bps="double", disk_write_bps="double",
    ).items() if c not in raw.columns}
    executions = raw.withColumns(extra) if extra else raw
    executions = executions.select(
        *wanted, "data_source", "query_type", "spool_write_ms", "spool_read_ms", "data_read_ms",
        "processing_ms", "disk_read_bps", "disk_write_bps",
    ).drop("partition_date").join(hosts, "node_id", "left").withColumn("artifact_hint", F.col("data_source"))
    lake.replace(
        wanted_days(C.silver_query_execution(executions, lake.read("bronze_query_start"))), "silver_query_execution"
    )
    silver = wanted_days(lake.read("silver_query_execution"))

    counts = {}

    def guarded(name: str, source: DataFrame, build) -> None:
        guard = FanoutGuard(name)
        lake.replace(contract_check(guard.after(build(guard.before(source))), name), name)
        counts[name] = guard.check()

    events = bronze("bronze_event_log").withColumn(
        "record_id", F.xxhash64("host_id", "evt_time", "os_event_id", "level", "message")
    )
    network = bronze("bronze_network_metrics")
    guarded("silver_network_correlated", silver, lambda df: C.silver_network_correlated(df, network, cfg))
    # the latency beside each execution has just been found and written
    latency = wanted_days(lake.read("silver_network_correlated")).select("request_id", "tracking_id", "latency_ms")
    # the failures are few: their rows feed the guard and both lookups
    guarded("silver_triage", silver.filter(~F.col("success")),
            lambda df: C.silver_triage(df, bronze("bronze_refresh_history"), events, cfg, latency))
    owners = [bronze(t) if lake.read(t) is not None else None for t in ("bronze_activity", "bronze_monitoring")]

    def attributed(df: DataFrame) -> DataFrame:
        found = C.silver_identity_attribution(df, *owners, cfg)
        named = [c for c in IDENTITIES if c in found.columns]
        return found if plain_identities else history.pseudonymize(found, named, salt)

    guarded("silver_identity_attribution", silver, attributed)
    return counts


#: Columns of the attribution that name a person.
IDENTITIES = ("user_alias", "executing_user")


#: Gold tables of facts; the others describe the present state and are replaced whole.
FACTS = ("gold_query_performance",)


def build_gold(
    lake: Lake, as_of: Column, cfg: Settings = DEFAULTS, start: Column | None = None, end: Column | None = None
) -> None:
    """Gold tables from silver and bronze; a date range bounds what is computed anew of the fact tables."""
    silver = lake.read("silver_query_execution")
    inventory = lake.read_or_empty("bronze_inventory").withColumn(
        "record_id", F.xxhash64("node_id", "collected_at", "status", "version")
    ).withColumn("host_id", F.col("node_name"))
    spool = lake.read_or_empty("bronze_disk_spool").withColumn(
        "record_id", F.xxhash64("host_id", "collected_at", "free_pct")
    )
    health = R.gateway_health(
        silver, inventory, lake.read_or_empty("bronze_system_counter"), spool,
        lake.read("silver_network_correlated"), as_of, cfg,
    )
    tables = {
        "gold_gateway_health": health,
        "gold_query_performance": R.query_performance(silver if start is None else in_partitions(silver, start, end)),
        "gold_cluster_load": R.cluster_load(silver, R.cluster_map(inventory), cfg),
        "gold_dim_gateway": history.dimension_history(inventory),
        "gold_process_health": R.process_health(lake.read_or_empty("bronze_processes"), cfg).withColumn(
            "partition_date", F.to_date(as_of)
        ),
        "gold_datasources": R.newest_of(
            lake.read_or_empty("bronze_datasources").drop("partition_date"), ["datasource_id"], "collected_at"
        ).withColumn("partition_date", F.to_date("collected_at")),
    }
    for name, df in tables.items():
        write = lake.replace if name in FACTS else lake.replace_whole
        write(contract_check(df, name), name)


def build_tenant(lake: Lake, landing: str) -> None:
    """Gold tables of the administration payloads, replaced as a whole."""
    payloads = [
        T.read_payload(lake.spark, f"{landing}/{name}_*.json", schema)
        for name, schema in (("scanner_result", T.SCAN), ("activity_events", T.ACTIVITY), ("refreshables", T.REFRESHABLE))
    ]
    for table, df in T.tenant_gold(*payloads).items():
        contract_check(df, table).write.format(lake.fmt).mode("overwrite").save(lake.path(table))
    # only the days of the payload change; a day's users are those of all payloads so far
    fresh = sketches.daily_sketches(lake.read("gold_activities"), "activity_date", "user_id")
    stored = lake.read(USER_DAYS)
    whole = sketches.merged(stored, fresh)
    lake.replace(whole if stored is None else materialize(whole, "user-days"), USER_DAYS)


#: Sketches of the active users of each day; ``sketches.distinct_values`` merges any days of it.
USER_DAYS = "gold_active_user_days"
