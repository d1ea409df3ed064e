"""Landed files to gold: the facts a whole run must show."""

import pytest
from pyspark.sql import functions as F

from fixtures import write_landing
from pulsegrid.contracts import report_names
from pulsegrid.operators import sketches
from pulsegrid.operators.quality import FanoutGuard, table_presence_report
from pulsegrid.plans import medallion as M
from pulsegrid.sources.storage import read_table, with_provenance


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    landing, root = tmp_path_factory.mktemp("land"), tmp_path_factory.mktemp("lake")
    write_landing(landing)
    lake = M.Lake(spark, str(root))
    M.ingest(lake, str(landing))
    counts = M.build_silver(lake)
    M.build_gold(lake, F.lit("2024-03-05 12:30:00").cast("timestamp"))
    return lake, counts


def test_executions_lose_replays_and_gain_artifacts(lake):
    rows = lake[0].read("silver_query_execution")
    assert rows.count() == 7
    assert rows.filter("artifact_id IS NOT NULL").count() == 4
    assert rows.filter("request_id = 'r14'").first().spool_bytes == 300


def test_each_failure_once_with_its_confidence(lake):
    rows = {r.request_id: r for r in lake[0].read("silver_triage").collect()}
    assert {k: r.triage_confidence for k, r in rows.items()} == {
        "r11": "EXACT_REQUESTID", "r13": "EXACT_REQUESTID", "r20": "TIME_WINDOW", "r21": "GATEWAY_ONLY"}
    assert {k: r.failure_layer for k, r in rows.items()} == {
        "r11": "OS_SERVICE_EVENT", "r13": "SERVICE_REFRESH_ERROR", "r20": "SERVICE_REFRESH_ERROR", "r21": "GATEWAY_LOG_ERROR"}
    assert rows["r11"].os_event_confidence == "HOST_ONLY"


def test_attribution_and_network_keep_their_rows(lake):
    attribution = lake[0].read("silver_identity_attribution")
    assert attribution.count() == 7
    assert {r[0] for r in attribution.select("attribution_confidence").distinct().collect()} == {"EVALUATION_CONTEXT", "UNATTRIBUTED"}
    network = {r.request_id: r for r in lake[0].read("silver_network_correlated").collect()}
    assert len(network) == 7
    assert network["r10"].bytes_per_s_max == 5e7 and network["r10"].network_gap_s == 0
    assert network["r12"].network_throughput_efficiency == round(200000 / (0.5 * 3e7), 6)
    assert lake[1] == {"silver_network_correlated": (7, 7), "silver_triage": (4, 4), "silver_identity_attribution": (7, 7)}


def test_gold_tables(lake):
    health = lake[0].read("gold_gateway_health")
    assert health.count() == 3
    node = health.filter("node_id = 'n1'").first()
    assert node.version == "v2" and node.heartbeat_age_minutes == 32.0 and node.spool_free_pct == 45.0
    load = lake[0].read("gold_cluster_load")
    assert load.filter("queries_per_node_cv IS NOT NULL").count() > 0
    dimension = lake[0].read("gold_dim_gateway")
    assert dimension.filter("is_current").count() == 3
    assert dimension.filter("NOT is_current").filter("valid_to IS NULL OR valid_to < valid_from").count() == 0
    process = {r.node_id: r for r in lake[0].read("gold_process_health").collect()}
    assert [n for n, r in process.items() if r.runaway_container] == ["n1"]
    assert process["n2"].distinct_processes == 3 and process["n2"].container_samples == 4
    present = {r.table_name: r for r in table_presence_report(lake[0].spark, lake[0].root).collect()}
    assert present["gold_query_performance"].rows == 5 and not present["gold_capacities"].present


def test_missing_sources_degrade(spark, tmp_path):
    empty = M.Lake(spark, str(tmp_path / "none"))
    assert empty.read("silver_triage") is None
    assert empty.read_or_empty("bronze_event_log").count() == 0


def test_fanout_guard_raises(spark, tmp_path):
    guard = FanoutGuard("pairs")
    rows = guard.before(spark.range(3))
    guard.after(rows.join(spark.range(2).withColumnRenamed("id", "x"), F.lit(True))).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="6 rows from 3"):
        guard.check()


def test_tenant_payloads_to_gold(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "scanner_result_1.json").write_text(
        '{"workspaces": [{"id": "w", "name": "W", "capacityId": "c", "reports": [{"id": "r", "name": "R"}]}]}')
    (tmp_path / "in" / "activity_events_1.json").write_text('[{"Id": "1", "UserId": "u", "CreationTime": "2024-03-05T10:11:12Z"}]')
    (tmp_path / "in" / "refreshables_1.json").write_text('[{"id": "d", "name": "D"}]')
    lake = M.Lake(spark, str(tmp_path / "lake"))
    M.build_tenant(lake, str(tmp_path / "in"))
    M.build_tenant(lake, str(tmp_path / "in"))
    assert [lake.read(t).count() for t in ("gold_inventory", "gold_activities", "gold_refreshables")] == [1, 1, 1]
    days = lake.read(M.USER_DAYS)
    assert [(str(r.partition_date), r.users) for r in sketches.distinct_values(days, ["partition_date"], "users").collect()] == [("2024-03-05", 1)]
    (tmp_path / "in" / "activity_events_1.json").write_text(
        '[{"Id": "2", "UserId": "v", "CreationTime": "2024-03-05T11:11:12Z"}, {"Id": "3", "UserId": "u", "CreationTime": "2024-03-06T10:11:12Z"}]')
    M.build_tenant(lake, str(tmp_path / "in"))
    assert sorted(r.users for r in sketches.distinct_values(lake.read(M.USER_DAYS), ["partition_date"], "users").collect()) == [1, 2]
    assert sketches.distinct_values(lake.read(M.USER_DAYS), [], "users").first().users == 2
    assert "ItemKind" in report_names(lake.read("gold_inventory")).columns


def test_provenance_and_formats(spark, tmp_path):
    spark.range(2).write.orc(str(tmp_path / "t"))
    df = with_provenance(read_table(spark, str(tmp_path / "t"), "orc"), "agent", "1.2").first()
    assert df.source_file.endswith(".orc") and (df.collector, df.collector_version) == ("agent", "1.2") and df.ingested_at
    with pytest.raises(ValueError):
        read_table(spark, "x", "csv")


def test_present_state_keeps_no_row_of_an_earlier_run(spark, tmp_path):
    write_landing(tmp_path)
    lake = M.Lake(spark, str(tmp_path / "lake"))
    assert M.ingest(lake, str(tmp_path)) == {}
    M.build_silver(lake)
    M.build_gold(lake, F.lit("2024-03-05 12:30:00").cast("timestamp"))
    seen = {t: lake.read(t).count() for t in ("gold_gateway_health", "gold_datasources", "gold_process_health")}
    later = lake.read("bronze_inventory").withColumns({
        "collected_at": F.col("collected_at") + F.expr("INTERVAL 1 DAY"), "partition_date": F.date_add("partition_date", 1)})
    lake.append(spark.createDataFrame(later.collect(), later.schema), "bronze_inventory")
    M.build_gold(lake, F.lit("2024-03-06 12:30:00").cast("timestamp"))
    assert {t: lake.read(t).count() for t in seen} == seen
    assert lake.read("gold_dim_gateway").filter("is_current").count() == 3


def test_ingest_reports_missing_files_and_goes_on(spark, tmp_path):
    write_landing(tmp_path)
    for f in tmp_path.glob("QueryStartReport*"):
        f.write_text("")
        f.rename(tmp_path / "other.txt")
    lake = M.Lake(spark, str(tmp_path / "lake"))
    assert M.ingest(lake, str(tmp_path)) == {"bronze_query_start": "PATH_NOT_FOUND"}
    assert lake.read("bronze_processes") is not None


def test_silver_of_one_day_sees_the_day_before(spark, tmp_path):
    lake = M.Lake(spark, str(tmp_path / "lake"))
    write_landing(tmp_path)
    M.ingest(lake, str(tmp_path))
    day = lake.read("bronze_query_execution").selectExpr("max(partition_date) AS d").first().d
    M.build_silver(lake)
    whole = {r.request_id: r.network_gap_s for r in lake.read("silver_network_correlated").filter(F.col("partition_date") == F.lit(day)).collect()}
    one = M.Lake(spark, str(tmp_path / "one"))
    M.ingest(one, str(tmp_path))
    M.build_silver(one, F.lit(day), F.lit(day))
    assert {r.request_id: r.network_gap_s for r in one.read("silver_network_correlated").collect()} == whole


def test_distinct_counts_of_many_days_stay_within_their_error(spark):
    df = spark.range(400_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 30 * 86400).alias("t"), (F.col("id") * 7919 % 150_000).alias("v"))
    days = sketches.daily_sketches(df, "t", "v")
    got = sketches.distinct_values(days).first()
    assert days.count() == 30 and abs(got.distinct_values - 150_000) < 4 * sketches.RELATIVE_ERROR * 150_000
    again = sketches.merged(days, sketches.daily_sketches(df.filter("id < 1000"), "t", "v"))
    assert sketches.distinct_values(again).first() == got


def test_every_layer_and_confidence_occurs_and_owners_are_pseudonyms(spark, tmp_path):
    import hashlib
    import json

    from fixtures import at, execution

    (tmp_path / "in").mkdir()
    write_landing(tmp_path / "in")
    slow = {"CollectedAtUtc": at(20).replace(" ", "T") + "Z", "GatewayHostName": "H3",
            "NicMetrics": [{"NicName": "nic0", "BytesTotalPerSec_avg": 1e6, "CurrentBandwidthBps": 1e9, "UtilizationPct": 1.0, "SampleCount": 3}],
            "LatencyProbe": {"TargetHost": "relay", "LatencyMs_avg": 900.0, "LatencyMs_min": 1.0, "LatencyMs_max": 999.0}}
    (tmp_path / "in" / "network_metrics_4.json").write_text(json.dumps(slow))
    text = (tmp_path / "in" / "QueryExecutionReport1.csv").read_text()
    text += execution("n3", "r30", "Quiet", "t8", at(50), 10, False) + "\n" + execution("n3", "r31", "Quiet", "t9", at(52), 10, False, "odd") + "\n"
    (tmp_path / "in" / "QueryExecutionReport1.csv").write_text(text)
    lake = M.Lake(spark, str(tmp_path / "lake"))
    M.ingest(lake, str(tmp_path / "in"))
    activity = spark.createDataFrame([("act", "Ann", at(19), "Share", "w")], "activity_id string, user_alias string, t string, activity_artifact string, activity_workspace string")
    lake.append(activity.select("activity_id", "user_alias", F.col("t").cast("timestamp").alias("activity_ts"), "activity_artifact", "activity_workspace",
                                F.to_date("t").alias("partition_date")), "bronze_activity")
    monitoring = spark.createDataFrame([("r31", "ExecutionMetrics", at(52), "m1", "Bob", "item", "w")],
                                       "operation_id string, operation_name string, t string, record_id string, executing_user string, item_name string, workspace_id string")
    from pulsegrid.operators.joins import OWNER_OPERATIONS
    lake.append(monitoring.select("operation_id", F.lit(sorted(OWNER_OPERATIONS)[0]).alias("operation_name"), F.col("t").cast("timestamp").alias("mon_ts"),
                                  "record_id", "executing_user", "item_name", "workspace_id", F.to_date("t").alias("partition_date")), "bronze_monitoring")
    M.build_silver(lake, salt="pepper")
    layers = {r.request_id: r.failure_layer for r in lake.read("silver_triage").collect()}
    assert layers["r21"] == "NETWORK_LATENCY_SPIKE"
    assert set(layers.values()) == {"OS_SERVICE_EVENT", "SERVICE_REFRESH_ERROR", "NETWORK_LATENCY_SPIKE", "GATEWAY_LOG_ERROR", "UNKNOWN"}
    rows = {r.request_id: r for r in lake.read("silver_identity_attribution").collect()}
    assert {r.attribution_confidence for r in rows.values()} == {"EVALUATION_CONTEXT", "FUZZY_TIME_WINDOW", "UNATTRIBUTED"}
    code = lambda name: hashlib.sha256(f"pepper{name}".encode()).hexdigest()
    assert rows["r21"].user_alias == code("Ann") and rows["r31"].executing_user == code("Bob")
    M.build_silver(lake, plain_identities=True)
    assert {r.user_alias for r in lake.read("silver_identity_attribution").collect()} == {"Ann", None}
