from pyspark.sql import functions as F

from pulsegrid.sources import tenant as T


def test_scanner_items_of_every_kind(spark, tmp_path):
    (tmp_path / "scan.json").write_text(
        '{"workspaces": [{"id": "w1", "name": "W", "capacityId": "c", "reports": [{"id": "r1", "name": "R"}, {"id": "r2", "name": "S"}],'
        ' "lakehouses": [{"id": "l1", "name": "L"}]}, {"id": "w2", "name": "V", "datasets": []}]}')
    rows = T.flatten_scanner_inventory(T.read_payload(spark, str(tmp_path / "scan.json"), T.SCAN)).collect()
    assert sorted((r.item_id, r.item_kind, r.workspace_id) for r in rows) == [
        ("l1", "Lakehouse", "w1"), ("r1", "Report", "w1"), ("r2", "Report", "w1")]


def test_activities_and_refreshables(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '[{"Id": "1", "UserId": "u", "Operation": "View", "CreationTime": "2024-03-05T10:11:12.123456Z"}, {"Id": "2", "UserId": "v"}]')
    got = {r.activity_id: r for r in T.flatten_activities(T.read_payload(spark, str(tmp_path / "a.json"), T.ACTIVITY)).collect()}
    assert str(got["1"].activity_date) == "2024-03-05 10:11:12" and got["2"].activity_date is None
    (tmp_path / "r.json").write_text(
        '[{"id": "d1", "name": "D", "group": {"id": "w"}, "capacity": {"id": "c"}, "lastRefresh": {"status": "Completed",'
        ' "startTime": "2024-03-05T10:00:00Z", "endTime": "2024-03-05T10:01:30.5Z"}},'
        ' {"id": "d2", "name": "E"}, {"id": "d3", "lastRefresh": {"startTime": "2024-03-05T10:00:00Z", "endTime": "2024-03-05T09:00:00Z"}}]')
    got = {r.dataset_id: r for r in T.flatten_refreshables(T.read_payload(spark, str(tmp_path / "r.json"), T.REFRESHABLE)).collect()}
    assert (got["d1"].duration_seconds, got["d2"].duration_seconds, got["d3"].duration_seconds) == (90.5, 0.0, 0.0)
    assert got["d2"].status == "Unknown" and got["d1"].workspace_id == "w"


def test_bracketed_names(spark):
    df = spark.createDataFrame([("c", "n", 5.0, "2024-03-05")], ["Caps[Capacity Id]", "Other[CapacityName]", "[CU_s]", "TimePoints[Date]"])
    row = T.normalize_bracketed_keys(df).first()
    assert (row.capacity_id, row.capacity_name, row.cu_seconds, row.usage_date, row.sku) == ("c", "n", 5.0, "2024-03-05", None)
    maps = spark.createDataFrame([({"X[Capacity Id]": "c", "[CU_s]": "7"},)], "m map<string,string>")
    row = maps.select(*T.normalize_bracketed_map(F.col("m"))).first()
    assert (row.capacity_id, row.cu_seconds, row.region) == ("c", "7", None)


def test_envelopes_and_drilldown(spark):
    now = F.lit("2024-03-05").cast("timestamp")
    raw = spark.createDataFrame(
        [("groups", "org/groups", '{"value": [{"id": "w1", "name": "W"}, {"id": "w2", "name": "V"}]}'),
         ("datasets", "org/groups/w1/datasets", '{"value": [{"id": "d1", "name": "D"}]}'),
         ("refreshes", "org/groups/w1/datasets/d1/refreshes", '{"value": [{"requestId": "r", "status": "Failed"}, {"requestId": "s", "status": "Completed"}]}'),
         ("datasources", "org/groups/w1/datasets/d1/datasources", '{"value": [{"datasourceId": "s1", "gatewayId": "g1"}]}')],
        "entity_type string, source_file string, payload string").withColumn("ingestion_ts", now)
    got = {r.workspace_id: r for r in T.entity_drilldown(raw).collect()}
    assert (got["w1"].refreshes, got["w1"].failed_refreshes, got["w1"].datasources) == (2, 1, 1)
    assert got["w2"].dataset_id is None and got["w2"].refreshes == 0
    wrapped = T.envelope(spark.createDataFrame([(1, "x")], "a int, b string"), "thing", "src", now)
    assert T.envelope_parse(wrapped, "thing", "a int, b string").select("a", "b").first() == (1, "x")
    empty = T.envelope_parse(wrapped.filter("false"), "thing", "a int, b string")
    assert empty.columns == ["ingestion_ts", "source_file", "a", "b"] and empty.count() == 0
