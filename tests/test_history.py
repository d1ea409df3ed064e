import json

from pyspark.sql import functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions.text import decode_context, leaf_name
from pulsegrid.operators import history as H, patterns as D
from pulsegrid.plans import alerts as A, correlate as C
from pulsegrid.sources import storage as S


def ts(text):
    return F.lit(text).cast("timestamp")


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    rows = lambda data: spark.createDataFrame(data, "k int, v int, d string").select("k", "v", F.to_date("d").alias("partition_date"))
    order = [F.col("v").desc()]
    H.upsert_table(spark, path, rows([(1, 1, "2024-01-01"), (2, 1, "2024-01-02"), (2, 3, "2024-01-02")]), ["k"], order)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "gold" / "partition_date=2024-01-01").glob("*.parquet")}
    H.upsert_table(spark, path, rows([(2, 9, "2024-01-02"), (3, 1, "2024-01-03")]), ["k"], order)
    got = {(r.k, r.v) for r in S.read_table(spark, path).collect()}
    assert got == {(1, 1), (2, 9), (3, 1)}
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "gold" / "partition_date=2024-01-01").glob("*.parquet")} == untouched


def test_a_key_that_moves_has_one_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "gold")
    rows = lambda data: spark.createDataFrame(data, "k int, v int, d string").select("k", "v", F.to_date("d").alias("partition_date"))
    order = [F.col("v").desc()]
    got = lambda: sorted(((r.k, r.v, str(r.partition_date)) for r in S.read_table(spark, path).collect()), key=str)
    files = lambda day: {f: f.stat().st_mtime_ns for f in (tmp_path / "gold" / f"partition_date={day}").glob("*.parquet")}
    H.upsert_table(spark, path, rows([(1, 1, "2024-01-01"), (2, 1, "2024-01-02"), (3, 1, "2024-01-02"), (4, 1, "2024-01-04"), (None, 1, "2024-01-01")]), ["k"], order)
    untouched = files("2024-01-02")
    change = rows([(1, 5, "2024-01-03"), (4, 0, "2024-01-03"), (None, 3, None), (9, 1, "2024-01-03")])
    want = sorted([(1, 5, "2024-01-03"), (2, 1, "2024-01-02"), (3, 1, "2024-01-02"), (4, 1, "2024-01-04"), (None, 3, "None"), (9, 1, "2024-01-03")], key=str)
    # cut off before the old rows are gone, then run again
    drop = S.drop_partitions
    monkeypatch.setattr(S, "drop_partitions", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    try:
        H.upsert_table(spark, path, change, ["k"], order)
    except OSError:
        pass
    monkeypatch.setattr(S, "drop_partitions", drop)
    for _ in range(2):
        H.upsert_table(spark, path, change, ["k"], order)
        assert got() == want
    assert files("2024-01-02") == untouched and not (tmp_path / "gold" / "partition_date=2024-01-01").exists()
    H.upsert_table(spark, path, rows([(1, 7, "2024-01-02")]), ["k"], order)
    assert (1, 7, "2024-01-02") in got() and len(got()) == 6


def test_expired_days_and_purged_subjects_are_gone_from_storage(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = spark.createDataFrame(
        [(u, d) for d in ("2024-01-01", "2024-02-01", "2024-02-02", "2024-02-03") for u in ("a", "b")] + [("z", "2024-02-03"), (None, "2024-02-03"), ("only", "2024-02-05")],
        "user string, d string").select("user", F.to_date("d").alias("partition_date"))
    S.write_bronze(rows, path)
    S.write_bronze(rows.filter("user = 'z'"), path, batch="second")
    cfg = DEFAULTS.with_overrides(bronze_days=20)
    assert [str(d) for d in H.drop_expired(spark, path, "bronze", ts("2024-02-10"), cfg)] == ["2024-01-01"]
    assert not (tmp_path / "bronze" / "partition_date=2024-01-01").exists()
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "bronze").glob("partition_date=2024-02-0[12]/*/*.parquet")}
    gone = spark.createDataFrame([("z",), ("only",), (None,)], "user string")
    assert {str(d) for d in H.purge_table(spark, path, gone, "user")} == {"2024-02-03", "2024-02-05"}
    left = S.read_table(spark, path)
    assert sorted(((r.user, str(r.partition_date)) for r in left.collect()), key=str) == sorted(
        [(u, d) for d in ("2024-02-01", "2024-02-02", "2024-02-03") for u in ("a", "b")] + [(None, "2024-02-03")], key=str)
    assert {f: f.stat().st_mtime_ns for f in before} == before
    assert H.purge_table(spark, path, gone, "user") == [] and H.drop_expired(spark, str(tmp_path / "none"), "gold", ts("2024-02-10")) == []


def test_bronze_schema_grows_and_dates_prune(spark, tmp_path):
    path = str(tmp_path / "bronze")
    one = spark.createDataFrame([("a", "2024-01-01")], "k string, d string").select("k", F.to_date("d").alias("partition_date"))
    S.write_bronze(one, path)
    S.write_bronze(one.withColumns({"fresh": F.lit(1), "partition_date": F.lit("2024-01-02").cast("date")}), path)
    df = S.read_table(spark, path)
    assert {(r.k, r.fresh) for r in df.collect()} == {("a", None), ("a", 1)}
    plan = S.in_partitions(df, ts("2024-01-02"), ts("2024-01-03"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    assert S.external_table(spark, "parquet", path, {"k": "key"}).columns == ["key"]
    kept = H.retained(df, "gold", ts("2024-12-31"), DEFAULTS.with_overrides(gold_days=364))
    assert kept.count() == 1


def test_purge_and_scope(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "u int, c string")
    assert H.purge_subject(df, spark.createDataFrame([(1,)], "u int"), "u").count() == 1
    grants = spark.createDataFrame([("x", "a")], "viewer string, c string")
    assert [r.u for r in H.row_scope(df, grants, "x", "c").collect()] == [1]
    assert H.row_scope(df, grants, "y", "c").count() == 0


def test_scd2_merge_opens_closes_and_keeps(spark):
    history = spark.createDataFrame([(1, "v1", True), (2, "v1", True), (4, "v1", True)], "k int, version string, is_current boolean").select(
        "k", "version", ts("2024-01-01").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), "is_current")
    snapshot = spark.createDataFrame([(1, "v2"), (2, "v1"), (3, "v1")], "k int, version string").withColumn("seen_at", ts("2024-02-01"))
    got = {(r.k, r.version, r.is_current, r.valid_to is None) for r in H.scd2_merge(history, snapshot, "k", ["version"]).collect()}
    assert got == {(1, "v1", False, False), (1, "v2", True, True), (2, "v1", True, True), (3, "v1", True, True), (4, "v1", True, True)}


def test_context_decoding(spark):
    import base64

    text = '{"artifactId":"x"}'
    data = [(text,), ("  " + text,), (base64.b64encode(text.encode()).decode(),), ("",), (None,), ("junk!",), ("bm90IGpzb24=",), ("//79",)]
    got = [r[0] for r in spark.createDataFrame(data, "c string").select(decode_context(F.col("c"))).collect()]
    assert got == [text, text, text, None, None, None, None, None]
    assert spark.range(1).select(leaf_name(F.lit("T[Capacity Id]"))).first()[0] == "Capacity Id"


def test_repeated_tracking_ids_of_one_request_all_survive(spark):
    """Two attempts of one request fail at once: both keep their row in every tier."""
    rows = spark.createDataFrame(
        [("r", t, "n", "h", "s", "q", 100, 10, False, "m", 0) for t in ("t1", "t2")],
        "request_id string, tracking_id string, node_id string, host_id string, data_source string, query_type string, e bigint,"
        "duration_ms bigint, success boolean, error_message string, spool_bytes bigint",
    ).withColumns({"end_ts": F.timestamp_seconds("e"), "artifact_id": F.lit(None).cast("string")})
    refresh = spark.createDataFrame([("r", "d1", 90), ("r", "d2", 95)], "request_id string, dataset_id string, e bigint").select(
        "request_id", "dataset_id", F.lit("w").alias("workspace_id"), F.lit("Failed").alias("status"),
        F.timestamp_seconds("e").alias("start_ts"), F.timestamp_seconds("e").alias("end_ts"), F.lit("").alias("service_exception"))
    got = C.silver_triage(rows, refresh, None).collect()
    assert sorted(r.tracking_id for r in got) == ["t1", "t2"]
    assert {r.refresh_dataset_id for r in got} == {"d2"}
    assert {r.triage_confidence for r in C.silver_triage(rows, None, None).collect()} == {"GATEWAY_ONLY"}
    latency = rows.select("request_id", "tracking_id").withColumn("latency_ms", F.lit(500.0))
    assert {r.failure_layer for r in C.silver_triage(rows, None, None, latency=latency).collect()} == {"NETWORK_LATENCY_SPIKE"}


def test_settings_from_file():
    text = json.dumps({"alerting": {"gatewayOfflineThresholdMinutes": 7, "credentialDriftConsecutiveIntervals": 4, "notificationEmails": []}})
    cfg = Settings.from_json(text)
    assert (cfg.offline_minutes, cfg.bad_polls, cfg.spool_warn_pct) == (7.0, 4, 15.0)


def test_render_and_patterns(spark):
    df = spark.createDataFrame([("n", 1.25, None)], "a string, b double, c string")
    assert df.select(A.render("{a}: {b}% {c}", df)).first()[0] == "n: 1.3% ?"
    rows = spark.createDataFrame([(True, "x", "p")] * 8 + [(True, "y", "q")] * 2 + [(False, "y", "q")] * 9 + [(False, "x", "p")],
                                 "spike boolean, s string, t string")
    top = D.diff_patterns(rows, F.col("spike"), ["s", "t"]).collect()
    # s and t move together, so only one-column patterns remain
    assert {r.pattern for r in top} == {"s=x", "t=p", "s=y", "t=q"} and top[0].difference_pct in (70.0, -70.0)
    assert D.auto_cluster(rows, ["s", "t"]).first().pattern == "s=y & t=q"


def test_versions_within_one_second(spark):
    rows = [(1, 10.1, 1, "a"), (1, 10.2, 2, "b"), (1, 10.9, 3, "a"), (1, 700.0, 4, "a"), (1, 900.0, 5, "c")]
    df = spark.createDataFrame(rows, "k int, t double, tie int, v string").withColumn("t", F.col("t").cast("timestamp"))
    got = H.scd2_history(df, "k", "t", ["tie"], ["v"]).select(
        "v", F.unix_timestamp("valid_from").alias("a"), F.unix_timestamp("valid_to").alias("b"), "is_current").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a", 10, 10, False), ("b", 10, 10, False), ("a", 10, 900, False), ("c", 900, None, True)], key=str)
