"""Streams fed file by file: late rows, replays and state across batches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.streaming import health as H, ingest as I, stateful as P

T0 = 1_700_000_000 // 3600 * 3600


class Feed:
    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema, self.n = spark, root, schema, 0
        (root / "in").mkdir()

    def put(self, *rows):
        self.n += 1
        path = self.root / "in" / f"{self.n:03d}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (T0 + self.n, T0 + self.n))  # files are taken in time order

    def stream(self, time):
        df = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.root / "in"))
        return df.withColumn(time, F.timestamp_seconds("s"))

    def run(self, stream):
        self.query = I.run_bronze(stream, str(self.root / "out"), str(self.root / "cp"), partition=None)
        return self.spark.read.schema(stream.schema).parquet(str(self.root / "out"))


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path, schema)


def execution(request, s, ok=True, node="n1"):
    return {"request_id": request, "tracking_id": "t", "node_id": node, "s": T0 + s, "success": ok, "duration_ms": 10}


EXEC = "request_id string, tracking_id string, node_id string, s bigint, success boolean, duration_ms bigint"


def test_replays_are_dropped_across_batches(feed):
    f = feed(EXEC)
    f.put(execution("a", 0), execution("a", 0), execution("b", 5))
    f.put(execution("a", 60), execution("c", 70))
    out = f.run(H.dedup(f.stream("end_ts")))
    assert sorted(r.request_id for r in out.collect()) == ["a", "b", "c"]


def test_windows_close_once_and_late_rows_are_counted(feed):
    f = feed(EXEC)
    f.put(execution("a", 0), execution("b", 10, False))
    f.put(execution("c", 1800))
    f.put(execution("c2", 1900))
    f.put(execution("late", 20), execution("d", 3600))
    out = f.run(H.health_5min(f.stream("end_ts")))
    got = sorted((r.query_count, r.error_rate_pct) for r in out.collect())
    assert got == [(2, 0.0), (2, 50.0)]
    report = I.late_data_report(f.query)
    assert report.agg(F.sum("dropped_rows")).first()[0] == 1


def test_owner_that_arrives_later_and_owner_that_never_does(spark, tmp_path):
    (tmp_path / "l").mkdir(), (tmp_path / "r").mkdir()
    left, right = Feed(spark, tmp_path / "l", EXEC), Feed(spark, tmp_path / "r", "operation_id string, s bigint, executing_user string")
    left.put(execution("a", 0), execution("b", 10))
    left.put(execution("z", 7200))
    right.put({"operation_id": "a", "s": T0 + 240, "executing_user": "u"}, {"operation_id": "b", "s": T0 + 4000, "executing_user": "v"})
    right.put({"operation_id": "q", "s": T0 + 7300, "executing_user": "w"})
    out = left.run(H.identity_join(left.stream("end_ts").drop("s"), right.stream("mon_ts").drop("s"), "10 minutes"))
    assert {(r.request_id, r.executing_user) for r in out.collect()} == {("a", "u"), ("b", None)}


def test_offline_and_live_once_each_even_out_of_order(feed):
    f = feed("node_id string, s bigint")
    beat = lambda s, n="n1": {"node_id": n, "s": T0 + s}
    f.put(beat(0), beat(600))
    f.put(beat(300), beat(900))  # 300 arrives late but inside the delay
    f.put(beat(4000), beat(9000, "n2"))
    f.put(beat(20000, "n2"))
    out = f.run(H.offline_events(f.stream("collected_at")))
    events = sorted((r.node_id, int(r.at.timestamp()) - int(r.at.timestamp()) % 1, r.state) for r in out.collect())
    states = [(n, s) for n, _, s in events]
    assert states == [("n1", "LIVE"), ("n1", "OFFLINE"), ("n1", "LIVE"), ("n1", "OFFLINE"), ("n2", "LIVE"), ("n2", "OFFLINE")]


def test_bad_runs_continue_over_batches(feed):
    f = feed("datasource_id bigint, s bigint, record_id bigint, bad boolean")
    poll = lambda s, bad, d=1: {"datasource_id": d, "s": T0 + s, "record_id": s, "bad": bad}
    f.put(poll(0, True), poll(300, True), poll(0, True, 2))
    f.put(poll(1200, True), poll(1300, False, 2), poll(1500, True))
    f.put(poll(5000, False), poll(9000, True))
    out = f.run(P.consecutive_bad(f.stream("collected_at"), 3))
    assert [(r.datasource_id, r.run_start_s - T0, r.fired_at_s - T0, r.polls) for r in out.collect()] == [(1, 0, 1200, 3)]


def test_breaker_remembers_fires_over_batches(feed):
    f = feed("host_id bigint, s bigint")
    fire = lambda s: {"host_id": 1, "s": T0 + s}
    f.put(fire(0), fire(0), fire(100))
    f.put(fire(1000), fire(1900), fire(1950))
    f.put(fire(9000))
    f.put(fire(20000))
    out = f.run(P.circuit_breaker(f.stream("fired_at"), 3, 1800))
    got = {r.sec - T0: (r.fires_in_window, r.suppressed) for r in out.collect()}
    assert got == {0: (2, False), 100: (3, False), 1000: (4, True), 1900: (3, False), 1950: (3, False), 9000: (1, False)}


def _kept(query):
    """State rows of the alert rule after the last batch."""
    return [s["numRowsTotal"] for s in query.lastProgress["stateOperators"] if "transformWithState" in s["operatorName"]][0]


def test_silent_hosts_leave_the_store(feed):
    f = feed("host_id bigint, s bigint")
    f.put(*[{"host_id": h, "s": T0 + h} for h in range(40)])
    f.put({"host_id": 1, "s": T0 + 1500})
    f.put({"host_id": 99, "s": T0 + 2200})
    f.run(P.circuit_breaker(f.stream("fired_at"), 3, 1800))
    many = _kept(f.query)
    f.put({"host_id": 99, "s": T0 + 20000})
    f.put({"host_id": 99, "s": T0 + 40000})
    out = f.run(P.circuit_breaker(f.stream("fired_at"), 3, 1800))
    assert many >= 40 and _kept(f.query) < 10
    got = {(r.host_id, r.sec - T0): r.fires_in_window for r in out.collect()}
    assert got[1, 1500] == 2 and got[99, 2200] == 1 and got[99, 20000] == 1 and len(got) == 43


def test_sources_that_are_well_leave_the_store(feed):
    f = feed("datasource_id bigint, s bigint, record_id bigint, bad boolean")
    poll = lambda d, s, bad: {"datasource_id": d, "s": T0 + s, "record_id": s, "bad": bad}
    f.put(*[poll(d, 0, d == 7) for d in range(40)])
    f.put(poll(7, 300, True), poll(50, 5000, False))
    f.put(poll(50, 9000, False))
    f.put(poll(7, 12000, True), poll(50, 20000, False))
    f.put(poll(50, 30000, False))
    out = f.run(P.consecutive_bad(f.stream("collected_at"), 3))
    assert [(r.datasource_id, r.fired_at_s - T0) for r in out.collect()] == [(7, 12000)]
    assert _kept(f.query) < 10
