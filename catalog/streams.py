"""Streaming queries run to completion over the given event files.

Each reads the table as a file stream with ``availableNow``, writes its result
to the shared folder and returns that table. Windows still open at the end stay
in state, so the checks compare what the final watermark has closed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import VIEWS
from catalog.registry import add
from pulsegrid.operators import history as K
from pulsegrid.session import prepare, shared_dir
from pulsegrid.sources.storage import read_table
from pulsegrid.streaming import health as H, ingest as I, stateful as P


class StreamReader:
    """Stands in for the session in the bindings: ``read`` becomes a file stream."""

    def __init__(self, spark):
        self.spark = prepare(spark)
        self.read = self
        self.declared = None

    def schema(self, schema):
        self.declared = schema
        return self

    def parquet(self, path):
        if self.declared is None:  # only the schema is asked for
            return self.spark.read.parquet(path)
        folder, name = path.rsplit("/", 1)
        return self.spark.readStream.schema(self.declared).option("pathGlobFilter", name).parquet(folder)

    def __getattr__(self, name):
        return getattr(self.spark, name)


def finished(spark, stream, purpose):
    """Run the stream to its end and return what it wrote."""
    out = shared_dir(spark, purpose)
    I.run_bronze(stream, out, f"{out}-checkpoint", partition=None)
    return spark.read.schema(stream.schema).parquet(out)


def streamed(view, s, d):
    return view(StreamReader(s), d)


VIEWS["stream_end"] = "SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events"
WINDOW_SQL = """count(*) AS query_count, count(*) FILTER (WHERE NOT success) AS error_count,
  round(avg(duration_ms), 2) AS duration_avg_ms, CAST(quantile_disc(duration_ms, 0.95) AS BIGINT) AS duration_p95_ms,
  round(count(*) FILTER (WHERE NOT success) * CAST(100 AS DOUBLE) / count(*), 2) AS error_rate_pct"""
add("stream_dedup",
    lambda s, d: finished(s, H.dedup(streamed(B.executions, s, d)).select("request_id", "tracking_id"), "dedup"),
    "SELECT DISTINCT request_id, tracking_id FROM executions")
add("stream_health_5min",
    lambda s, d: finished(s, H.health_5min(streamed(B.executions, s, d)), "health"),
    f"""SELECT node_id, time_bucket(INTERVAL 5 MINUTE, end_ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, end_ts) + INTERVAL 5 MINUTE AS window_end, {WINDOW_SQL} FROM executions
       GROUP BY 1, 2, 3 HAVING time_bucket(INTERVAL 5 MINUTE, end_ts) + INTERVAL 5 MINUTE <= (SELECT wm FROM stream_end)""")
add("stream_sliding_error_rate",
    lambda s, d: finished(s, H.sliding_error_rate(streamed(B.executions, s, d)), "sliding"),
    f"""SELECT node_id, w AS window_start, w + INTERVAL 5 MINUTE AS window_end, {WINDOW_SQL} FROM (
       SELECT *, time_bucket(INTERVAL 1 MINUTE, end_ts) - r.range * INTERVAL 1 MINUTE AS w FROM executions, range(5) r)
       WHERE w + INTERVAL 5 MINUTE <= (SELECT wm FROM stream_end) GROUP BY 1, 2, 3""")


def _stream_join(s, d):
    left = streamed(B.executions, s, d).filter(~F.col("success")).select("request_id", "end_ts", "node_id")
    right = streamed(B.refreshes, s, d).select(
        F.col("request_id").alias("operation_id"), F.col("end_ts").alias("mon_ts"), "dataset_id")
    return finished(s, H.identity_join(left, right, "5 minutes"), "join")


add("stream_identity_join", _stream_join,
    """WITH wm AS (SELECT least((SELECT max(end_ts) FROM executions WHERE NOT success), (SELECT max(end_ts) FROM refreshes))
         - INTERVAL 10 MINUTE AS t)
       SELECT e.request_id, e.end_ts, e.node_id, r.request_id AS operation_id, r.end_ts AS mon_ts, r.dataset_id
       FROM executions e LEFT JOIN refreshes r ON e.request_id = r.request_id
         AND r.end_ts >= e.end_ts AND r.end_ts <= e.end_ts + INTERVAL 5 MINUTE
       WHERE NOT e.success AND (r.request_id IS NOT NULL OR e.end_ts + INTERVAL 5 MINUTE < (SELECT t FROM wm))""")
add("stream_offline_detector",
    lambda s, d: finished(
        s, H.offline_events(streamed(B.inventory, s, d).filter("status = 'Live'"), "3 hours"), "offline"),
    """WITH b AS (SELECT node_id, collected_at, lag(collected_at) OVER (PARTITION BY node_id ORDER BY collected_at) AS p
         FROM inventory WHERE status = 'Live'),
       s AS (SELECT *, sum(CASE WHEN p IS NULL OR collected_at >= p + INTERVAL 3 HOUR THEN 1 ELSE 0 END)
         OVER (PARTITION BY node_id ORDER BY collected_at) AS run FROM b),
       r AS (SELECT node_id, min(collected_at) AS a, max(collected_at) AS z, count(*) AS heartbeats FROM s GROUP BY node_id, run),
       wm AS (SELECT max(collected_at) - INTERVAL 10 MINUTE AS t FROM inventory WHERE status = 'Live')
       SELECT node_id, 'LIVE' AS state, a AS at, NULL AS heartbeats, NULL AS last_seen FROM r WHERE a <= (SELECT t FROM wm)
       UNION ALL SELECT node_id, 'OFFLINE', z + INTERVAL 3 HOUR, heartbeats, z FROM r WHERE z + INTERVAL 3 HOUR <= (SELECT t FROM wm)""")


def _stream_bad(s, d):
    polls = streamed(B.datasource_polls, s, d).withColumn("bad", F.col("status") != "Live")
    return finished(s, P.consecutive_bad(polls), "bad")


VIEWS["third_bad"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY datasource_id, run ORDER BY collected_at, record_id) AS nth,
    min(sec) OVER (PARTITION BY datasource_id, run) AS started FROM (
  SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY datasource_id ORDER BY collected_at, record_id) AS run
  FROM poll_order)
  WHERE bad) WHERE nth = 3"""
add("stream_consecutive_bad", _stream_bad,
    """SELECT datasource_id, started AS run_start_s, sec AS fired_at_s, 3 AS polls FROM third_bad
       WHERE sec + 1 <= (SELECT epoch(max(collected_at)) - 600 FROM datasource_polls)""")


def _stream_breaker(s, d):
    fires = streamed(B.network, s, d).filter("utilization_pct > 10").select(
        "host_id", F.col("collected_at").alias("fired_at"))
    return finished(s, P.circuit_breaker(fires, 1, 3600), "breaker")


add("stream_circuit_breaker", _stream_breaker,
    """WITH c AS (SELECT host_id, CAST(floor(epoch(collected_at)) AS BIGINT) AS sec, count(*) AS fires
         FROM network WHERE utilization_pct > 10 GROUP BY 1, 2)
       SELECT a.host_id, a.sec, a.fires, CAST(sum(b.fires) AS BIGINT) AS fires_in_window, sum(b.fires) > 1 AS suppressed
       FROM c a JOIN c b ON a.host_id = b.host_id AND b.sec BETWEEN a.sec - 3600 AND a.sec
       WHERE a.sec + 1 <= (SELECT epoch(max(collected_at)) - 600 FROM network WHERE utilization_pct > 10)
       GROUP BY a.host_id, a.sec, a.fires""")


def _stream_upsert(s, d):
    """Window counts upserted on (node, window) as they change; the table is complete at the end."""
    out = shared_dir(s, "gold")
    stream = (
        streamed(B.executions, s, d)
        .withWatermark("end_ts", "10 minutes")
        .groupBy("node_id", F.window("end_ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("queries"))
        .select("node_id", F.col("w.start").alias("window_start"), "queries", F.to_date("w.start").alias("partition_date"))
    )
    I.stream_upsert(
        stream,
        lambda df: K.upsert_table(s, out, df, ["node_id", "window_start"], [F.col("queries").desc()]),
        f"{out}-checkpoint",
    )
    return read_table(s, out)


add("stream_upsert_gold", _stream_upsert,
    """SELECT node_id, date_trunc('hour', end_ts) AS window_start, count(*) AS queries,
       CAST(date_trunc('hour', end_ts) AS DATE) AS partition_date FROM executions GROUP BY 1, 2""")
add("stream_bronze",
    lambda s, d: finished(s, streamed(B.executions, s, d).select("request_id", "end_ts", "duration_ms", "success"), "bronze"),
    "SELECT request_id, end_ts, duration_ms, success FROM executions")


def _stream_late(s, d):
    out = shared_dir(s, "late")
    query = I.run_bronze(H.health_5min(streamed(B.executions, s, d)), out, f"{out}-checkpoint", partition=None)
    return I.late_data_report(query).groupBy("operator").agg(
        F.sum("dropped_rows").alias("dropped_rows"), F.sum("input_rows").alias("input_rows"))


add("stream_late_data_report", _stream_late)
