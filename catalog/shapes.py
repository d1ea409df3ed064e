"""Projections, filters, windows, rankings, set operations and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import AS_OF_SQL, VIEWS
from catalog.registry import add
from catalog.rollups import execs
from catalog.correlation import identity
from pulsegrid.functions import casts as Q, scalars as S, text as X
from pulsegrid.operators import dedup, history as K, joins as J, rollups as R, series as T
from pulsegrid.operators import stability as W
from pulsegrid.operators.quantiles import exact_quantile
from pulsegrid.plans import correlate as C



def cnt(name):
    return F.count(F.lit(1)).alias(name)


ID = ["request_id", "tracking_id"]

# ---- casts ---------------------------------------------------------------------------
# texts as they land: sentinels, decimals in whole-number columns, junk
VIEWS["raw_texts"] = """
SELECT event_id, CASE k % 8 WHEN 0 THEN 'NULL' WHEN 1 THEN 'N/A' WHEN 2 THEN '3.5' WHEN 3 THEN ''
         ELSE CAST(k AS VARCHAR) END AS amount,
       CASE k % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'x1' ELSE value || '' END AS rate,
       CASE k % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '0' WHEN 2 THEN 'TRUE' END AS flag,
       CASE k % 6 WHEN 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS seen FROM ev"""


def raw_texts(s, d):
    k = F.col("k")
    return B.ev(s, d).select(
        "event_id",
        F.when(k % 8 == 0, "NULL").when(k % 8 == 1, "N/A").when(k % 8 == 2, "3.5").when(k % 8 == 3, "")
        .otherwise(k.cast("string")).alias("amount"),
        F.when(k % 5 == 0, "nan").when(k % 5 == 1, "x1").otherwise(F.col("value").cast("string")).alias("rate"),
        F.when(k % 4 == 0, "yes").when(k % 4 == 1, "0").when(k % 4 == 2, "TRUE").alias("flag"),
        F.when(k % 6 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("seen"),
    )


def quarantined(s, d):
    return Q.cast_with_quarantine(
        raw_texts(s, d), {"amount": "long", "rate": "double", "flag": "boolean", "seen": "timestamp"})


VIEWS["quarantined"] = """
SELECT event_id, CASE WHEN amount NOT LIKE '%.%' THEN try_cast(amount AS BIGINT) END AS amount,
  CASE WHEN rate <> 'nan' THEN try_cast(rate AS DOUBLE) END AS rate,
  lower(trim(flag)) IN ('true', '1', 'yes') AS flag, try_cast(seen AS TIMESTAMP) AS seen,
  concat_ws(',', CASE WHEN amount IN ('N/A', '3.5') THEN 'amount' END,
    CASE WHEN rate = 'x1' THEN 'rate' END, CASE WHEN seen = 'yesterday' THEN 'seen' END) AS errors
FROM raw_texts"""
add("cast_with_quarantine",
    lambda s, d: quarantined(s, d).withColumn("errors", F.concat_ws(",", "_cast_errors")).drop("_cast_errors"),
    "SELECT * FROM quarantined")
add("null_sentinels",
    lambda s, d: raw_texts(s, d).select("event_id", Q.null_sentinels(F.col("amount")).alias("amount"),
                                        Q.null_sentinels(F.col("rate")).alias("rate")),
    """SELECT event_id, CASE WHEN lower(amount) IN ('', 'null', 'nan', 'none') THEN NULL ELSE amount END AS amount,
       CASE WHEN lower(rate) IN ('', 'null', 'nan', 'none') THEN NULL ELSE rate END AS rate FROM raw_texts""")
add("cast_success_flag",
    lambda s, d: raw_texts(s, d).groupBy(Q.success_flag(F.col("flag")).alias("flag")).agg(cnt("n")),
    "SELECT flag, count(*) AS n FROM quarantined GROUP BY 1")
add("cast_error_report",
    lambda s, d: quarantined(s, d).select(F.explode("_cast_errors").alias("column")).groupBy("column").agg(cnt("n")),
    """SELECT 'amount' AS column, count(*) AS n FROM quarantined WHERE errors LIKE '%amount%' UNION ALL
       SELECT 'rate', count(*) FROM quarantined WHERE errors LIKE '%rate%' UNION ALL
       SELECT 'seen', count(*) FROM quarantined WHERE errors LIKE '%seen%'""")

# ---- filters and scalar functions -----------------------------------------------------
add("lookback_filter",
    lambda s, d: J.lookback(B.executions(s, d), "end_ts", B.as_of(), 86400).select(*ID, "end_ts"),
    f"SELECT request_id, tracking_id, end_ts FROM executions WHERE end_ts > {AS_OF_SQL} - INTERVAL 1 DAY")
add("optional_in_filter",
    lambda s, d: K.tagged_union({
        "all": J.optional_in(B.monitoring(s, d), "workspace_id", []).agg(cnt("n")),
        "three": J.optional_in(B.monitoring(s, d), "workspace_id", [1, 2, 3]).agg(cnt("n")),
    }, "part"),
    """SELECT 'all' AS part, count(*) AS n FROM monitoring UNION ALL
       SELECT 'three', count(*) FROM monitoring WHERE workspace_id IN (1, 2, 3)""")
add("operation_filter",
    lambda s, d: J.owner_rows(B.monitoring(s, d)).groupBy("operation_name").agg(cnt("n")),
    """SELECT operation_name, count(*) AS n FROM monitoring
       WHERE operation_name IN ('QueryEnd', 'ExecutionMetrics', 'RefreshEnd') GROUP BY 1""")
add("is_empty_semantics",
    lambda s, d: raw_texts(s, d).groupBy(X.is_empty(F.col("amount")).alias("empty_amount"),
                                         X.not_empty(F.col("flag")).alias("has_flag")).agg(cnt("n")),
    "SELECT coalesce(amount, '') = '' AS empty_amount, coalesce(flag, '') <> '' AS has_flag, count(*) AS n FROM raw_texts GROUP BY 1, 2")
add("term_search",
    lambda s, d: B.read(s, d, "documents").select(
        "doc_id", X.has_term(F.col("text"), "data").alias("has_data"),
        X.has_any_term(F.col("text"), ["license", "email", "key"]).alias("has_any"),
        F.col("text").contains("the").alias("contains_the"),
        F.col("text").rlike("(?i)copyright|secret").alias("matches")),
    r"""SELECT doc_id, regexp_matches(text, '(^|[^a-zA-Z0-9])data([^a-zA-Z0-9]|$)', 'i') AS has_data,
       regexp_matches(text, '(^|[^a-zA-Z0-9])(license|email|key)([^a-zA-Z0-9]|$)', 'i') AS has_any,
       contains(text, 'the') AS contains_the, regexp_matches(text, 'copyright|secret', 'i') AS matches FROM documents""")
add("case_classify",
    lambda s, d: B.spool(s, d).groupBy(S.spool_status(F.col("free_pct")).alias("status")).agg(cnt("n")),
    """SELECT CASE WHEN free_pct <= 5 THEN 'CRITICAL' WHEN free_pct <= 15 THEN 'LOW' ELSE 'OK' END AS status,
       count(*) AS n FROM spool GROUP BY 1""")
add("derive_flags",
    lambda s, d: R.with_spool_flag(execs(s, d)).groupBy("query_type", "is_spooled").agg(cnt("n")),
    "SELECT query_type, spool_bytes > 0 AS is_spooled, count(*) AS n FROM execs GROUP BY 1, 2")
add("date_bucket",
    lambda s, d: B.executions(s, d).groupBy(
        F.to_date("end_ts").alias("day"), F.date_trunc("hour", "end_ts").alias("hour"),
        S.bin_start(F.col("end_ts"), 300).alias("bin")).agg(cnt("n")),
    """SELECT CAST(end_ts AS DATE) AS day, date_trunc('hour', end_ts) AS hour,
       time_bucket(INTERVAL 5 MINUTE, end_ts) AS bin, count(*) AS n FROM executions GROUP BY 1, 2, 3""")
add("json_extract",
    lambda s, d: B.read(s, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k_variant"),
        F.get_json_object("props", "$.missing").alias("missing")),
    """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.k' AS BIGINT) AS k_variant,
       props->>'$.missing' AS missing FROM events""")
add("safe_divide",
    lambda s, d: B.executions(s, d).select(
        "request_id", "end_ts", F.round(S.ratio(F.col("spool_bytes"), F.col("duration_ms")), 4).alias("plain"),
        F.round(S.ratio(F.col("duration_ms"), F.col("spool_bytes"), 0.0), 6).alias("with_alt")),
    """SELECT request_id, end_ts, round(CAST(spool_bytes AS DOUBLE) / nullif(duration_ms, 0), 4) AS plain,
       round(coalesce(CAST(duration_ms AS DOUBLE) / nullif(spool_bytes, 0), 0), 6) AS with_alt FROM executions""")
add("unit_convert",
    lambda s, d: execs(s, d).groupBy("node_id").agg(
        F.round(F.sum("duration_ms") / 1000.0, 3).alias("seconds"),
        F.round(F.sum("spool_bytes") / 1048576.0, 4).alias("mb"),
        F.round(F.sum("spool_bytes") / 1073741824.0, 6).alias("gb")),
    """SELECT node_id, round(sum(duration_ms) / CAST(1000 AS DOUBLE), 3) AS seconds,
       round(sum(spool_bytes) / CAST(1048576 AS DOUBLE), 4) AS mb,
       round(sum(spool_bytes) / CAST(1073741824 AS DOUBLE), 6) AS gb FROM execs GROUP BY 1""")
add("network_utilization",
    lambda s, d: B.network(s, d).groupBy("host_id", "nic", F.date_trunc("hour", "collected_at").alias("hour")).agg(
        F.avg("bytes_per_s").alias("b"), F.max("bandwidth_bps").alias("w"), cnt("samples")).select(
        "host_id", "nic", "hour", "samples", F.round(S.utilization_pct(F.col("b"), F.col("w")), 4).alias("utilization_pct")),
    """SELECT host_id, nic, date_trunc('hour', collected_at) AS hour, count(*) AS samples,
       round(least(100, avg(bytes_per_s) * 8 / max(bandwidth_bps) * 100), 4) AS utilization_pct
       FROM network GROUP BY 1, 2, 3""")
ADAPTERS = ["Ethernet 1", "isatap.local", "Teredo Tunneling", "Loopback Pseudo", "Ethernet 2"]
add("network_utilization_physical",
    lambda s, d: R.nic_utilization(B.network(s, d).withColumn(
        "nic", F.get(F.array(*[F.lit(a) for a in ADAPTERS]), (F.col("latency_ms") % 5).cast("int")))),
    f"""SELECT host_id, nic, date_trunc('hour', collected_at) AS hour, count(*) AS samples,
       round(least(100, avg(bytes_per_s) * 8 / avg(bandwidth_bps) * 100), 4) AS utilization_pct
       FROM (SELECT * EXCLUDE (nic), {ADAPTERS}[CAST(latency_ms AS INTEGER) % 5 + 1] AS nic FROM network)
       WHERE nic LIKE 'Ethernet%' GROUP BY 1, 2, 3""")
add("disk_alert_level",
    lambda s, d: B.spool(s, d).select(
        "record_id", F.round(S.free_pct(F.col("free_bytes"), F.col("total_bytes") - F.col("free_bytes")), 4).alias("pct")
    ).withColumn("alert_level", S.disk_level(F.col("pct"))),
    """SELECT record_id, round(CAST(free_bytes AS DOUBLE) / total_bytes * 100, 4) AS pct,
       CASE WHEN round(CAST(free_bytes AS DOUBLE) / total_bytes * 100, 4) <= 5 THEN 'ERROR'
            WHEN round(CAST(free_bytes AS DOUBLE) / total_bytes * 100, 4) <= 15 THEN 'WARNING' ELSE 'OK' END AS alert_level FROM spool""")
add("counter_delta_rate", lambda s, d: W.counter_delta_rate(B.processes(s, d)),
    """SELECT host_id, process_id, collected_at AS at,
       round(greatest(0, cpu_seconds - lag_c) / ((epoch_us(collected_at) - lag_us) / CAST(1000000 AS DOUBLE)) / CAST(4 AS DOUBLE) * 100, 4)
         AS cpu_pct FROM (
       SELECT *, epoch_us(lag(collected_at) OVER w) AS lag_us, lag(cpu_seconds) OVER w AS lag_c FROM processes
       WINDOW w AS (PARTITION BY host_id, process_id ORDER BY collected_at, cpu_seconds))
       WHERE epoch_us(collected_at) > lag_us""")
add("time_gap_seconds",
    lambda s, d: B.refreshes(s, d).select("request_id", "start_ts", S.gap_seconds(F.col("start_ts"), F.col("end_ts")).alias("gap_s"),
                                          F.round(S.minutes_between(F.col("start_ts"), F.col("end_ts")), 4).alias("minutes")),
    """SELECT request_id, start_ts, CAST(abs(epoch(start_ts) - epoch(end_ts)) AS BIGINT) AS gap_s,
       round((epoch(end_ts) - epoch(start_ts)) / 60, 4) AS minutes FROM refreshes""")
add("spool_rates",
    lambda s, d: execs(s, d).select(*ID, *J.spool_rates(
        F.col("spool_bytes"), F.col("spool_write_ms"), F.col("spool_read_ms"), F.col("duration_ms"))),
    """SELECT request_id, tracking_id,
       round(CAST(spool_bytes AS DOUBLE) / nullif(spool_write_ms, 0), 4) AS write_bytes_per_ms,
       round(CAST(spool_bytes AS DOUBLE) / nullif(spool_read_ms, 0), 4) AS read_bytes_per_ms,
       round(CAST(spool_write_ms AS DOUBLE) / nullif(duration_ms, 0), 4) AS spool_share FROM execs""")
add("throughput_efficiency",
    lambda s, d: execs(s, d).select(*ID, F.round(S.transfer_efficiency(
        F.col("spool_bytes"), F.col("duration_ms"), F.col("disk_read_bps")), 6).alias("efficiency")),
    """SELECT request_id, tracking_id, round(CASE WHEN spool_bytes > 0 AND duration_ms > 0 AND disk_read_bps > 0 THEN
       spool_bytes / (duration_ms / CAST(1000 AS DOUBLE) * disk_read_bps) END, 6) AS efficiency FROM execs""")
add("project_rename_extend",
    lambda s, d: B.executions(s, d).select("request_id", F.col("end_ts").alias("finished"), "duration_ms", "spool_bytes")
    .withColumns({"seconds": F.col("duration_ms") / 1000.0, "spooled": F.col("spool_bytes") > 0})
    .drop("spool_bytes").withColumnRenamed("duration_ms", "ms"),
    """SELECT request_id, end_ts AS finished, duration_ms AS ms, duration_ms / CAST(1000 AS DOUBLE) AS seconds,
       spool_bytes > 0 AS spooled FROM executions""")
add("string_functions",
    lambda s, d: B.read(s, d, "part").select(
        "p_partkey", X.leaf_name(F.concat(F.lit("Parts["), "p_name", F.lit("]"))).alias("leaf"),
        F.lower(F.trim("p_brand")).alias("brand"), F.col("p_type").startswith("S").alias("starts_s"),
        F.substring("p_name", 1, 19).alias("head"), F.coalesce(F.nullif("p_type", F.lit("")), F.lit("(none)")).alias("kind")),
    """SELECT p_partkey, p_name AS leaf, lower(trim(p_brand)) AS brand, starts_with(p_type, 'S') AS starts_s,
       substring(p_name, 1, 19) AS head, coalesce(nullif(p_type, ''), '(none)') AS kind FROM part""")
add("datetime_functions",
    lambda s, d: B.executions(s, d).select(
        "request_id", "end_ts",
        F.concat(F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).try_cast("timestamp").alias("parsed"),
        F.unix_timestamp("end_ts").alias("epoch_s"), F.to_date("end_ts").alias("day"),
        F.expr("timestampdiff(MINUTE, end_ts, timestamp'2024-01-31 00:00:00')").alias("minutes_left"),
        (F.col("end_ts") - F.expr("INTERVAL 10 MINUTES")).alias("ten_before"),
        F.add_months(F.to_date("end_ts"), -1).alias("month_before"),
        (F.to_date("end_ts") == F.to_date(F.date_sub(B.as_of().cast("date"), 1))).alias("last_day")),
    f"""SELECT request_id, end_ts, date_trunc('second', end_ts) AS parsed, CAST(floor(epoch(end_ts)) AS BIGINT) AS epoch_s,
       CAST(end_ts AS DATE) AS day, datesub('minute', end_ts, {AS_OF_SQL}) AS minutes_left,
       end_ts - INTERVAL 10 MINUTE AS ten_before, CAST(CAST(end_ts AS DATE) - INTERVAL 1 MONTH AS DATE) AS month_before,
       CAST(end_ts AS DATE) = DATE '2024-01-30' AS last_day FROM executions""")
add("math_functions",
    lambda s, d: B.ev(s, d).select("event_id", F.abs(F.col("value") - 50).alias("distance"), F.round("value", 1).alias("r1"),
                                   F.greatest(F.lit(0.0), F.col("value") - 20).alias("above"), F.least(F.lit(100.0), "value").alias("capped"),
                                   S.percent(F.col("k"), F.lit(99)).alias("pct")),
    """SELECT event_id, abs(value - 50) AS distance, round(value, 1) AS r1, greatest(0, value - 20) AS above,
       least(100, value) AS capped, round(k / CAST(99 AS DOUBLE) * 100, 2) AS pct FROM ev""")
add("array_functions",
    lambda s, d: B.ev(s, d).select(
        "event_id", F.array_compact(F.array(F.when(F.col("k") % 2 == 0, "even"), F.when(F.col("k") % 3 == 0, "three"),
                                            F.when(F.col("value") > 50, "large"))).alias("a")
    ).select("event_id", F.size("a").alias("n"), F.size(F.filter("a", lambda x: x != "even")).alias("n_not_even"),
             F.explode_outer("a").alias("tag")),
    """SELECT event_id, CAST(len(a) AS INTEGER) AS n, CAST(len(list_filter(a, lambda x: x <> 'even')) AS INTEGER) AS n_not_even,
       unnest(CASE WHEN len(a) = 0 THEN [NULL] ELSE a END) AS tag FROM (SELECT event_id, list_filter(
       [CASE WHEN k % 2 = 0 THEN 'even' END, CASE WHEN k % 3 = 0 THEN 'three' END, CASE WHEN value > 50 THEN 'large' END],
       lambda x: x IS NOT NULL) AS a FROM ev)""")

# ---- exact percentiles and their sketch -------------------------------------------------
add("percentile_exact",
    lambda s, d: exact_quantile(execs(s, d), ["query_type"], "duration_ms", 0.95).withColumn("quantile", F.round("quantile", 3)),
    "SELECT query_type, round(quantile_cont(duration_ms, 0.95), 3) AS quantile FROM execs GROUP BY 1")
add("percentile_approx",
    lambda s, d: execs(s, d).groupBy("node_id", "query_type").agg(R.p95(F.col("duration_ms")).alias("p95_ms")),
    "SELECT node_id, query_type, CAST(quantile_disc(duration_ms, 0.95) AS BIGINT) AS p95_ms FROM execs GROUP BY 1, 2")

# ---- windows and dedup ------------------------------------------------------------------
add("dedup_latest_wins", execs, "SELECT * FROM execs")
add("dedup_deterministic",
    lambda s, d: dedup.earliest_per_key(B.starts(s, d).select("node_id", "tracking_id", "start_ts", "request_id"),
                                        ["node_id", "tracking_id"], "start_ts", ["request_id"]),
    """SELECT node_id, tracking_id, start_ts, request_id FROM (SELECT *, row_number() OVER (
       PARTITION BY node_id, tracking_id ORDER BY start_ts, request_id) AS rn FROM starts) WHERE rn = 1""")
add("latest_snapshot",
    lambda s, d: R.newest_of(B.inventory(s, d), ["node_id"], "collected_at", ["record_id"]), "SELECT * FROM dim_now")
add("nearest_rank",
    lambda s, d: dedup.latest_wins(
        B.refreshes(s, d).withColumn("gap_s", S.gap_seconds(F.col("start_ts"), F.col("end_ts"))),
        ["dataset_id", "workspace_id"], [F.col("gap_s").asc_nulls_last(), F.col("end_ts"), F.col("request_id")],
    ).select("dataset_id", "workspace_id", "request_id", "gap_s"),
    """SELECT dataset_id, workspace_id, request_id, gap_s FROM (SELECT *, CAST(epoch(end_ts) - epoch(start_ts) AS BIGINT) AS gap_s,
       row_number() OVER (PARTITION BY dataset_id, workspace_id ORDER BY epoch(end_ts) - epoch(start_ts), end_ts, request_id) AS rn
       FROM refreshes) WHERE rn = 1""")
add("datasource_latest",
    lambda s, d: R.newest_of(B.datasource_polls(s, d), ["datasource_id"], "collected_at", ["record_id"]),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY datasource_id
       ORDER BY collected_at DESC, record_id DESC) AS rn FROM datasource_polls) WHERE rn = 1""")
SEC = "CAST(floor(epoch({})) AS BIGINT)"
TO_TS = "TIMESTAMP '1970-01-01 00:00:00' + {} * INTERVAL 1 SECOND"
VIEWS["poll_order"] = f"""
SELECT datasource_id, {SEC.format('collected_at')} AS sec, collected_at, record_id, status <> 'Live' AS bad FROM datasource_polls"""
VIEWS["poll_runs"] = f"""
SELECT datasource_id, bad, {TO_TS.format('min(sec)')} AS run_start, {TO_TS.format('max(sec)')} AS run_end, count(*) AS polls,
  {TO_TS.format('list(sec ORDER BY collected_at, record_id)[3]')} AS third_at
FROM (SELECT *, sum(new) OVER (PARTITION BY datasource_id ORDER BY collected_at, record_id) AS run FROM (
  SELECT *, CASE WHEN bad IS DISTINCT FROM lag(bad) OVER (PARTITION BY datasource_id ORDER BY collected_at, record_id)
    THEN 1 ELSE 0 END AS new FROM poll_order)) GROUP BY datasource_id, bad, run"""


def polls(s, d):
    return B.datasource_polls(s, d).withColumn("bad", F.col("status") != "Live")


add("consecutive_state_run",
    lambda s, d: W.consecutive_bad(polls(s, d), ["datasource_id"], "collected_at", ["record_id"], "bad", 3),
    "SELECT datasource_id, run_start, run_end, polls, third_at AS fired_at FROM poll_runs WHERE bad AND polls >= 3")
add("state_transition",
    lambda s, d: W.state_transitions(polls(s, d), ["datasource_id"], "collected_at", ["record_id"], "bad"),
    "SELECT datasource_id, run_start AS fired_at FROM poll_runs WHERE bad")
VIEWS["hot_nics"] = "SELECT host_id, collected_at, utilization_pct FROM network WHERE utilization_pct > 30"
add("fires_in_trailing_window",
    lambda s, d: W.fires_in_window(B.network(s, d).filter("utilization_pct > 30"), "host_id", "collected_at", 1800),
    f"""WITH c AS (SELECT host_id, {SEC.format('collected_at')} AS sec, count(*) AS fires FROM hot_nics GROUP BY 1, 2)
       SELECT a.host_id, a.sec, a.fires, CAST(sum(b.fires) AS BIGINT) AS fires_in_window FROM c a JOIN c b
       ON a.host_id = b.host_id AND b.sec BETWEEN a.sec - 1800 AND a.sec GROUP BY ALL""")
add("rolling_stats",
    lambda s, d: W.rolling_stats(B.counters(s, d), "node_id", "counter_ts", "system_cpu"),
    f"""SELECT a.node_id, {TO_TS.format('a.sec')} AS at, count(*) AS samples, round(avg(b.system_cpu), 3) AS mean,
       round(stddev_samp(b.system_cpu), 3) AS deviation
       FROM (SELECT DISTINCT node_id, {SEC.format('counter_ts')} AS sec FROM counters) a JOIN counters b
       ON a.node_id = b.node_id AND {SEC.format('b.counter_ts')} BETWEEN a.sec - 900 AND a.sec GROUP BY 1, 2""")
VIEWS["monthly"] = """SELECT operation, CAST(date_trunc('month', activity_ts) AS DATE) AS month, count(*) AS n
FROM activities GROUP BY 1, 2"""
add("period_over_period",
    lambda s, d: T.period_over_period(
        B.activities(s, d).groupBy("operation", F.to_date(F.date_trunc("month", "activity_ts")).alias("month")).agg(cnt("n")),
        "month", "n", ["operation"]),
    """SELECT c.*, p.n AS previous, round((c.n - p.n) / CAST(p.n AS DOUBLE) * 100, 2) AS change_pct
       FROM monthly c LEFT JOIN monthly p ON c.operation = p.operation AND c.month = p.month + INTERVAL 1 MONTH""")
add("share_of_total",
    lambda s, d: R.source_routing(execs(s, d)).groupBy("data_source", "node_id").agg(
        F.sum("queries").alias("queries"), F.round(F.sum("source_share_pct"), 1).alias("share_pct")),
    """SELECT data_source, node_id, CAST(sum(n) AS BIGINT) AS queries, round(sum(p), 1) AS share_pct FROM (
       SELECT data_source, node_id, cluster_id, count(*) AS n,
       round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY data_source), 2) AS p
       FROM execs GROUP BY 1, 2, 3) GROUP BY 1, 2""")
VIEWS["beats"] = f"""
SELECT *, sec - lag(sec) OVER (PARTITION BY node_id ORDER BY sec) AS gap_s FROM (
  SELECT DISTINCT node_id, {SEC.format('collected_at')} AS sec FROM inventory WHERE status = 'Live')"""
add("last_seen_gap",
    lambda s, d: W.longest_outage(B.inventory(s, d).filter("status = 'Live'"), ["node_id"], "collected_at"),
    f"""SELECT node_id, count(*) AS heartbeats, max(gap_s) AS longest_gap_s,
       {TO_TS.format('first(sec ORDER BY gap_s DESC NULLS LAST, sec)')} AS ended_at FROM beats GROUP BY 1""")
VIEWS["crashes"] = f"""
SELECT *, sec - lag(sec) OVER (PARTITION BY host_id ORDER BY sec) AS gap_s FROM (
  SELECT host_id, {SEC.format('evt_time')} AS sec, count(*) AS n FROM os_events
  WHERE os_event_id IN (7031, 7034, 7036) GROUP BY 1, 2)"""
add("service_stability",
    lambda s, d: W.service_stability(B.os_events(s, d)),
    f"""SELECT host_id, CAST({TO_TS.format('sec')} AS DATE) AS day, CAST(sum(n) AS BIGINT) AS service_events,
       round(avg(gap_s), 2) AS mean_gap_s, min(gap_s) AS min_gap_s FROM crashes GROUP BY 1, 2""")

# ---- orders, limits, rankings --------------------------------------------------------------
def newest():
    return [F.col("end_ts").desc(), F.col("request_id")]


add("order_newest",
    lambda s, d: execs(s, d).select(*ID, "end_ts").orderBy(*newest()),
    "SELECT request_id, tracking_id, end_ts FROM execs ORDER BY end_ts DESC, request_id")
add("take_n",
    lambda s, d: execs(s, d).select(*ID, "end_ts").orderBy(*newest()).limit(20),
    "SELECT request_id, tracking_id, end_ts FROM execs ORDER BY end_ts DESC, request_id LIMIT 20")
add("top_users_by_load",
    lambda s, d: identity(s, d).groupBy("executing_user").agg(
        F.sum("gateway_duration_ms").alias("total_ms"), cnt("queries"))
    .orderBy(F.col("total_ms").desc(), "executing_user").limit(20),
    """SELECT executing_user, CAST(sum(gateway_duration_ms) AS BIGINT) AS total_ms, count(*) AS queries FROM identity
       GROUP BY 1 ORDER BY total_ms DESC, executing_user LIMIT 20""")
add("top_items_by_spool",
    lambda s, d: identity(s, d).groupBy("item_name").agg(
        F.round(F.sum("spooled_bytes") / 1073741824.0, 6).alias("spooled_gb"))
    .orderBy(F.col("spooled_gb").desc(), "item_name").limit(20),
    """SELECT item_name, round(sum(spooled_bytes) / CAST(1073741824 AS DOUBLE), 6) AS spooled_gb FROM identity
       GROUP BY 1 ORDER BY spooled_gb DESC, item_name LIMIT 20""")
add("failed_with_owner",
    lambda s, d: identity(s, d).filter(~F.col("success")).select(
        "end_ts", "executing_user", "item_name", "data_source", "error_message"),
    "SELECT end_ts, executing_user, item_name, data_source, error_message FROM identity WHERE NOT success")
add("top_sources_by_duration",
    lambda s, d: execs(s, d).groupBy("data_source").agg(F.round(F.avg("duration_ms"), 2).alias("duration_avg_ms"))
    .orderBy(F.col("duration_avg_ms").desc(), "data_source"),
    """SELECT data_source, round(avg(duration_ms), 2) AS duration_avg_ms FROM execs GROUP BY 1
       ORDER BY duration_avg_ms DESC, data_source""")
add("failures_by_dataset",
    lambda s, d: B.refreshables(s, d).filter("status = 'Failed'").groupBy("dataset_id").agg(cnt("failures"))
    .orderBy(F.col("failures").desc(), "dataset_id"),
    """SELECT dataset_id, count(*) AS failures FROM refreshables WHERE status = 'Failed' GROUP BY 1
       ORDER BY failures DESC, dataset_id""")

# ---- set operations ---------------------------------------------------------------------------
add("union_by_name",
    lambda s, d: K.union_by_name(B.executions(s, d).select("request_id", "end_ts", "error_message"),
                                 B.refreshes(s, d).select("request_id", "end_ts", "dataset_id")),
    """SELECT request_id, end_ts, error_message, NULL::INTEGER AS dataset_id FROM executions UNION ALL
       SELECT request_id, end_ts, NULL, dataset_id FROM refreshes""")
add("tagged_union",
    lambda s, d: K.tagged_union({
        "spike": J.lookback(B.executions(s, d), "end_ts", B.as_of(), 7 * 86400).filter(~F.col("success")).select("request_id", "end_ts"),
        "baseline": J.between(B.executions(s, d), "end_ts", F.lit("2024-01-17").cast("timestamp"),
                              F.lit("2024-01-24").cast("timestamp")).filter(~F.col("success")).select("request_id", "end_ts"),
    }, "ab"),
    f"""SELECT request_id, end_ts, 'spike' AS ab FROM executions WHERE NOT success AND end_ts > {AS_OF_SQL} - INTERVAL 7 DAY
       UNION ALL SELECT request_id, end_ts, 'baseline' FROM executions WHERE NOT success
         AND end_ts BETWEEN TIMESTAMP '2024-01-17 00:00:00' AND TIMESTAMP '2024-01-24 00:00:00'""")
add("distinct_rows",
    lambda s, d: B.monitoring(s, d).select("operation_id", "executing_user", "item_name").distinct(),
    "SELECT DISTINCT operation_id, executing_user, item_name FROM monitoring")

# ---- tenant payloads, model joins -----------------------------------------------------------------
add("flatten_activities",
    lambda s, d: B.activities(s, d).select(
        "activity_id", "user_id", "operation",
        S.first_19(F.concat(F.date_format("activity_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".1234567Z"))).alias("activity_date")),
    "SELECT activity_id, user_id, operation, activity_ts AS activity_date FROM activities")
add("flatten_refreshables",
    lambda s, d: B.refreshables(s, d).select(
        "refresh_id", "dataset_id", F.coalesce("status", F.lit("Unknown")).alias("status"),
        S.refresh_seconds(F.col("start_ts"), F.col("end_ts")).alias("duration_seconds")),
    """SELECT refresh_id, dataset_id, coalesce(status, 'Unknown') AS status,
       coalesce(greatest(0, epoch(end_ts) - epoch(start_ts)), 0) AS duration_seconds FROM refreshables""")
add("capacity_usage_from_events",
    lambda s, d: R.capacity_usage(B.capacities(s, d), ["capacity_id", "usage_date"]),
    "SELECT capacity_id, usage_date, round(sum(cu_seconds), 4) AS cu_seconds FROM capacities GROUP BY 1, 2")
add("relationship_join",
    lambda s, d: J.relationship_join(
        B.activities(s, d), T.date_dimension(B.activities(s, d), "activity_ts"), F.to_date("activity_ts"), "date"
    ).groupBy("year_month").agg(cnt("activities"), F.count_distinct("user_id").alias("users")),
    """SELECT strftime(activity_ts, '%Y-%m') AS year_month, count(*) AS activities, count(DISTINCT user_id) AS users
       FROM activities GROUP BY 1""")
add("capacity_overlay",
    lambda s, d: J.capacity_overlay(
        execs(s, d).select(F.col("end_ts").alias("usage_ts"), (F.col("duration_ms") / 1000.0).alias("cu_seconds")),
        B.counters(s, d)),
    """SELECT coalesce(a.bin, b.bin) AS bin, a.cu_seconds, b.system_cpu_avg FROM
       (SELECT date_trunc('hour', end_ts) AS bin, round(sum(duration_ms / CAST(1000 AS DOUBLE)), 4) AS cu_seconds
        FROM execs GROUP BY 1) a FULL JOIN
       (SELECT date_trunc('hour', counter_ts) AS bin, round(avg(system_cpu), 4) AS system_cpu_avg FROM counters GROUP BY 1) b
       ON a.bin = b.bin""")

# ---- history and governance -------------------------------------------------------------------------
add("upsert_by_key",
    lambda s, d: K.upsert_by_key(
        R.health_5min(execs(s, d)).filter(F.col("window_start") < F.lit("2024-01-20").cast("timestamp")).withColumn("rev", F.lit(1)),
        R.health_5min(B.executions(s, d)).filter(F.col("window_start") >= F.lit("2024-01-15").cast("timestamp")).withColumn("rev", F.lit(2)),
        ["node_id", "window_start"], [F.col("rev").desc()],
    ).select("node_id", "window_start", "query_count_5min", "rev"),
    """WITH h AS (SELECT node_id, window_start, query_count_5min, 1 AS rev FROM health5 WHERE window_start < '2024-01-20'
       UNION ALL SELECT node_id, time_bucket(INTERVAL 5 MINUTE, end_ts), count(*), 2 FROM executions
         WHERE time_bucket(INTERVAL 5 MINUTE, end_ts) >= '2024-01-15' GROUP BY 1, 2)
       SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY node_id, window_start ORDER BY rev DESC) AS rn FROM h)
       WHERE rn = 1""")
VIEWS["versions"] = f"""
SELECT node_id, version, status, {TO_TS.format('from_sec')} AS valid_from, {TO_TS.format('next_sec')} AS valid_to,
  next_sec IS NULL AS is_current FROM (
  SELECT *, lead(from_sec) OVER (PARTITION BY node_id ORDER BY run) AS next_sec FROM (
    SELECT node_id, run, v.version AS version, v.status AS status, min(sec) AS from_sec FROM (
      SELECT *, sum(new) OVER (PARTITION BY node_id ORDER BY collected_at, record_id) AS run FROM (
        SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER (PARTITION BY node_id ORDER BY collected_at, record_id)
          THEN 1 ELSE 0 END AS new FROM (
          SELECT node_id, collected_at, record_id, {SEC.format('collected_at')} AS sec,
            {{'version': version, 'status': status}} AS v FROM inventory)))
    GROUP BY node_id, v, run))"""


def versions(s, d):
    return K.scd2_history(B.inventory(s, d), "node_id", "collected_at", ["record_id"], ["version", "status"])


add("scd2_history", versions, "SELECT * FROM versions")


def _merge(s, d):
    cut = F.lit("2024-01-20").cast("timestamp")
    early = K.scd2_history(B.inventory(s, d).filter(F.col("collected_at") < cut), "node_id", "collected_at",
                           ["record_id"], ["version", "status"])
    snap = R.newest_of(B.inventory(s, d), ["node_id"], "collected_at", ["record_id"]).select(
        "node_id", "version", "status", F.date_trunc("second", "collected_at").alias("seen_at"))
    return K.scd2_merge(early, snap, "node_id", ["version", "status"])


VIEWS["early_versions"] = VIEWS["versions"].replace("FROM inventory", "FROM inventory WHERE collected_at < '2024-01-20'")
VIEWS["snap"] = "SELECT node_id, version, status, date_trunc('second', collected_at) AS seen_at FROM dim_now"
add("scd2_merge", _merge,
    """WITH j AS (SELECT e.*, s.version AS sv, s.status AS ss, s.seen_at,
         e.version IS DISTINCT FROM s.version OR e.status IS DISTINCT FROM s.status AS changed
         FROM early_versions e LEFT JOIN snap s ON e.node_id = s.node_id WHERE e.is_current)
       SELECT * FROM early_versions WHERE NOT is_current UNION ALL
       SELECT node_id, version, status, valid_from, CASE WHEN changed THEN seen_at END, NOT changed FROM j UNION ALL
       SELECT node_id, sv, ss, seen_at, NULL, true FROM j WHERE changed UNION ALL
       SELECT node_id, version, status, seen_at, NULL, true FROM snap WHERE node_id NOT IN (SELECT node_id FROM early_versions)""")
add("dim_gateway", lambda s, d: K.current_dimension(B.inventory(s, d)),
    """SELECT node_id, cluster_id, cluster_name, node_name, version, status AS status_current, datasource_count,
       collected_at AS valid_from, NULL::TIMESTAMP AS valid_to, true AS is_current, CAST(collected_at AS DATE) AS partition_date FROM dim_now""")
add("retention_prune",
    lambda s, d: K.retained(execs(s, d).withColumn("partition_date", F.to_date("end_ts")), "identity",
                            F.lit("2024-02-20").cast("timestamp")).groupBy("partition_date").agg(cnt("n")),
    "SELECT CAST(end_ts AS DATE) AS partition_date, count(*) AS n FROM execs WHERE CAST(end_ts AS DATE) >= DATE '2024-01-21' GROUP BY 1")
add("pseudonymize_identity",
    lambda s, d: K.pseudonymize(B.monitoring(s, d).select("operation_id", "record_id", "cpu_ms", "executing_user"), ["executing_user"], "salt-1"),
    "SELECT operation_id, record_id, cpu_ms, sha256('salt-1' || executing_user) AS executing_user FROM monitoring")
add("row_scope_filter",
    lambda s, d: K.row_scope(
        execs(s, d).select(*ID, "cluster_id"),
        B.inventory(s, d).select(F.concat(F.lit("viewer-"), F.col("cluster_id").cast("string")).alias("viewer"), "cluster_id").distinct(),
        "viewer-1", "cluster_id"),
    "SELECT request_id, tracking_id, cluster_id FROM execs WHERE cluster_id = 1")
add("purge_subject",
    lambda s, d: K.purge_subject(B.activities(s, d), B.read(s, d, "customer").filter("c_acctbal < 0")
                                 .select(F.col("c_custkey").alias("user_id")), "user_id"),
    "SELECT * FROM activities WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
# the state at a moment when some nodes were down
VIEWS["down_then"] = """SELECT node_id FROM (SELECT *, row_number() OVER (PARTITION BY node_id
  ORDER BY collected_at DESC, record_id DESC) AS rn FROM inventory WHERE collected_at < '2024-01-25') WHERE rn = 1 AND status <> 'Live'"""
add("blast_radius",
    lambda s, d: C.blast_radius(
        R.newest_of(B.inventory(s, d).filter(F.col("collected_at") < F.lit("2024-01-25").cast("timestamp")), ["node_id"],
                    "collected_at", ["record_id"]).filter("status <> 'Live'"), execs(s, d)),
    """SELECT node_id, artifact_id, count(*) AS queries, max(end_ts) AS last_used FROM execs
       WHERE artifact_id IS NOT NULL AND node_id IN (SELECT node_id FROM down_then) GROUP BY 1, 2""")
