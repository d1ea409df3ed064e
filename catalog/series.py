"""Time-series and pattern-mining queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bindings as B
from catalog.bindings import AS_OF_SQL, VIEWS
from catalog.registry import add
from catalog.rollups import execs
from pulsegrid.functions.text import causal_class, error_class
from pulsegrid.operators import joins as J, patterns as D, series as T

FIRST = "2024-01-01 00:00:00"
HOUR, FIVE = 3600, 300


def ts(text: str):
    return F.lit(text).cast("timestamp")


def series_view(key, view, time, value, start, steps, step, default="0"):
    """Grid times keys, left joined with the binned values."""
    return f"""
SELECT g.{key}, g.idx, TIMESTAMP '{start}' + g.idx * INTERVAL {step} SECOND AS bin,
       coalesce(b.v, CAST({default} AS DOUBLE)) AS value
FROM (SELECT k.{key}, CAST(i.range AS INTEGER) AS idx FROM (SELECT DISTINCT {key} FROM {view}
        WHERE {time} >= TIMESTAMP '{start}' AND {time} < TIMESTAMP '{start}' + {steps} * INTERVAL {step} SECOND) k,
        range({steps}) i) g
LEFT JOIN (SELECT {key}, CAST(floor((floor(epoch({time})) - epoch(TIMESTAMP '{start}')) / {step}) AS INTEGER) AS idx,
        CAST({value} AS DOUBLE) AS v FROM {view}
        WHERE {time} >= TIMESTAMP '{start}' AND {time} < TIMESTAMP '{start}' + {steps} * INTERVAL {step} SECOND
        GROUP BY 1, 2) b ON g.{key} = b.{key} AND g.idx = b.idx"""


def fitted_view(view, key, period):
    return f"""
SELECT *, avg(value - trend) OVER (PARTITION BY {key}, slot) AS seasonal FROM (
  SELECT *, intercept + slope * idx AS trend, idx % {period} AS slot FROM (
    SELECT *, regr_slope(value, idx) OVER (PARTITION BY {key}) AS slope,
      regr_intercept(value, idx) OVER (PARTITION BY {key}) AS intercept FROM {view}))"""


def period_view(view, key):
    """Highest significant peak of the autocorrelation at all lags, behind its first dip; else 1."""
    return f"""
WITH flat AS (
  SELECT {key}, idx, value - (intercept + slope * idx) AS d, steps FROM (
    SELECT *, regr_slope(value, idx) OVER (PARTITION BY {key}) AS slope, count(*) OVER (PARTITION BY {key}) AS steps,
      regr_intercept(value, idx) OVER (PARTITION BY {key}) AS intercept FROM {view})),
squares AS (SELECT {key}, sum(d * d) AS q, any_value(steps) AS steps FROM flat GROUP BY 1),
lags AS (
  SELECT a.{key}, a.idx - b.idx AS p, round(sum(a.d * b.d) / any_value(q), 6) AS r, any_value(s.steps) AS steps
  FROM flat a JOIN flat b ON a.{key} = b.{key} AND a.idx - b.idx BETWEEN 1 AND a.steps // 2
  JOIN squares s ON s.{key} = a.{key} WHERE q > 1e-9 GROUP BY 1, 2),
near AS (
  SELECT *, lag(r) OVER w AS before, lead(r) OVER w AS behind,
    min(CASE WHEN r <= 0 THEN p END) OVER (PARTITION BY {key}) AS dip FROM lags WINDOW w AS (PARTITION BY {key} ORDER BY p)),
peaks AS (
  SELECT {key}, p, r, row_number() OVER (PARTITION BY {key} ORDER BY r DESC, p) AS rn
  FROM near WHERE p > dip AND r >= before AND r > behind AND r > 2.0 / sqrt(steps))
SELECT s.{key}, CAST(coalesce(p, 1) AS INTEGER) AS period, r AS autocorrelation
FROM squares s LEFT JOIN peaks k ON k.{key} = s.{key} AND rn = 1"""


def auto_fitted_view(view, key):
    return f"""
SELECT *, avg(value - trend) OVER (PARTITION BY {key}, slot) AS seasonal FROM (
  SELECT *, intercept + slope * idx AS trend, idx % period AS slot FROM (
    SELECT v.*, p.period, regr_slope(value, idx) OVER (PARTITION BY v.{key}) AS slope,
      regr_intercept(value, idx) OVER (PARTITION BY v.{key}) AS intercept
    FROM {view} v JOIN {view}_period p ON v.{key} = p.{key}))"""


def scored_view(fitted, key, threshold):
    return f"""
SELECT {key}, idx, bin, value, baseline, score,
  CASE WHEN score > {threshold} THEN 1 WHEN score < -{threshold} THEN -1 ELSE 0 END AS flag FROM (
  SELECT *, CASE WHEN p90 - p10 <= 1e-9 THEN 0 WHEN r > p90 THEN (r - p90) / (p90 - p10)
      WHEN r < p10 THEN (r - p10) / (p90 - p10) ELSE 0 END AS score FROM (
    SELECT *, quantile_cont(r, 0.1) OVER (PARTITION BY {key}) AS p10,
      quantile_cont(r, 0.9) OVER (PARTITION BY {key}) AS p90 FROM (
      SELECT *, trend + seasonal AS baseline, value - trend - seasonal AS r FROM {fitted})))"""


# hourly CPU over the whole month, daily season
VIEWS["cpu_series"] = series_view("node_id", "counters", "counter_ts", "avg(system_cpu)", FIRST, 720, HOUR)
VIEWS["cpu_fit"] = fitted_view("cpu_series", "node_id", 24)
VIEWS["cpu_scored"] = scored_view("cpu_fit", "node_id", 1.5)
# five-minute CPU over the last week before as_of, daily season of 288 steps
VIEWS["cpu5_series"] = series_view(
    "node_id", "counters", "counter_ts", "avg(system_cpu)", "2024-01-24 00:00:00", 2016, FIVE)
VIEWS["cpu5_fit"] = fitted_view("cpu5_series", "node_id", 288)
VIEWS["cpu5_scored"] = scored_view("cpu5_fit", "node_id", 1.5)
# free spool space, three days, no season
VIEWS["spool_series"] = series_view(
    "host_id", "spool", "collected_at", "avg(free_bytes) / CAST(1073741824 AS DOUBLE)",
    "2024-01-28 00:00:00", 864, FIVE)
VIEWS["spool_fit"] = fitted_view("spool_series", "host_id", 1)
VIEWS["spool_forecast"] = """
SELECT host_id, CAST(863 + h.range AS INTEGER) AS idx, bin + h.range * INTERVAL 300 SECOND AS bin,
  intercept + slope * (863 + h.range) + seasonal AS forecast
FROM spool_fit, range(1, 25) h WHERE idx = 863"""
VIEWS["drift_series"] = series_view(
    "data_source", "execs", "end_ts", "quantile_disc(duration_ms, 0.95)", "2024-01-17 00:00:00", 336, HOUR)
VIEWS["drift_fit"] = fitted_view("drift_series", "data_source", 24)
VIEWS["drift_scored"] = scored_view("drift_fit", "data_source", 2.0)


for _name, _key in (("cpu_series", "node_id"), ("cpu5_series", "node_id"), ("spool_series", "host_id"), ("drift_series", "data_source")):
    VIEWS[f"{_name}_period"] = period_view(_name, _key)
VIEWS["cpu_auto"] = auto_fitted_view("cpu_series", "node_id")
VIEWS["cpu_auto_scored"] = scored_view("cpu_auto", "node_id", 1.5)
VIEWS["cpu5_auto"] = auto_fitted_view("cpu5_series", "node_id")
VIEWS["drift_auto"] = auto_fitted_view("drift_series", "data_source")
VIEWS["drift_auto_scored"] = scored_view("drift_auto", "data_source", 2.0)


def cpu_series(s, d):
    return T.make_series(B.counters(s, d), ["node_id"], "counter_ts", F.avg("system_cpu"),
                         ts(FIRST), B.as_of(), HOUR)


def cpu5_series(s, d):
    return T.make_series(B.counters(s, d), ["node_id"], "counter_ts", F.avg("system_cpu"),
                         ts("2024-01-24 00:00:00"), B.as_of(), FIVE)


def spool_series(s, d):
    return T.make_series(B.spool(s, d), ["host_id"], "collected_at", F.avg("free_bytes") / F.lit(1073741824.0),
                         ts("2024-01-28 00:00:00"), B.as_of(), FIVE)


def spool_forecast(s, d):
    return T.forecast(spool_series(s, d), ["host_id"], 1, 24, FIVE)


def rounded(df, **digits):
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in digits.items()})


add("make_series", lambda s, d: rounded(cpu_series(s, d), value=6),
    "SELECT node_id, idx, bin, round(value, 6) AS value FROM cpu_series")
add(
    "series_expand",
    lambda s, d: rounded(T.series_expand(
        T.series_pack(cpu_series(s, d), ["node_id"]), ["node_id"],
        {"bin": "timestamp", "value": "double"}), value=6),
    "SELECT node_id, bin, round(value, 6) AS value FROM cpu_series",
)
add(
    "series_trend",
    lambda s, d: rounded(T.series_trend(cpu_series(s, d), ["node_id"]), slope=6, intercept=4),
    """SELECT node_id, round(regr_slope(value, idx), 6) + 0 AS slope,
       round(regr_intercept(value, idx), 4) + 0 AS intercept, count(*) AS steps FROM cpu_series GROUP BY 1""",
)
add(
    "series_seasonal",
    lambda s, d: rounded(
        T.with_seasonal(cpu_series(s, d), ["node_id"], 24)
        .select("node_id", "slot", "seasonal").dropDuplicates(["node_id", "slot"]), seasonal=4),
    "SELECT node_id, slot, round(any_value(seasonal), 4) + 0 AS seasonal FROM cpu_fit GROUP BY 1, 2",
)
CANDIDATES = [12, 24, 48, 168]
add(
    "series_detect_period",
    lambda s, d: T.detect_period(cpu_series(s, d), ["node_id"], CANDIDATES),
    "WITH flat AS (SELECT node_id, idx, value - trend AS d FROM cpu_fit), lags AS (SELECT node_id, d, "
    + ", ".join(f"lag(d, {p}) OVER (PARTITION BY node_id ORDER BY idx) AS d{p}" for p in CANDIDATES)
    + " FROM flat), cors AS (" + " UNION ALL ".join(
        f"SELECT node_id, {p} AS period, round(corr(d, d{p}), 4) AS r FROM lags GROUP BY 1" for p in CANDIDATES)
    + """) SELECT node_id, period, r AS autocorrelation FROM (SELECT *,
       row_number() OVER (PARTITION BY node_id ORDER BY r DESC, period) AS rn FROM cors) WHERE rn = 1""",
)
add(
    "series_decompose_anomalies",
    lambda s, d: rounded(T.decompose_anomalies(cpu_series(s, d), ["node_id"], 24),
                         value=4, baseline=4, score=4),
    """SELECT node_id, idx, bin, round(value, 4) + 0 AS value, round(baseline, 4) + 0 AS baseline,
       round(score, 4) + 0 AS score, flag FROM cpu_scored""",
)
add(
    "anomaly_filter",
    lambda s, d: rounded(
        T.anomaly_filter(T.decompose_anomalies(cpu5_series(s, d), ["node_id"], 288))
        .select("node_id", "bin", "value", "baseline", "score"), value=4, baseline=4, score=4
    ).orderBy(F.col("score").desc(), "node_id", "bin"),
    """SELECT node_id, bin, round(value, 4) + 0 AS value, round(baseline, 4) + 0 AS baseline,
       round(score, 4) + 0 AS score FROM cpu5_scored WHERE flag <> 0 AND score > 2.5
       ORDER BY score DESC, node_id, bin""",
)
add(
    "order_by_score",
    lambda s, d: rounded(T.decompose_anomalies(cpu5_series(s, d), ["node_id"], 288)
                         .filter("flag != 0").select("node_id", "bin", "score"), score=4)
    .orderBy(F.col("score").desc(), "node_id", "bin"),
    """SELECT node_id, bin, round(score, 4) + 0 AS score FROM cpu5_scored WHERE flag <> 0
       ORDER BY round(score, 4) DESC, node_id, bin""",
)
add("series_forecast", lambda s, d: rounded(spool_forecast(s, d), forecast=4),
    "SELECT host_id, idx, bin, round(forecast, 4) + 0 AS forecast FROM spool_forecast")
add(
    "series_forecast_seasonal",
    lambda s, d: rounded(T.forecast(cpu_series(s, d), ["node_id"], 24, 48, HOUR), forecast=4),
    f"""SELECT node_id, CAST(idx + 24 * t.range AS INTEGER) AS idx,
       bin + 24 * t.range * INTERVAL 3600 SECOND AS bin,
       round(intercept + slope * (idx + 24 * t.range) + seasonal, 4) + 0 AS forecast
       FROM cpu_fit, range(1, 3) t WHERE idx >= 696""",
)
add(
    "forecast_floor_breach",
    lambda s, d: rounded(T.forecast_floor_breach(spool_forecast(s, d), ["host_id"]), min_forecast=4),
    """SELECT host_id, round(min(forecast), 4) + 0 AS min_forecast,
       min(bin) FILTER (WHERE forecast < 10) AS first_breach FROM spool_forecast
       GROUP BY 1 HAVING min(forecast) < 10""",
)


def drift_series(s, d):
    return T.make_series(execs(s, d), ["data_source"], "end_ts",
                         F.percentile_approx("duration_ms", F.lit(0.95), F.lit(10000)),
                         ts("2024-01-17 00:00:00"), B.as_of(), HOUR)


add(
    "percentile_drift",
    lambda s, d: rounded(
        T.decompose_anomalies(drift_series(s, d), ["data_source"], 24, 2.0)
        .filter("flag > 0").select("data_source", "bin", F.col("value").alias("p95"), "score"), score=4),
    """SELECT data_source, bin, value AS p95, round(score, 4) + 0 AS score
       FROM drift_scored WHERE flag > 0""",
)
add("date_dimension", lambda s, d: T.date_dimension(B.activities(s, d), "activity_ts"),
    """SELECT CAST(g.d AS DATE) AS date, CAST(year(g.d) AS INTEGER) AS year,
       CAST(month(g.d) AS INTEGER) AS month, strftime(g.d, '%Y-%m') AS year_month
       FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM
         (SELECT date_trunc('day', min(activity_ts)) AS a, date_trunc('day', max(activity_ts)) AS b FROM activities)) g""")


def _latency_series(s, d):
    net = B.network(s, d).withColumn("node_id", F.col("host_id"))
    return T.make_series(net, ["node_id"], "collected_at", F.avg("latency_ms"), ts(FIRST), B.as_of(), HOUR)


def _failure_series(s, d):
    return T.make_series(execs(s, d), ["node_id"], "end_ts", F.count_if(~F.col("success")),
                         ts(FIRST), B.as_of(), HOUR)


LAGS = [0, 1, 2, 3]
VIEWS["node_network"] = "SELECT *, host_id AS node_id FROM network"
VIEWS["lat_series"] = series_view("node_id", "node_network", "collected_at", "avg(latency_ms)", FIRST, 720, HOUR)
VIEWS["fail_series"] = series_view("node_id", "execs", "end_ts", "count(*) FILTER (WHERE NOT success)", FIRST, 720, HOUR)
add(
    "lagged_correlation",
    lambda s, d: T.lagged_correlation(_latency_series(s, d), _failure_series(s, d), ["node_id"], LAGS),
    "WITH both2 AS (SELECT l.node_id, l.idx, l.value AS c, f.value AS e FROM lat_series l JOIN fail_series f "
    "ON l.node_id = f.node_id AND l.idx = f.idx), lags AS (SELECT node_id, e, "
    + ", ".join(f"lag(c, {k}) OVER (PARTITION BY node_id ORDER BY idx) AS c{k}" for k in LAGS)
    + " FROM both2), cors AS (" + " UNION ALL ".join(
        f"SELECT node_id, {k} AS best_lag, round(corr(c{k}, e), 4) AS correlation FROM lags GROUP BY 1" for k in LAGS)
    + """) SELECT node_id, best_lag, correlation FROM (SELECT *, row_number() OVER (PARTITION BY node_id
       ORDER BY abs(correlation) DESC, best_lag) AS rn FROM cors) WHERE rn = 1""",
)


def _advice(s, d):
    load = T.make_series(execs(s, d), ["node_id"], "end_ts", F.sum("duration_ms") / 1000.0,
                         ts(FIRST), B.as_of(), HOUR)
    return rounded(
        T.scale_out_advisory(
            T.forecast(load, ["node_id"], 24, 24, HOUR),
            T.forecast(cpu_series(s, d), ["node_id"], 24, 24, HOUR), "node_id", 100.0),
        peak_load=3, peak_cpu=3)


VIEWS["load_series"] = series_view("node_id", "execs", "end_ts", "sum(duration_ms) / CAST(1000 AS DOUBLE)", FIRST, 720, HOUR)
VIEWS["load_fit"] = fitted_view("load_series", "node_id", 24)
add(
    "scale_out_advisory",
    _advice,
    """WITH a AS (SELECT node_id, max(intercept + slope * (idx + 24) + seasonal) AS p FROM load_fit
         WHERE idx >= 696 GROUP BY 1),
       b AS (SELECT node_id, max(intercept + slope * (idx + 24) + seasonal) AS p FROM cpu_fit
         WHERE idx >= 696 GROUP BY 1)
       SELECT a.node_id, round(a.p, 3) + 0 AS peak_load, round(b.p, 3) + 0 AS peak_cpu,
         a.p > 0.85 * 100 AND b.p > 80 AS advise FROM a JOIN b ON a.node_id = b.node_id""",
)
add(
    "trend_lines",
    lambda s, d: T.make_series(
        execs(s, d), ["node_id"], "end_ts",
        F.round(F.count_if(~F.col("success")) * 100.0 / F.count(F.lit(1)), 2), ts(FIRST), B.as_of(), 86400,
    ).select("node_id", F.to_date("bin").alias("day"), F.col("value").alias("error_rate_pct")),
    "SELECT node_id, CAST(bin AS DATE) AS day, value AS error_rate_pct FROM ("
    + series_view("node_id", "execs", "end_ts",
                  "round(count(*) FILTER (WHERE NOT success) * CAST(100 AS DOUBLE) / count(*), 2)",
                  FIRST, 30, 86400) + ")",
)

add("series_period_hourly", lambda s, d: T.find_period(cpu_series(s, d), ["node_id"]), "SELECT * FROM cpu_series_period")
add("series_period_5min", lambda s, d: T.find_period(cpu5_series(s, d), ["node_id"]), "SELECT * FROM cpu5_series_period")
add("series_period_spool", lambda s, d: T.find_period(spool_series(s, d), ["host_id"]), "SELECT * FROM spool_series_period")
add(
    "series_decompose_auto",
    lambda s, d: rounded(T.decompose_anomalies(cpu_series(s, d), ["node_id"], T.AUTO), value=4, baseline=4, score=4),
    """SELECT node_id, idx, bin, round(value, 4) + 0 AS value, round(baseline, 4) + 0 AS baseline,
       round(score, 4) + 0 AS score, flag FROM cpu_auto_scored""",
)
add(
    "series_forecast_auto",
    lambda s, d: rounded(T.forecast(cpu5_series(s, d), ["node_id"], T.AUTO, 48, FIVE), forecast=4),
    """SELECT node_id, CAST(idx + period * t.range AS INTEGER) AS idx,
       bin + period * t.range * INTERVAL 300 SECOND AS bin,
       round(intercept + slope * (idx + period * t.range) + seasonal, 4) + 0 AS forecast
       FROM cpu5_auto, range(1, 49) t WHERE idx >= 2016 - period AND idx + period * t.range < 2064""",
)
add(
    "percentile_drift_auto",
    lambda s, d: rounded(
        T.decompose_anomalies(drift_series(s, d), ["data_source"], T.AUTO, 2.0)
        .filter("flag <> 0").select("data_source", "bin", F.col("value").alias("p95"), "score", "flag"), score=4),
    """SELECT data_source, bin, value AS p95, round(score, 4) + 0 AS score, flag
       FROM drift_auto_scored WHERE flag <> 0""",
)

# ---- pattern mining ------------------------------------------------------------------
COLS = ["node_id", "data_source", "query_type", "error_message"]
SPLIT = "2024-01-24 00:00:00"


def _failed_recent(s, d):
    return J.between(execs(s, d), "end_ts", ts("2024-01-17 00:00:00"), B.as_of()).filter(~F.col("success"))


VIEWS["recent_failed"] = f"""
SELECT *, end_ts >= TIMESTAMP '{SPLIT}' AS spike FROM execs
WHERE NOT success AND end_ts BETWEEN TIMESTAMP '2024-01-17 00:00:00' AND {AS_OF_SQL}"""
GID = "grouping_id(node_id, data_source, query_type, error_message)"
PATTERN = "concat_ws(' & ', " + ", ".join(
    f"CASE WHEN gid & {1 << (3 - i)} = 0 THEN '{c}=' || coalesce(CAST({c} AS VARCHAR), '(null)') END"
    for i, c in enumerate(COLS)) + ")"
CUBE = "CUBE (node_id, data_source, query_type, error_message)"
SUBSUMES = " AND ".join(
    f"(p.gid & {1 << (3 - i)} <> 0 OR p.{c} IS NOT DISTINCT FROM c.{c})" for i, c in enumerate(COLS))
VIEWS["diff_supported"] = f"""
SELECT *, {PATTERN} AS pattern FROM (SELECT *, a / ta AS sa, b / tb AS sb FROM (
  SELECT {', '.join(COLS)}, CAST({GID} AS BIGINT) AS gid, count(*) FILTER (WHERE spike) AS a,
    count(*) FILTER (WHERE NOT spike) AS b,
    (SELECT CAST(count(*) FILTER (WHERE spike) AS DOUBLE) FROM recent_failed) AS ta,
    (SELECT CAST(count(*) FILTER (WHERE NOT spike) AS DOUBLE) FROM recent_failed) AS tb
  FROM recent_failed GROUP BY {CUBE})) WHERE sa >= 0.05 OR sb >= 0.05"""
add(
    "diff_patterns",
    lambda s, d: D.diff_patterns(_failed_recent(s, d), F.col("end_ts") >= ts(SPLIT), COLS),
    f"""SELECT pattern, CAST(4 - bit_count(gid) AS INTEGER) AS fixed_columns, a AS spike_count, b AS baseline_count,
       round(sa * 100, 2) AS spike_pct, round(sb * 100, 2) AS baseline_pct,
       round((sa - sb) * 100, 2) AS difference_pct
       FROM diff_supported c WHERE pattern <> '' AND NOT EXISTS (SELECT 1 FROM diff_supported p
         WHERE p.gid & c.gid = c.gid AND bit_count(p.gid) = bit_count(c.gid) + 1
           AND p.a = c.a AND p.b = c.b AND {SUBSUMES})""",
)
VIEWS["auto_supported"] = f"""
SELECT *, {PATTERN} AS pattern,
  round(pow(cov, 0.6) * pow((4 - bit_count(gid)) / CAST(4 AS DOUBLE), 0.4), 6) AS score FROM (
  SELECT {', '.join(COLS)}, CAST({GID} AS BIGINT) AS gid, count(*) AS n,
    count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM recent_failed) AS cov
  FROM recent_failed GROUP BY {CUBE}) WHERE cov >= 0.05 AND gid <> 15"""
add(
    "auto_cluster",
    lambda s, d: D.auto_cluster(_failed_recent(s, d), COLS),
    f"""SELECT c.pattern, CAST(4 - bit_count(c.gid) AS INTEGER) AS fixed_columns, c.n AS rows,
       round(c.cov * 100, 2) AS coverage_pct, c.score
       FROM auto_supported c WHERE NOT EXISTS (SELECT 1 FROM auto_supported p
           WHERE p.gid <> c.gid AND p.gid & c.gid = c.gid AND {SUBSUMES} AND p.score > c.score)
       AND NOT EXISTS (SELECT 1 FROM auto_supported q WHERE q.gid <> c.gid AND c.gid & q.gid = q.gid
           AND {SUBSUMES.replace('p.gid', 'c.gid').replace('p.', 'q.')} AND q.score >= c.score)""",
)
VIEWS["signals"] = """
SELECT f.*, n.rtt, u.cpu FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, end_ts) AS bin FROM execs WHERE NOT success) f
LEFT JOIN (SELECT host_id, time_bucket(INTERVAL 5 MINUTE, collected_at) AS bin, avg(latency_ms) AS rtt
  FROM network GROUP BY 1, 2) n ON f.node_id = n.host_id AND f.bin = n.bin
LEFT JOIN (SELECT node_id, time_bucket(INTERVAL 5 MINUTE, counter_ts) AS bin, avg(system_cpu) AS cpu
  FROM counters GROUP BY 1, 2) u ON f.node_id = u.node_id AND f.bin = u.bin"""
TERM = "(^|[^a-zA-Z0-9])({})([^a-zA-Z0-9]|$)"
CAUSE = f"""CASE WHEN rtt > 60 THEN 'network' WHEN cpu > 50 THEN 'gateway_cpu'
  WHEN regexp_matches(error_message, '{TERM.format("spool")}', 'i') THEN 'gateway_spool'
  WHEN regexp_matches(error_message, '{TERM.format("timeout|login|credential")}', 'i') THEN 'source_or_cred'
  ELSE 'unclassified' END"""


def _signals(s, d):
    return J.multi_signal_join(execs(s, d).filter(~F.col("success")), B.network(s, d), B.counters(s, d))


def _classified(s, d):
    return _signals(s, d).withColumn(
        "root_cause",
        causal_class(F.col("avg_latency_ms"), F.col("avg_cpu_pct"), F.col("error_message"), 60.0, 50.0))


add(
    "multi_signal_bin_join",
    lambda s, d: rounded(_signals(s, d).select(
        "request_id", "tracking_id", "node_id", "bin", "avg_latency_ms", "avg_cpu_pct"),
        avg_latency_ms=4, avg_cpu_pct=4),
    """SELECT request_id, tracking_id, node_id, bin, round(rtt, 4) AS avg_latency_ms,
       round(cpu, 4) AS avg_cpu_pct FROM signals""",
)
add("causal_bucket", lambda s, d: _classified(s, d).select("request_id", "tracking_id", "root_cause"),
    f"SELECT request_id, tracking_id, {CAUSE} AS root_cause FROM signals")
add(
    "root_cause_counts",
    lambda s, d: _classified(s, d).groupBy("root_cause").agg(F.count(F.lit(1)).alias("failures")),
    f"SELECT {CAUSE} AS root_cause, count(*) AS failures FROM signals GROUP BY 1",
)
add(
    "error_class_regex",
    lambda s, d: execs(s, d).filter(~F.col("success"))
    .groupBy(error_class(F.col("error_message")).alias("error_class")).agg(F.count(F.lit(1)).alias("failures")),
    """SELECT CASE WHEN contains(error_message, 'Spool') THEN 'gateway_spool'
       WHEN regexp_matches(error_message, 'timeout|path|network', 'i') THEN 'network'
       WHEN regexp_matches(error_message, 'login|credential|account', 'i') THEN 'source_or_cred'
       WHEN regexp_matches(error_message, 'cancel', 'i') THEN 'user_cancel' ELSE 'unclassified' END AS error_class,
       count(*) AS failures FROM execs WHERE NOT success GROUP BY 1""",
)
NORMAL = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper({0}),
  '''[^'']*''', '?', 'g'), '"[^"]*"', '?', 'g'), '[0-9]+(\\.[0-9]+)?', '?', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"""
# the statement text of an execution, with literals in it
VIEWS["statements"] = """
SELECT *, 'select * from src' || data_source || ' where  id = ' || request_id || ' and t = ''' ||
  query_type || ''' limit ' || (duration_ms % 3) || '.5' AS statement FROM execs"""


def _statements(s, d):
    return execs(s, d).withColumn(
        "statement",
        F.concat(F.lit("select * from src"), F.col("data_source").cast("string"), F.lit(" where  id = "),
                 F.col("request_id").cast("string"), F.lit(" and t = '"), F.col("query_type"),
                 F.lit("' limit "), (F.col("duration_ms") % 3).cast("string"), F.lit(".5")))


def _text_rollup(s, d):
    from pulsegrid.functions.text import fingerprint, normalize_statement

    return _statements(s, d).groupBy(
        fingerprint(F.col("statement")).alias("fingerprint"),
        normalize_statement(F.col("statement")).alias("shape"),
    ).agg(F.count(F.lit(1)).alias("queries"))


add("text_normalize_fingerprint", _text_rollup,
    f"""SELECT sha256({NORMAL.format('statement')}) AS fingerprint, {NORMAL.format('statement')} AS shape,
        count(*) AS queries FROM statements GROUP BY 1, 2""")
add("error_signature_clusters",
    lambda s, d: D.signature_clusters(execs(s, d), "error_message"),
    f"""SELECT sha256({NORMAL.format('error_message')}) AS signature_id, {NORMAL.format('error_message')} AS signature,
        count(*) AS failures, min(error_message) AS example FROM execs WHERE error_message IS NOT NULL GROUP BY 1, 2""")
