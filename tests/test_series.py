"""Periods found without being given."""

import math
import random

from pyspark.sql import functions as F

from pulsegrid.operators import series as T


def table(spark):
    rnd = random.Random(7)
    wave = lambda p, n, noise, trend=0.0: [
        math.sin(2 * math.pi * i / p) + 0.4 * math.sin(6 * math.pi * i / p) + trend * i + rnd.gauss(0, noise) for i in range(n)]
    made = {
        "day": wave(24, 720, 0.4), "trend": wave(24, 720, 0.4, 0.05), "five": wave(288, 2016, 0.1), "odd": wave(37, 500, 0.1),
        "noise": [rnd.gauss(0, 1) for _ in range(720)], "flat": [5.0] * 100, "line": [2.0 * i for i in range(100)], "short": [1.0, 2.0, 1.0],
    }
    rows = [(k, i, v) for k, vs in made.items() for i, v in enumerate(vs)] + [(None, i, float(i % 12)) for i in range(120)]
    return spark.createDataFrame(rows, "k string, idx int, value double").withColumn("bin", F.timestamp_seconds(F.col("idx") * 300))


def slow(values):
    n = len(values)
    mx, my = (n - 1) / 2, sum(values) / n
    slope = sum((i - mx) * (v - my) for i, v in enumerate(values)) / sum((i - mx) ** 2 for i in range(n))
    d = [v - my - slope * (i - mx) for i, v in enumerate(values)]
    squares = sum(x * x for x in d)
    if squares <= 1e-9:
        return 1, None
    r = {p: round(sum(d[i] * d[i - p] for i in range(p, n)) / squares, 6) for p in range(1, n // 2 + 1)}
    dip = next((p for p in r if r[p] <= 0), None)
    peaks = [(x, -p) for p, x in r.items() if dip and p > dip and p + 1 in r and x >= r[p - 1] and x > r[p + 1] and x > 2 / math.sqrt(n)]
    return (-max(peaks)[1], max(peaks)[0]) if peaks else (1, None)


def test_periods_are_found(spark):
    df = table(spark)
    got = {r.k: r.period for r in T.find_period(df, ["k"]).collect()}
    want = {}
    for k in got:
        values = [r.value for r in df.filter(F.col("k").eqNullSafe(k)).orderBy("idx").collect()]
        want[k] = slow(values)[0] if len(values) >= 4 else 1
    assert got == want
    assert (got["day"], got["trend"], got["five"], got["odd"], got[None]) == (24, 24, 288, 37, 12)
    assert got["flat"] == got["line"] == got["short"] == 1


def test_decomposition_and_forecast_find_the_period(spark):
    df = table(spark).filter("k = 'day'")
    near = lambda rows, cols: [[round(x, 9) if isinstance(x, float) else x for x in r] for r in rows.orderBy("idx").select(cols).collect()]
    auto, given = (near(T.decompose_anomalies(df, ["k"], p), ["idx", "bin", "baseline", "score", "flag"]) for p in (T.AUTO, 24))
    assert auto == given
    auto, given = (near(T.forecast(df, ["k"], p, 50, 300), ["idx", "bin", "forecast"]) for p in (T.AUTO, 24))
    assert auto == given and len(auto) == 50
    flat = T.forecast(table(spark).filter("k = 'line'"), ["k"], T.AUTO, 3, 300).orderBy("idx").collect()
    assert [round(r.forecast, 6) for r in flat] == [200.0, 202.0, 204.0]
