"""Time joins against brute force, with one key holding most of the rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.quantiles import exact_quantile
from pulsegrid.operators.stability import consecutive_bad, gaps, rolling_stats, state_transitions
from pulsegrid.operators.timejoin import nearest_match, window_match_counts
from pulsegrid.operators.timeline import per_second, state_runs, with_previous

BASE = 1_700_000_000


def rows(n, seed, span, keys):
    rng = random.Random(seed)
    key = lambda: 0 if rng.random() < 0.5 else rng.choice(keys)
    return [(i, None if rng.random() < 0.03 else key(), None if rng.random() < 0.03 else BASE + rng.randrange(span))
            for i in range(n)]


def frame(spark, data, prefix):
    df = spark.createDataFrame(data, f"{prefix}id int, {prefix}key int, s bigint")
    return df.withColumn(f"{prefix}t", F.timestamp_seconds("s")).drop("s")


def brute(left, right, back, ahead):
    best, count = {}, {}
    for lid, lk, ls in left:
        hits = [(abs(ls - rs), rs, rid) for rid, rk, rs in right
                if None not in (lk, ls, rk, rs) and rk == lk and -ahead <= ls - rs <= back]
        best[lid] = min(hits)[::2] if hits else (None, None)
        count[lid] = len(hits)
    return best, count


@pytest.mark.parametrize("span,back,ahead", [(5_000, 30, 30), (50_000, 300, 300), (40_000, 600, 0), (400, 5, 90)])
def test_nearest_match_equals_brute_force(spark, span, back, ahead):
    left, right = rows(400, 1, span, range(5)), rows(300, 2, span, range(5))
    args = (frame(spark, left, "l"), frame(spark, right, "r"), "lt", "rt", back)
    got = nearest_match(*args, on=[("lkey", "rkey")], payload=["rid"], tie=["rid"], forward_s=ahead).collect()
    best, count = brute(left, right, back, ahead)
    assert len(got) == len(left)
    assert {r.lid: (r.gap_s, r.rid) for r in got} == best
    counted = window_match_counts(*args, on=[("lkey", "rkey")], forward_s=ahead).collect()
    assert {r.lid: r.matches for r in counted} == count


def test_nearest_match_without_a_key_keeps_every_left_row(spark):
    left = spark.createDataFrame([(1, 1000), (2, 5000), (3, None)], "lid int, s bigint").withColumn("lt", F.timestamp_seconds("s"))
    right = spark.createDataFrame([(7, 995), (8, 1002), (9, 1200)], "rid int, s bigint").select("rid", F.timestamp_seconds("s").alias("rt"))
    got = nearest_match(left, right, "lt", "rt", 30, payload=["rid"], tie=["rid"])
    assert {r.lid: (r.rid, r.gap_s) for r in got.collect()} == {1: (8, 2), 2: (None, None), 3: (None, None)}


def test_a_tie_goes_to_the_earlier_right_row(spark):
    left = spark.createDataFrame([(1, 100)], "lid int, s bigint").select("lid", F.timestamp_seconds("s").alias("lt"))
    right = spark.createDataFrame([(1, 110), (2, 90), (3, 90)], "rid int, s bigint").select("rid", F.timestamp_seconds("s").alias("rt"))
    assert nearest_match(left, right, "lt", "rt", 30, payload=["rid"], tie=["rid"]).first().rid == 2


def test_runs_and_previous_rows_across_chunks(spark):
    rng = random.Random(5)
    data = sorted({(rng.choice([0, 0, 0, 1]), BASE + rng.randrange(3_000)) for _ in range(500)})
    states = [(k, s, rng.random() < 0.5) for k, s in data]
    df = spark.createDataFrame(states, "k int, sec bigint, bad boolean")
    expected, previous = [], {}
    for key in (0, 1):
        mine = [(s, b) for k, s, b in states if k == key]
        for i, (s, b) in enumerate(mine):
            previous[key, s] = mine[i - 1] if i else (None, None)
            if i and mine[i - 1][1] == b:
                expected[-1][3], expected[-1][4] = s, expected[-1][4] + 1
            else:
                expected.append([key, b, s, s, 1])
    for chunk in (50, 400, 86400):
        got = state_runs(df, ["k"], "bad", chunk).select(
            "k", "bad", F.unix_timestamp("run_start"), F.unix_timestamp("run_end"), "polls").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
        prev = with_previous(df, ["k"], ["bad"], chunk).collect()
        assert {(r.k, r.sec): (r.prev_sec, r.prev_bad) for r in prev} == previous


def test_one_row_per_second_is_the_latest(spark):
    df = spark.createDataFrame([(1, 10.2, 1, "a"), (1, 10.9, 2, "b"), (1, 10.9, 1, "c"), (1, 11.0, 1, "d"), (None, 1.0, 1, "e")],
                               "k int, t double, tie int, v string").withColumn("t", F.col("t").cast("timestamp"))
    assert {(r.sec, r.v) for r in per_second(df, ["k"], "t", ["tie"], ["v"]).collect()} == {(10, "b"), (11, "d")}


def test_rolling_stats_and_gaps(spark):
    data = [(1, BASE + i * 100, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(data, "k int, s bigint, v double").withColumn("t", F.timestamp_seconds("s"))
    got = {int(r.at.timestamp()): r for r in rolling_stats(df, "k", "t", "v", 900).collect()}
    for i, (_, s, _) in enumerate(data):
        window = pd.Series([v for _, x, v in data if s - 900 <= x <= s])
        at = got[min(got, key=lambda a: abs(a - s))]
        assert at.samples == len(window) and at["mean"] == pytest.approx(window.mean(), abs=1e-3)
    assert {r.gap_s for r in gaps(df, ["k"], "t").collect()} == {None, 100}


@pytest.mark.parametrize("n", [1, 2, 3, 50, 30_000])
def test_exact_quantile_in_small_and_large_groups(spark, n):
    rng = random.Random(n)
    values = [float(rng.randrange(10 if n == 50 else 10**6)) for _ in range(n)]
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "v": values}))
    for q in (0.0, 0.5, 0.95, 1.0):
        got = exact_quantile(df, ["k"], "v", q, slack=0.0 if n == 30_000 else 3e-4).collect()
        assert len(got) == 1 and got[0].quantile == pytest.approx(pd.Series(values).quantile(q))


def test_polls_of_one_second_all_count(spark):
    data = [(1, 10.0 + i / 10, i, b) for i, b in enumerate([True, True, True, True, False, True])]
    polls = spark.createDataFrame(data, "k int, t double, tie int, bad boolean").withColumn("t", F.col("t").cast("timestamp"))
    runs = consecutive_bad(polls, ["k"], "t", ["tie"], "bad", 3).collect()
    assert [r.polls for r in runs] == [4] and runs[0].run_start == runs[0].fired_at
    assert state_transitions(polls, ["k"], "t", ["tie"], "bad").count() == 2


def test_nth_poll_of_a_run_over_chunks(spark):
    df = spark.createDataFrame([(1, 10 * i, i, i != 5) for i in range(40)], "k int, sec bigint, ord int, bad boolean")
    for chunk in (15, 60, 86400):
        got = state_runs(df, ["k"], "bad", chunk, "ord", 7).filter("bad").orderBy("run_start").select(
            F.unix_timestamp("nth_at").alias("n"), "polls", "ord").collect()
        assert [tuple(r) for r in got] == [(None, 5, 0), (120, 34, 6)]


def test_rolling_deviation_of_large_values(spark):
    data = [(1, BASE + i * 60, 1e9 + i % 2) for i in range(40)] + [(2, BASE + i * 60, 5.0) for i in range(3)]
    df = spark.createDataFrame(data, "k int, s bigint, v double").withColumn("t", F.timestamp_seconds("s"))
    for r in rolling_stats(df, "k", "t", "v", 900).collect():
        window = pd.Series([v for k, x, v in data if k == r.k and r.at.timestamp() - 900 <= x <= r.at.timestamp()])
        if len(window) > 1:
            assert r.deviation == pytest.approx(window.std(), abs=1e-3)
        assert r["mean"] == pytest.approx(window.mean(), abs=1e-3)


T0 = 1_700_000_000


def test_rolling_deviation_beside_a_huge_value(spark):
    """A reading of 1e12, then values near 1,000: no digit of the deviation is lost."""
    import math

    rows = [("k", T0, 1e12)] + [("k", T0 + 1000 + 10 * i, 1000.0 + 200 * (i % 2)) for i in range(300)] + [("k", T0 + 1500, 1000.5)]
    rows += [("m", T0 + i, 1e9 + i % 3) for i in range(0, 3000, 7)]
    df = spark.createDataFrame(rows, "k string, s long, v double").withColumn("t", F.timestamp_seconds("s"))
    got = {(r.k, int(r["at"].timestamp())): r for r in rolling_stats(df, "k", "t", "v", 900).collect()}
    for k, s, _ in rows:
        own = [v for a, b, v in rows if a == k and s - 900 <= b <= s]
        mean = math.fsum(own) / len(own)
        want = math.sqrt(math.fsum((v - mean) ** 2 for v in own) / (len(own) - 1)) if len(own) > 1 else None
        r = got[k, s]
        assert r.samples == len(own) and abs(r["mean"] - mean) <= 0.0011 + 1e-9 * abs(mean)
        assert (r.deviation is None) == (want is None) and (want is None or abs(r.deviation - want) <= 0.0006 + 1e-9 * want)
    assert len(got) == len({(k, s) for k, s, _ in rows})


def test_patterns_keep_null_and_its_text_apart(spark):
    from pulsegrid.operators.patterns import auto_cluster, diff_patterns

    rows = [(None, "x", True)] * 50 + [("(null)", "x", False)] * 50
    df = spark.createDataFrame(rows, "c string, d string, spike boolean")
    got = [tuple(r) for r in diff_patterns(df, F.col("spike"), ["c", "d"]).collect()]
    assert sorted(got) == [("c=(null)", 1, 0, 50, 0.0, 100.0, -100.0), ("c=(null)", 1, 50, 0, 100.0, 0.0, 100.0)]
    plan = diff_patterns(df, F.col("spike"), ["c", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 3
    assert [r["rows"] for r in auto_cluster(df, ["c"]).collect()] == [50, 50]
    assert diff_patterns(df.filter("false"), F.col("spike"), ["c"]).count() == 0


def test_exact_quantile_of_one_key_in_rounds(spark, monkeypatch):
    from pulsegrid.operators import quantiles

    rng = random.Random(17)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(9) for _ in range(6000)] + [5.0] * 3000
    rows = [("one", v) for v in values] + [(None, float(i)) for i in range(900)] + [("few", 1.0), ("few", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    monkeypatch.setattr(quantiles, "PARTS", 8)
    for q in (0.0, 0.37, 0.95, 1.0):
        # a bracket that holds nearly all values, and at most 20 of them put in order
        got = {r.k: r.quantile for r in exact_quantile(df, ["k"], "v", q, slack=0.45, held=20).collect()}
        for k in ("one", None, "few"):
            own = pd.Series([v for a, v in rows if a == k])
            assert abs(got[k] - own.quantile(q)) <= 1e-9 * max(1.0, abs(own.quantile(q)))
        assert set(got) == {"one", None, "few"}
    plan = exact_quantile(df, ["k"], "v", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
