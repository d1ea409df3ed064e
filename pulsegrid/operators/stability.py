"""Outages, transitions and repeated fires on the time line of a node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions.scalars import epoch
from pulsegrid.operators.lookup import lookup_join
from pulsegrid.operators.timeline import DENSE, state_runs, sums_within, timed, with_previous

#: Service control events that mean a crash, a crash with a
#: recovery action, and a state change.
SERVICE_EVENTS = (7031, 7034, 7036)


def consecutive_bad(polls: DataFrame, keys: list[str], time: str, tie: list[str], bad: str, n: int) -> DataFrame:
    """Runs of at least ``n`` polls in a row with a true ``bad`` column; ``fired_at`` is the n-th poll."""
    runs = state_runs(timed(polls, keys, time, tie, [bad]), keys, bad, DENSE, "ord", n)
    return runs.filter(F.col(bad) & (F.col("polls") >= n)).drop(bad, "ord").withColumnRenamed("nth_at", "fired_at")


def state_transitions(polls: DataFrame, keys: list[str], time: str, tie: list[str], condition: str) -> DataFrame:
    """Times at which the condition turns true, also at the first poll of a key."""
    seen = with_previous(timed(polls, keys, time, tie, [condition]), keys, [condition], DENSE, "ord")
    turned = F.col(condition) & ~F.coalesce(F.col(f"prev_{condition}"), F.lit(False))
    return seen.filter(turned).select(*keys, F.timestamp_seconds("sec").alias("fired_at"))


def fires_in_window(fires: DataFrame, key: str, time: str, window_s: int) -> DataFrame:
    """Per (key, second): fires in that second and in the trailing window."""
    per_sec = fires.groupBy(key, epoch(F.col(time)).alias("sec")).agg(F.count(F.lit(1)).alias("n")).dropna()
    return (
        sums_within(per_sec, per_sec, [key], ["n"], window_s, 0)
        .join(per_sec.withColumnRenamed("n", "fires"), [key, "sec"])
        .select(key, "sec", "fires", F.col("n").alias("fires_in_window"))
    )


def circuit_breaker(fires: DataFrame, key: str, time: str, cfg: Settings = DEFAULTS) -> DataFrame:
    """Every fire with its trailing count; too many fires suppress and escalate."""
    counted = fires_in_window(fires, key, time, cfg.breaker_window_s).drop("fires")
    timed = fires.withColumn("_sec", epoch(F.col(time)))
    joined = lookup_join(timed, counted, [(key, key), ("_sec", "sec")]).drop("_sec")
    over = F.coalesce(F.col("fires_in_window") > cfg.breaker_fires, F.lit(False))
    return joined.withColumns({"suppressed": over, "escalate": over})


def gaps(heartbeats: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Each heartbeat second with the seconds since the one before."""
    beats = heartbeats.select(*keys, epoch(F.col(time)).alias("sec")).dropna().distinct()
    return with_previous(beats, keys, []).withColumn("gap_s", F.col("sec") - F.col("prev_sec"))


def longest_outage(heartbeats: DataFrame, keys: list[str], time: str) -> DataFrame:
    longest = F.max(F.struct("gap_s", (-F.col("sec")).alias("neg")))
    return (
        gaps(heartbeats, keys, time)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("heartbeats"), F.max("gap_s").alias("longest_gap_s"), longest.alias("m"))
        .select(*keys, "heartbeats", "longest_gap_s",
                F.when(F.col("longest_gap_s").isNotNull(), F.timestamp_seconds(-F.col("m.neg"))).alias("ended_at"))
    )


def service_stability(os_events: DataFrame) -> DataFrame:
    """Service crashes per host and day with the mean time between them."""
    crashes = os_events.filter(F.col("os_event_id").isin(*SERVICE_EVENTS))
    per_sec = crashes.groupBy("host_id", epoch(F.col("evt_time")).alias("sec")).agg(
        F.count(F.lit(1)).alias("events")
    )
    timed = with_previous(per_sec, ["host_id"], []).withColumn("gap_s", F.col("sec") - F.col("prev_sec"))
    return timed.groupBy("host_id", F.to_date(F.timestamp_seconds("sec")).alias("day")).agg(
        F.sum("events").alias("service_events"),
        F.round(F.avg("gap_s"), 2).alias("mean_gap_s"),
        F.min("gap_s").alias("min_gap_s"),
    )


def _summary(value: str, over: Window) -> Column:
    """(n, mean, m2) of the values in a window frame; m2 is the sum of squared distances to the mean."""
    n = F.count(value).over(over)
    return F.struct(n.alias("n"), F.avg(value).over(over).alias("mean"), (F.var_pop(value).over(over) * n).alias("m2"))


def _merged(a: Column, b: Column) -> Column:
    """The summary of two disjoint sets from theirs; ``b`` may be null."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"), (a["mean"] + apart * (b["n"] / n)).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n))).alias("m2"),
    )
    return F.when(b.isNull(), a).otherwise(both)


def rolling_stats(df: DataFrame, key: str, time: str, value: str, window_s: int = 900) -> DataFrame:
    """Per (key, second): count, mean and deviation over the trailing window.

    Nothing is ever taken off, so a huge value leaves no trace once it is out of the window.
    Time is cut into blocks as long as the window. A window is then the end of one block
    and the start of the next: summaries (count, mean, squared distances) of all starts and
    all ends of a block grow by one row at a time, and two of them are merged.
    A sort holds one block of a key.
    """
    v = F.col(value).cast("double")
    block = F.floor(F.col("sec") / F.lit(window_s + 1))
    known = (
        df.filter(v.isNotNull() & ~F.isnan(v)).select(key, epoch(F.col(time)).alias("sec"), v.alias("v")).dropna()
        .withColumn("block", block)
    )
    whole = Window.partitionBy(key, "block")
    grown = lambda order: whole.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        known.withColumns({"start": _summary("v", grown(F.col("sec"))), "end": _summary("v", grown(F.col("sec").desc()))})
        .dropDuplicates([key, "block", "sec"]).select(key, "block", "sec", "start", "end")
    )
    # each second asks the block before for the end that begins at the first second inside its window
    asks = ends.select(key, (F.col("block") - 1).alias("block"), (F.col("sec") - window_s).alias("at"), F.lit(0).alias("holds"),
                       "sec", "start", F.lit(None).cast(ends.schema["end"].dataType).alias("end"))
    holds = ends.select(key, "block", F.col("sec").alias("at"), F.lit(1).alias("holds"),
                        F.lit(None).cast("long").alias("sec"), F.lit(None).cast(ends.schema["start"].dataType).alias("start"), "end")
    behind = whole.orderBy(F.desc("at"), F.desc("holds")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        asks.unionByName(holds).withColumn("before", F.last("end", ignorenulls=True).over(behind)).filter("holds = 0")
        .select(key, "sec", _merged(F.col("start"), F.col("before")).alias("w"))
    )
    deviation = F.sqrt(F.greatest(F.col("w.m2"), F.lit(0.0)) / (F.col("w.n") - 1))
    return found.select(
        key,
        F.timestamp_seconds("sec").alias("at"),
        F.col("w.n").alias("samples"),
        F.round("w.mean", 3).alias("mean"),
        F.round(F.when(F.col("w.n") > 1, deviation), 3).alias("deviation"),
    )


def counter_delta_rate(samples: DataFrame, cores: int = 4) -> DataFrame:
    """CPU percent per process from each two cumulative readings in a row, never negative.

    Two readings of the same instant have no rate; the later pair starts at the higher one.
    """
    keys = ["host_id", "process_id"]
    readings = timed(samples, keys, "collected_at", ["cpu_seconds"], ["cpu_seconds", "collected_at"])
    pairs = with_previous(readings, keys, ["cpu_seconds", "collected_at"], DENSE, "ord")
    used = F.greatest(F.lit(0.0), F.col("cpu_seconds") - F.col("prev_cpu_seconds"))
    micros = F.unix_micros("collected_at") - F.unix_micros("prev_collected_at")
    return pairs.filter(micros > 0).select(
        *keys,
        F.col("collected_at").alias("at"),
        F.round(used / (micros / F.lit(1e6)) / F.lit(cores) * 100.0, 4).alias("cpu_pct"),
    )
