"""Alert state kept per entity across micro-batches.

Rows reach the state code as one row per (entity, second), once the watermark has
closed the second: a count of fires, or the polls of the second in their order.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != PROVIDER:
        spark.conf.set(key, PROVIDER)


def _ordered(chunks, columns: list[str]) -> pd.DataFrame:
    parts = [c[columns] for c in chunks]
    return pd.concat(parts).sort_values("sec", kind="stable") if parts else pd.DataFrame(columns=columns)


class ConsecutiveBad(StatefulProcessor):
    """Counts bad polls in a row; one row when the count reaches the limit.

    A source whose last poll was good has nothing to remember once the watermark has passed
    that poll, and leaves the store.
    """

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "last_sec bigint, bad_run int, run_start bigint")

    def handleInputRows(self, key, rows, timerValues):
        known = self.state.get()
        last, run, start = known if known is not None else (-1, 0, -1)
        fired = []
        for sec, polls in _ordered(rows, ["sec", "bad"]).itertuples(index=False):
            if sec <= last:
                continue  # behind the second already judged
            for bad in polls:
                start = start if bad and run > 0 else sec
                run = run + 1 if bad else 0
                if run == self.limit:
                    fired.append((key[0], int(start), int(sec), run))
            last = sec
        self.state.update((int(last), int(run), int(start)))
        if run == 0:
            self.handle.registerTimer((int(last) + 1) * 1000)
        yield pd.DataFrame(fired, columns=["datasource_id", "run_start_s", "fired_at_s", "polls"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = self.state.get()
        if known is not None and known[1] == 0 and (known[0] + 1) * 1000 <= timerValues.getCurrentWatermarkInMs():
            self.state.clear()
        yield pd.DataFrame(columns=["datasource_id", "run_start_s", "fired_at_s", "polls"])

    def close(self) -> None:
        pass


class CircuitBreaker(StatefulProcessor):
    """Trailing count of fires per host; more than the limit is suppressed.

    When the watermark has passed the last fire and its window, no later fire can count it any
    more: a timer takes the host out of the store.
    """

    def __init__(self, limit: int, window_s: int):
        self.limit, self.window_s = limit, window_s

    def init(self, handle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "sec bigint, n bigint")

    def handleInputRows(self, key, rows, timerValues):
        recent = deque((int(s), int(n)) for s, n in self.recent.get())
        total, out = sum(n for _, n in recent), []
        for sec, n in _ordered(rows, ["sec", "n"]).itertuples(index=False):
            while recent and recent[0][0] < sec - self.window_s:
                total -= recent.popleft()[1]
            recent.append((int(sec), int(n)))
            total += int(n)
            out.append((key[0], int(sec), int(n), total, total > self.limit))
        self.recent.put(list(recent))
        if recent:
            self.handle.registerTimer((recent[-1][0] + self.window_s + 1) * 1000)
        yield pd.DataFrame(out, columns=["host_id", "sec", "fires", "fires_in_window", "suppressed"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        left = [(int(s), int(n)) for s, n in self.recent.get() if (int(s) + self.window_s + 1) * 1000 > passed]
        self.recent.put(left) if left else self.recent.clear()
        yield pd.DataFrame(columns=["host_id", "sec", "fires", "fires_in_window", "suppressed"])

    def close(self) -> None:
        pass


class Outages(StatefulProcessor):
    """Runs of heartbeats that the watermark has not closed, with timers at their begin and end."""

    COLUMNS = ["node_id", "state", "at_us", "heartbeats", "last_us"]

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle) -> None:
        self.handle = handle
        self.runs = handle.getListState("runs", "first bigint, last bigint, n bigint, announced boolean")

    def handleInputRows(self, key, rows, timerValues):
        runs = [[int(a), int(b), int(n), bool(x)] for a, b, n, x in self.runs.get()]
        for chunk in rows:
            runs += [[int(us), int(us), 1, False] for us in chunk["us"]]
        merged: list[list] = []
        for run in sorted(runs):
            last = merged[-1] if merged else None
            if last and run[0] < last[1] + self.gap_us:
                last[1], last[2], last[3] = max(last[1], run[1]), last[2] + run[2], last[3] or run[3]
            else:
                merged.append(run)
        self.runs.put([tuple(r) for r in merged])
        for first, last, _, announced in merged:
            for at in ([] if announced else [first]) + [last + self.gap_us]:
                self.handle.registerTimer(-(-at // 1000))
        yield pd.DataFrame(columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        out, left = [], []
        for first, last, n, announced in ([*r] for r in self.runs.get()):
            if not announced and first <= passed:
                out.append((key[0], "LIVE", first, None, None))
                announced = True
            if last + self.gap_us <= passed:
                out.append((key[0], "OFFLINE", last + self.gap_us, n, last))
            else:
                left.append((first, last, n, announced))
        self.runs.put(left) if left else self.runs.clear()
        yield pd.DataFrame(out, columns=self.COLUMNS).astype({"heartbeats": "Int64", "last_us": "Int64"})

    def close(self) -> None:
        pass


def per_second_stream(df: DataFrame, key: str, time: str, delay: str, **aggs) -> DataFrame:
    """Append-mode aggregate to one row per (key, second); ``at`` keeps the watermark for timers."""
    return (
        df.withWatermark(time, delay)
        .groupBy(key, F.window(time, "1 second").alias("w"))
        .agg(*[a.alias(n) for n, a in aggs.items()])
        .select(key, F.unix_timestamp("w.start").alias("sec"), *aggs, F.window_time("w").alias("at"))
    )


def consecutive_bad(polls: DataFrame, limit: int = 3, delay: str = "10 minutes") -> DataFrame:
    """``polls``: datasource_id, collected_at, record_id, bad. Every poll counts, in the order of time and id."""
    use_rocksdb(polls.sparkSession)
    in_order = F.sort_array(F.collect_list(F.struct("collected_at", "record_id", F.coalesce("bad", F.lit(False)).alias("bad"))))
    seconds = per_second_stream(polls, "datasource_id", "collected_at", delay, bad=in_order["bad"])
    return seconds.groupBy("datasource_id").transformWithStateInPandas(
        ConsecutiveBad(limit),
        "datasource_id bigint, run_start_s bigint, fired_at_s bigint, polls int",
        "Append",
        "EventTime",
    )


def circuit_breaker(fires: DataFrame, limit: int = 3, window_s: int = 1800, delay: str = "10 minutes") -> DataFrame:
    """``fires``: host_id, fired_at."""
    use_rocksdb(fires.sparkSession)
    seconds = per_second_stream(fires, "host_id", "fired_at", delay, n=F.count(F.lit(1)))
    return seconds.groupBy("host_id").transformWithStateInPandas(
        CircuitBreaker(limit, window_s),
        "host_id bigint, sec bigint, fires bigint, fires_in_window bigint, suppressed boolean",
        "Append",
        "EventTime",
    )
