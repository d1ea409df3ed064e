"""Joins on closeness in time. The output never has more rows than the left side.

A pair matches when ``abs(gap) <= window`` in whole seconds. Only the nearest
right row of a left row is wanted, so pairs are not built: both sides are folded
to one row per (key, second), each left second looks up the right second before
and after it inside one bounded chunk, and the answer is joined back by equality
on (key, second). Equality joins are what adaptive execution can split when one
key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.functions.scalars import epoch
from pulsegrid.operators.timeline import distinct_seconds, sums_within


def _right_per_second(
    right: DataFrame, keys: list[tuple[str, str]], time: str, tie: list[str], payload: list[str]
) -> DataFrame:
    known = right.filter(F.col(time).isNotNull())
    for _, name in keys:
        known = known.filter(F.col(name).isNotNull())
    # a payload column that breaks ties already is carried once
    rest = [F.col(c).alias(c) for c in payload if c not in tie]
    best = F.min(
        F.struct(
            F.col(time).alias("t"),
            *[F.col(c).alias(f"tie{i}") for i, c in enumerate(tie)],
            *([F.struct(*rest).alias("row")] if rest else []),
        )
    )
    # the second first: sorted for the aggregate, most rows differ in it, a word of text in few
    return known.groupBy(
        epoch(F.col(time)).alias("sec"),
        *[F.col(name).alias(f"k{i}") for i, (_, name) in enumerate(keys)],
    ).agg(best.alias("best"))


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    window_s: int,
    on: list[tuple[str, str]] = (),
    payload: list[str] = (),
    tie: list[str] = (),
    gap_col: str = "gap_s",
    forward_s: int | None = None,
    chunk_s: int = 3600,
) -> DataFrame:
    """Left rows plus the payload of the nearest right row, nulls when none.

    ``window_s`` reaches back and forth; ``forward_s`` sets another reach for
    right rows later than the left row. Ties: smaller gap, then earlier right
    time, then ``tie`` columns. Rows without a key or a time are kept unmatched.
    """
    on, payload, tie = list(on), list(payload), list(tie)
    back_s = window_s
    ahead_s = window_s if forward_s is None else forward_s
    width = max(chunk_s, 2 * (back_s + ahead_s))
    keys = [f"k{i}" for i in range(len(on))]
    aliased = left.select(
        *[F.col(name).alias(f"k{i}") for i, (name, _) in enumerate(on)], F.col(left_time)
    )
    asks = distinct_seconds(aliased, keys, F.col(left_time))
    reps = _right_per_second(right, on, right_time, tie, payload)
    best_type = reps.schema["best"].dataType
    spread = reps.select(
        *keys,
        F.explode(
            F.sequence(
                F.floor((F.col("sec") - ahead_s) / width), F.floor((F.col("sec") + back_s) / width)
            )
        ).alias("chunk"),
        "sec",
        F.lit(0).alias("ask"),
        F.struct(F.col("sec").alias("sec"), F.col("best").alias("best")).alias("hit"),
    )
    hit_type = spread.schema["hit"].dataType
    both = spread.unionByName(
        asks.select(
            *keys,
            F.floor(F.col("sec") / width).alias("chunk"),
            "sec",
            F.lit(1).alias("ask"),
            F.lit(None).cast(hit_type).alias("hit"),
        )
    )
    # one sort serves both directions, each a linear pass; a hit of the same second comes before its ask
    before = F.last("hit", ignorenulls=True).over(
        Window.partitionBy(*keys, "chunk").orderBy("sec", "ask").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    after = F.expr(
        f"lead(hit) IGNORE NULLS OVER (PARTITION BY {', '.join([*keys, 'chunk'])} ORDER BY sec, ask)"
    )
    found = both.select(*keys, "sec", "ask", before.alias("b"), after.alias("a")).filter("ask = 1")
    gap_b = F.col("sec") - F.col("b.sec")
    gap_a = F.col("a.sec") - F.col("sec")
    ok_b = F.coalesce(gap_b <= back_s, F.lit(False))
    ok_a = F.coalesce(gap_a <= ahead_s, F.lit(False))
    take_b = ok_b & (~ok_a | (gap_b <= gap_a))
    nearest = found.filter(ok_b | ok_a).select(
        *keys,
        F.col("sec").alias("_sec"),
        F.when(take_b, gap_b).otherwise(gap_a).alias(gap_col),
        F.when(take_b, F.col("b.best")).otherwise(F.col("a.best")).cast(best_type).alias("_best"),
    )
    condition: Column = epoch(F.col(f"l.{left_time}")) == F.col("n._sec")
    for i, (name, _) in enumerate(on):
        condition &= F.col(f"l.{name}") == F.col(f"n.k{i}")
    place = {c: f"tie{tie.index(c)}" if c in tie else f"row.{c}" for c in payload}
    return (
        left.alias("l")
        .join(nearest.alias("n"), condition, "left")
        .select("l.*", *[F.col(f"n._best.{place[c]}").alias(c) for c in payload], f"n.{gap_col}")
    )


def window_match_counts(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    window_s: int,
    on: list[tuple[str, str]] = (),
    forward_s: int | None = None,
    count_col: str = "matches",
) -> DataFrame:
    """The theta join ``abs(gap) <= window`` folded to its size per left row.

    Every left row comes back once with the number of right rows in its window.
    """
    on = list(on)
    keys = [f"k{i}" for i in range(len(on))] or ["k0"]
    left_keys = [F.col(n) for n, _ in on] or [F.lit(0)]
    right_keys = [F.col(n) for _, n in on] or [F.lit(0)]
    asks = distinct_seconds(
        left.select(*[c.alias(k) for c, k in zip(left_keys, keys)], left_time),
        keys,
        F.col(left_time),
    )
    facts = (
        right.select(
            *[c.alias(k) for c, k in zip(right_keys, keys)],
            epoch(F.col(right_time)).alias("sec"),
        )
        .dropna()
        .groupBy(*keys, "sec")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = sums_within(
        asks, facts, keys, ["n"], window_s, window_s if forward_s is None else forward_s
    )
    condition: Column = epoch(F.col(f"l.{left_time}")) == F.col("n.sec")
    for i, (name, _) in enumerate(on):
        condition &= F.col(f"l.{name}") == F.col(f"n.k{i}")
    return (
        left.alias("l")
        .join(counts.alias("n"), condition, "left")
        .select("l.*", F.coalesce(F.col("n.n"), F.lit(0)).cast("long").alias(count_col))
    )
