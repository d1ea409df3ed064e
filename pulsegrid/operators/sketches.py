"""Distinct counts of any period from sketches stored per day.

A distinct count cannot be added up over days, so without more every period scans its
facts. A HyperLogLog sketch of each day can be merged: a period reads one small row per day
and group. Relative standard error is 1.04 / sqrt(2^LOG_K) (0.6 %); small sets are
exact. The exact form stays ``count_distinct`` over the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOG_K = 15
#: Standard error of an estimate, relative to it.
RELATIVE_ERROR = 1.04 / 2 ** (LOG_K / 2)


def daily_sketches(df: DataFrame, time: str, value: str, by: list[str] = ()) -> DataFrame:
    """(by, partition_date, sketch): the different values of each day; nulls do not count, rows without a time are left out."""
    return df.filter(F.col(time).isNotNull()).groupBy(*by, F.to_date(time).alias("partition_date")).agg(
        F.hll_sketch_agg(value, F.lit(LOG_K)).alias("sketch")
    )


def merged(stored: DataFrame | None, fresh: DataFrame, by: list[str] = ()) -> DataFrame:
    """The days of ``fresh`` with what is stored of them: late rows change their own day only, repeated ones nothing."""
    if stored is None:
        return fresh
    days = fresh.select("partition_date").distinct()
    both = stored.join(days, "partition_date", "left_semi").unionByName(fresh)
    return both.groupBy(*by, "partition_date").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_values(sketches: DataFrame, by: list[Column | str] = (), name: str = "distinct_values") -> DataFrame:
    """Different values per group of days: the groups, the estimate and one standard error of it."""
    found = sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
    return found.withColumn(f"{name}_error", F.round(F.col(name) * RELATIVE_ERROR, 1))


def month_change(sketches: DataFrame, name: str) -> DataFrame:
    """(month, value, previous, change_pct) of different values per calendar month."""
    from pulsegrid.operators.series import period_over_period

    months = distinct_values(sketches, [F.to_date(F.date_trunc("month", "partition_date")).alias("month")], name)
    return period_over_period(months.drop(f"{name}_error"), "month", name)
