"""Regular time series in long form: one row per (key, step).

A series has as many rows as the grid has steps, whatever the number of source
rows, so one window per key is bounded and every step below shares its exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.functions.scalars import epoch


def make_series(
    df: DataFrame,
    keys: list[str],
    time: str,
    value: Column,
    start: Column,
    stop: Column,
    step_s: int,
    default: float | None = 0.0,
) -> DataFrame:
    """``value`` aggregated per key and step on the grid [start, stop).

    Columns: keys, ``idx`` (step number), ``bin`` (step start), ``value``. Steps
    without rows get ``default``.
    """
    first, last = epoch(start), epoch(stop)
    idx = F.floor((epoch(F.col(time)) - first) / F.lit(step_s)).cast("int")
    inside = df.filter((F.col(time) >= start) & (F.col(time) < stop))
    binned = inside.groupBy(*keys, idx.alias("idx")).agg(value.cast("double").alias("value"))
    steps = F.ceil((last - first) / F.lit(step_s)).cast("int")
    # each filled step also brings the empty ones up to the next, so the rows are read once
    order = Window.partitionBy(*keys).orderBy("idx")
    covers = F.sequence(
        F.when(F.lag("idx").over(order).isNull(), F.lit(0)).otherwise(F.col("idx")),
        F.coalesce(F.lead("idx").over(order), steps) - 1,
    )
    empty_value = F.lit(default).cast("double")
    filled = F.when(F.col("step") == F.col("idx"), F.coalesce("value", empty_value)).otherwise(empty_value)
    return (
        binned.withColumn("covers", covers)
        .select(*keys, "idx", "value", F.explode("covers").alias("step"))
        .select(
            *keys,
            F.col("step").alias("idx"),
            F.timestamp_seconds(first + F.col("step").cast("long") * step_s).alias("bin"),
            filled.alias("value"),
        )
    )


def series_expand(df: DataFrame, keys: list[str], arrays: dict[str, str]) -> DataFrame:
    """Parallel arrays back to rows, each cast to its type."""
    zipped = F.explode(F.arrays_zip(*[F.col(a) for a in arrays]))
    return df.select(*keys, zipped.alias("z")).select(
        *keys, *[F.col(f"z.{a}").cast(t).alias(a) for a, t in arrays.items()]
    )


def series_pack(series: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the ordered value array; length is the grid's."""
    packed = F.array_sort(F.collect_list(F.struct("idx", "bin", "value")))
    return series.groupBy(*keys).agg(packed.alias("p")).select(
        *keys, F.col("p.bin").alias("bin"), F.col("p.value").alias("value")
    )


def with_trend(series: DataFrame, keys: list[str]) -> DataFrame:
    """Straight line through each series, on the step number."""
    group = Window.partitionBy(*keys)
    return series.withColumns(
        {
            "slope": F.regr_slope("value", F.col("idx")).over(group),
            "intercept": F.regr_intercept("value", F.col("idx")).over(group),
        }
    ).withColumn("trend", F.col("intercept") + F.col("slope") * F.col("idx"))


def series_trend(series: DataFrame, keys: list[str]) -> DataFrame:
    """Slope and intercept per key."""
    return series.groupBy(*keys).agg(
        F.regr_slope("value", F.col("idx")).alias("slope"),
        F.regr_intercept("value", F.col("idx")).alias("intercept"),
        F.count(F.lit(1)).alias("steps"),
    )


#: Let the operators below find the period of each series.
AUTO = -1


def with_period(series: DataFrame, keys: list[str], period: int) -> DataFrame:
    """Add ``period``: the given one, or with ``AUTO`` the one found for each series (1: no season)."""
    if period != AUTO:
        return series.withColumn("period", F.lit(period))
    found = find_period(series, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "period")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return series.join(found, same).drop(*[f"_{k}" for k in keys])


def with_seasonal(series: DataFrame, keys: list[str], period: int) -> DataFrame:
    """Mean of the detrended value at the same place of the period."""
    placed = with_trend(with_period(series, keys, period), keys).withColumn("slot", F.col("idx") % F.col("period"))
    seasonal = F.avg(F.col("value") - F.col("trend")).over(Window.partitionBy(*keys, "slot"))
    return placed.withColumn("seasonal", seasonal)


def autocorrelation(series: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, steps, r): autocorrelation of the detrended series at the lags 1 to half its length, as an array.

    Lag sums are over the sum of squares of the whole series, so a multiple of a
    period scores less than the period. A series without any variation has none.
    """
    flat = with_trend(series, keys).select(*keys, "idx", (F.col("value") - F.col("trend")).alias("d"))
    packed = flat.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "d"))), lambda x: x["d"]).alias("d"),
        F.count(F.lit(1)).cast("int").alias("steps"), F.sum(F.col("d") * F.col("d")).alias("squares"),
    )
    products = lambda p: F.zip_with(
        F.slice("d", p + 1, F.col("steps") - p), F.slice("d", F.lit(1), F.col("steps") - p), lambda x, y: x * y)
    at_lag = lambda p: F.aggregate(products(p), F.lit(0.0), lambda total, x: total + x)
    lags = F.when(F.col("steps") >= 4, F.sequence(F.lit(1), F.floor(F.col("steps") / 2).cast("int"))).otherwise(F.array().cast("array<int>"))
    scores = F.transform(lags, lambda p: F.round(at_lag(p) / F.col("squares"), 6))
    return packed.select(*keys, "steps", F.when(F.col("squares") > 1e-9, scores).otherwise(F.array().cast("array<double>")).alias("r"))


def find_period(series: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, period, autocorrelation) of each series, looked for at all lags.

    The period is the highest peak of the autocorrelation behind the first lag where it is not positive
    (before that a slow series only resembles itself). A peak counts if it is above
    2 / sqrt(steps), the bound for noise; without one the period is 1 and the score null.
    """
    scored = autocorrelation(series, keys)
    dip = F.array_position(F.transform("r", lambda x: x <= 0), True)  # 1-based, so it is the lag
    each = F.transform("r", lambda x, i: F.struct(
        x.alias("r"), (-(i + 1)).alias("minus"), F.get("r", i - 1).alias("before"), F.get("r", i + 1).alias("behind")))
    peaks = F.filter(each, lambda x: (
        (dip > 0) & (-x["minus"] > dip) & (x["r"] >= x["before"]) & (x["r"] > x["behind"])
        & (x["r"] > F.lit(2.0) / F.sqrt("steps"))))
    best = F.array_max(F.transform(peaks, lambda x: F.struct(x["r"].alias("r"), x["minus"].alias("minus"))))
    return scored.select(*keys, F.coalesce(-best["minus"], F.lit(1)).cast("int").alias("period"), best["r"].alias("autocorrelation"))


def detect_period(series: DataFrame, keys: list[str], candidates: list[int]) -> DataFrame:
    """Candidate lag with the highest autocorrelation of the detrended series."""
    order = Window.partitionBy(*keys).orderBy("idx")
    flat = with_trend(series, keys).withColumn("d", F.col("value") - F.col("trend"))
    lagged = flat.withColumns({f"d{p}": F.lag("d", p).over(order) for p in candidates})
    scores = lagged.groupBy(*keys).agg(
        *[F.round(F.corr("d", f"d{p}"), 4).alias(f"r{p}") for p in candidates]
    )
    best = F.array_max(
        F.array(*[F.struct(F.col(f"r{p}").alias("r"), F.lit(-p).alias("p")) for p in candidates])
    )
    return scores.select(
        *keys, (-best["p"]).alias("period"), best["r"].alias("autocorrelation")
    )


def decompose_anomalies(
    series: DataFrame, keys: list[str], period: int, threshold: float = 1.5
) -> DataFrame:
    """Residuals scored by their distance beyond the 10th/90th percentile; the period may be ``AUTO``.

    score = (r - p90)/(p90 - p10) above the band, (r - p10)/(p90 - p10) below
    it, 0 inside it or when the band has no width. flag = sign of the score when
    its size exceeds ``threshold``.
    """
    group = Window.partitionBy(*keys)
    fitted = with_seasonal(series, keys, period).withColumn(
        "baseline", F.col("trend") + F.col("seasonal")
    )
    scored = fitted.withColumn("r", F.col("value") - F.col("baseline")).withColumns(
        {
            "p10": F.percentile("r", F.lit(0.1)).over(group),
            "p90": F.percentile("r", F.lit(0.9)).over(group),
        }
    )
    width = F.col("p90") - F.col("p10")
    score = (
        F.when(width <= 1e-9, F.lit(0.0))
        .when(F.col("r") > F.col("p90"), (F.col("r") - F.col("p90")) / width)
        .when(F.col("r") < F.col("p10"), (F.col("r") - F.col("p10")) / width)
        .otherwise(F.lit(0.0))
    )
    return scored.withColumn("score", score).select(
        *keys,
        "idx",
        "bin",
        "value",
        "baseline",
        "score",
        F.when(F.col("score") > threshold, 1)
        .when(F.col("score") < -threshold, -1)
        .otherwise(0)
        .alias("flag"),
    )


def anomaly_filter(scored: DataFrame, min_score: float = DEFAULTS.anomaly_score) -> DataFrame:
    return scored.filter((F.col("flag") != 0) & (F.col("score") > min_score))


def forecast(series: DataFrame, keys: list[str], period: int, horizon: int, step_s: int) -> DataFrame:
    """Trend plus season continued ``horizon`` steps past the grid; the period may be ``AUTO``.

    The last period of a series already carries every place of the season, so
    its rows are shifted forward instead of joined to a future grid.
    """
    fitted = with_seasonal(series, keys, period).withColumn(
        "steps", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    )
    turns = F.ceil(F.lit(horizon) / F.col("period")).cast("int")
    ahead = fitted.filter(F.col("idx") >= F.col("steps") - F.col("period")).withColumn(
        "turn", F.explode(F.sequence(F.lit(1), turns))
    )
    future = F.col("idx") + F.col("turn") * F.col("period")
    return ahead.filter(future < F.col("steps") + horizon).select(
        *keys,
        future.cast("int").alias("idx"),
        F.timestamp_seconds(epoch(F.col("bin")) + F.col("turn") * F.col("period") * F.lit(step_s)).alias("bin"),
        (F.col("intercept") + F.col("slope") * future + F.col("seasonal")).alias("forecast"),
    )


def forecast_floor_breach(
    forecasts: DataFrame, keys: list[str], floor: float = DEFAULTS.spool_floor_gb
) -> DataFrame:
    """Keys whose lowest forecast is below the floor, with the first breach."""
    below = F.when(F.col("forecast") < floor, F.col("bin"))
    return (
        forecasts.groupBy(*keys)
        .agg(F.min("forecast").alias("min_forecast"), F.min(below).alias("first_breach"))
        .filter(F.col("min_forecast") < floor)
    )


def lagged_correlation(
    cause: DataFrame, effect: DataFrame, keys: list[str], lags: list[int]
) -> DataFrame:
    """Per key: correlation of the cause ``k`` steps earlier with the effect, best lag first."""
    order = Window.partitionBy(*keys).orderBy("idx")
    both = cause.select(*keys, "idx", F.col("value").alias("c")).join(
        effect.select(*keys, "idx", F.col("value").alias("e")), [*keys, "idx"]
    )
    shifted = both.withColumns({f"c{k}": F.lag("c", k).over(order) for k in lags})
    scores = shifted.groupBy(*keys).agg(
        *[F.round(F.corr(f"c{k}", "e"), 4).alias(f"r{k}") for k in lags]
    )
    best = F.array_max(
        F.array(
            *[
                F.struct(F.abs(f"r{k}").alias("size"), F.lit(-k).alias("k"), F.col(f"r{k}").alias("r"))
                for k in lags
            ]
        )
    )
    return scores.select(*keys, (-best["k"]).alias("best_lag"), best["r"].alias("correlation"))


def date_dimension(df: DataFrame, time: str) -> DataFrame:
    """Calendar of all days from the first to the last in ``df``."""
    bounds = df.agg(F.to_date(F.min(time)).alias("a"), F.to_date(F.max(time)).alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


def scale_out_advisory(
    load_forecast: DataFrame,
    cpu_forecast: DataFrame,
    key: str,
    capacity: float,
    cfg: Settings = DEFAULTS,
) -> DataFrame:
    """Advise another node where peak load and peak CPU forecasts are both high."""
    peak = load_forecast.groupBy(key).agg(F.max("forecast").alias("peak_load"))
    cpu = cpu_forecast.groupBy(key).agg(F.max("forecast").alias("peak_cpu"))
    return peak.join(cpu, key).withColumn(
        "advise",
        (F.col("peak_load") > cfg.capacity_share * capacity)
        & (F.col("peak_cpu") > cfg.cpu_forecast_pct),
    )


def period_over_period(df: DataFrame, month: str, value: str, by: list[str] = ()) -> DataFrame:
    """Value of the previous calendar month and the change in percent.

    ``df`` has one row per (by, month). A self-join on the shifted month keeps
    gaps as gaps: a missing month has no previous value.
    """
    prev = df.select(
        *by, F.add_months(F.to_date(month), 1).alias("_next"), F.col(value).alias("previous")
    )
    condition = F.to_date(F.col(f"c.{month}")) == F.col("p._next")
    for key in by:
        condition &= F.col(f"c.{key}").eqNullSafe(F.col(f"p.{key}"))
    change = F.try_divide(
        (F.col(f"c.{value}") - F.col("p.previous")).cast("double"), F.col("p.previous").cast("double")
    )
    return df.alias("c").join(prev.alias("p"), condition, "left").select(
        "c.*", "p.previous", F.round(change * 100.0, 2).alias("change_pct")
    )
