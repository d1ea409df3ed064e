"""Arithmetic, time and classification expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulsegrid.config import DEFAULTS, Settings


def epoch(col: Column) -> Column:
    """Whole seconds since the epoch; all time gaps are measured on these."""
    return F.unix_timestamp(col)


def gap_seconds(a: Column, b: Column) -> Column:
    return F.abs(epoch(a) - epoch(b))


def minutes_between(start: Column, end: Column) -> Column:
    return (epoch(end) - epoch(start)) / F.lit(60.0)


def bin_start(col: Column, seconds: int) -> Column:
    """Start of the fixed-width bin the timestamp falls into."""
    return F.timestamp_seconds(F.floor(epoch(col) / F.lit(seconds)) * F.lit(seconds))


def ratio(a: Column, b: Column, alt: float | None = None) -> Column:
    """``a / b``; ``alt`` (default null) where ``b`` is zero or either is null."""
    value = F.try_divide(a.cast("double"), b.cast("double"))
    return value if alt is None else F.coalesce(value, F.lit(float(alt)))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent with a denominator of at least one."""
    return F.round(part / F.greatest(whole, F.lit(1)) * F.lit(100.0), digits)


def utilization_pct(bytes_per_s: Column, bandwidth_bps: Column) -> Column:
    """NIC load in percent, at most 100; null without a bandwidth."""
    load = bytes_per_s * 8.0 / bandwidth_bps * 100.0
    return F.when(bandwidth_bps > 0, F.least(F.lit(100.0), load))


def free_pct(free: Column, used: Column) -> Column:
    return F.try_divide(free.cast("double"), (free + used).cast("double")) * 100.0


def disk_level(pct: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(pct <= cfg.spool_error_pct, F.lit("ERROR"))
        .when(pct <= cfg.spool_warn_pct, F.lit("WARNING"))
        .when(pct.isNotNull(), F.lit("OK"))
    )


def spool_status(pct: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(pct.isNull(), F.lit("Unknown"))
        .when(pct <= cfg.spool_error_pct, F.lit("CRITICAL"))
        .when(pct <= cfg.spool_warn_pct, F.lit("LOW"))
        .otherwise(F.lit("OK"))
    )


def node_status(age_minutes: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(age_minutes.isNull(), F.lit("Unknown"))
        .when(age_minutes > cfg.offline_minutes, F.lit("OFFLINE"))
        .when(age_minutes > cfg.degraded_minutes, F.lit("Degraded"))
        .otherwise(F.lit("Live"))
    )


def network_status(pct: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(pct.isNull(), F.lit("Unknown"))
        .when(pct >= cfg.network_saturation_pct, F.lit("SATURATED"))
        .when(pct >= cfg.network_high_pct, F.lit("HIGH"))
        .otherwise(F.lit("OK"))
    )


def skew_class(cv: Column, cfg: Settings = DEFAULTS) -> Column:
    return (
        F.when(cv.isNull(), F.lit("SINGLE_NODE_OR_NO_DATA"))
        .when(cv > cfg.skew_severe, F.lit("SEVERELY_SKEWED"))
        .when(cv > cfg.skew_moderate, F.lit("MODERATELY_SKEWED"))
        .when(cv > cfg.skew_slight, F.lit("SLIGHTLY_SKEWED"))
        .otherwise(F.lit("BALANCED"))
    )


def transfer_efficiency(spool_bytes: Column, duration_ms: Column, nic_bytes_per_s: Column) -> Column:
    """Spooled bytes over what the NIC could move in the same time."""
    usable = (spool_bytes > 0) & (nic_bytes_per_s > 0) & (duration_ms > 0)
    return F.when(usable, spool_bytes / (duration_ms / 1000.0 * nic_bytes_per_s))


def refresh_seconds(start: Column, end: Column) -> Column:
    """Length of a refresh, never negative, zero when a bound is missing."""
    return F.coalesce(
        F.greatest(F.lit(0.0), end.cast("double") - start.cast("double")), F.lit(0.0)
    )


def first_19(col: Column) -> Column:
    """The ``YYYY-MM-DDTHH:MM:SS`` part of an ISO text as a timestamp."""
    return F.substring(col, 1, 19).try_cast("timestamp")


#: Parts of the names of loopback and tunnel adapters, which carry no load of their own.
VIRTUAL_ADAPTERS = "isatap|teredo|loopback|6to4"


def physical_adapter(nic: Column) -> Column:
    """Whether an adapter's name is not one of a virtual adapter; a null name counts as physical."""
    return ~F.coalesce(F.lower(nic.cast("string")).rlike(VIRTUAL_ADAPTERS), F.lit(False))
