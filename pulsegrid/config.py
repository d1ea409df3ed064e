"""Thresholds and windows, in one frozen object that callers pass in."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace

#: Configuration file keys and the field each one sets.
CONFIG_KEYS = {
    "gatewayOfflineThresholdMinutes": "offline_minutes",
    "spoolWarnThresholdPct": "spool_warn_pct",
    "spoolErrorThresholdPct": "spool_error_pct",
    "credentialDriftConsecutiveIntervals": "bad_polls",
    "errorRateThresholdPct": "error_rate_pct",
    "networkSaturationThresholdPct": "network_saturation_pct",
}


@dataclass(frozen=True)
class Settings:
    """Every tunable number of the engine."""

    # correlation windows, seconds
    refresh_window_s: int = 30
    os_event_window_s: int = 120
    network_window_s: int = 300
    activity_window_s: int = 60
    band_minutes: int = 10
    # health and alerting
    offline_minutes: float = 10.0
    degraded_minutes: float = 5.0
    spool_warn_pct: float = 15.0
    spool_error_pct: float = 5.0
    bad_polls: int = 3
    error_rate_pct: float = 25.0
    error_rate_min_queries: int = 10
    network_saturation_pct: float = 80.0
    network_high_pct: float = 60.0
    anomaly_score: float = 2.5
    runaway_mb: float = 6000.0
    spool_floor_gb: float = 10.0
    breaker_fires: int = 3
    breaker_window_s: int = 1800
    # load skew classes
    skew_severe: float = 0.8
    skew_moderate: float = 0.5
    skew_slight: float = 0.2
    # causal classes
    latency_ms: float = 200.0
    cpu_pct: float = 90.0
    # retention, days
    bronze_days: int = 90
    silver_days: int = 90
    gold_days: int = 365
    identity_days: int = 30
    # capacity advice
    capacity_share: float = 0.85
    cpu_forecast_pct: float = 80.0

    def with_overrides(self, **changes) -> "Settings":
        return replace(self, **changes)

    @classmethod
    def from_json(cls, text: str) -> "Settings":
        """Read the ``alerting`` section of a configuration file; unknown keys are ignored."""
        section = json.loads(text).get("alerting", {})
        types = {f.name: type(f.default) for f in fields(cls)}
        chosen = {
            CONFIG_KEYS[key]: types[CONFIG_KEYS[key]](value)
            for key, value in section.items()
            if key in CONFIG_KEYS
        }
        return cls(**chosen)


DEFAULTS = Settings()
