"""Settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600


@dataclass(frozen=True)
class Settings:
    # Results depend on these.
    alert_threshold: float = 0.50
    max_daily_alerts: int = 200
    train_test_split_day: int = 24
    min_promotion_gain: float = 0.0
    psi_watch_level: float = 0.1
    psi_alert_level: float = 0.2
    psi_floor: float = 1e-4
    score_bins: int = 10
    lookback_days: int = 30
    watermark_days: int = 2
    no_previous_seconds: int = DAY_SECONDS * 30
    merchant_prior_fraud: int = 1
    merchant_prior_rows: int = 200
    max_fpr: float = 0.005
    min_merchant_volume: int = 50

    # Physical limits: results do not depend on these.
    hot_group_rows: int = 1_000_000
    max_broadcast_rows: int = 500_000
    bucket_rows: int = 100_000
    prefix_fanout: int = 1_000
    admitted_bytes: int = 1 << 38


DEFAULTS = Settings()
