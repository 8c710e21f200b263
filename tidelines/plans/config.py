"""Job settings. Defaults are the established values of the daily and hourly tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DailyConfig:
    train_ratio: float = 0.70
    val_ratio: float = 0.15
    test_ratio: float = 0.15
    lag_days: tuple[int, ...] = (1, 2, 3)
    rolling_windows: tuple[int, ...] = (3, 7, 14)
    max_interpolation_gap_days: int = 3
    # The established table fills gaps of any length; True applies max_interpolation_gap_days.
    enforce_gap: bool = False
    clip_outliers: bool = True
    wind_mean: str = "degrees"
    shift_hours: float = 0
    whole_dates: bool = False
    # The established table keeps repeated readings; True keeps the newest per station and time.
    dedupe: bool = True
    ties: tuple[str, ...] = ("record_hash",)
    version: str = "1.0.0"


@dataclass(frozen=True)
class HourlyConfig:
    target: str = "pm2_5_ugm3"
    years: tuple[int, ...] | None = None  # all
    lag_hours: tuple[int, ...] = (1, 2, 3, 6, 12, 24)
    rolling_windows: tuple[int, ...] = (3, 6, 12, 24)
    interpolate: bool = True
    interpolation_method: str = "linear"
    train_ratio: float = 0.70
    val_ratio: float = 0.15
    test_ratio: float = 0.15
    horizon: int = 24
    normalise: bool = True
    method: str = "standard"
    weekend_from: int = 5
    max_missing_ratio: float | None = None
    dedupe: bool = True
    ties: tuple[str, ...] = ("record_hash",)
    version: str = "1.0.0"


@dataclass(frozen=True)
class CombinedConfig:
    target: str = "pm2_5_ugm3"
    years: tuple[int, ...] | None = None  # all
    lag_hours: tuple[int, ...] = (1, 3, 6, 12, 24)
    rolling_windows: tuple[int, ...] = (3, 6, 12, 24)
    weekend_from: int = 5
    dedupe: bool = True
    ties: tuple[str, ...] = ("record_hash",)
