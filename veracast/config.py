"""Business constants. Every rule that uses one takes a ``Settings`` so a site can override it."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Window lengths in months, thresholds, cut points and labels are part of
# the audit's definition and must not drift.
WINDOWS_EXEC = (1, 3, 6, 12)
WINDOWS_FULL = tuple(range(1, 25))
VALID_ALGORITHMS = (
    "Neural_Network",
    "Prophet",
    "ARIMAX",
    "Octopus_L",
    "Holt_Winters",
    "Auto_ARIMA",
    "ETS",
    "STLF",
    "MAwS",
    "TSLM",
    "Expert_DP",
)
NAIVE_LABELS = ("naive",)
PLANNER_LABELS = ("planner", "expert_dp")
SEGMENT_PLANNER = "Expert_DP"


@dataclass(frozen=True)
class Settings:
    """All thresholds of the audit, immutable for the length of a run."""

    windows: tuple[int, ...] = WINDOWS_EXEC
    valid_algorithms: tuple[str, ...] = VALID_ALGORITHMS

    # drift
    tracking_signal_limit: float = 6.0
    critical_factor: float = 1.5
    mape_red: float = 30.0
    # Part of the published threshold table; no rule reads them.
    wape_red: float = 25.0
    bias_abs: float = 10.0

    # ABC / XYZ. The look-back keeps ``month >= add_months(last, -12)``: 13 calendar months.
    segment_lookback_months: int = 12
    abc_cuts_pct: tuple[int, int] = (80, 95)
    xyz_cuts: tuple[float, float] = (0.5, 1.0)
    cv_without_sales: float = 99.0
    mape_targets: Mapping[str, float] = field(
        default_factory=lambda: {"A": 10.0, "B": 20.0, "C": 40.0}
    )

    # lead time
    default_lead_time_days: int = 45
    volatility_preference: tuple[str, ...] = ("wape", "rmse")
    risk_cuts: tuple[float, float, float] = (0.15, 0.25, 0.35)
    long_lead_time_days: int = 90

    # back-test
    holdout_months: int = 6
    min_train_months: int = 12
    season_months: int = 12
    stockout_error: float = -0.20

    @classmethod
    def from_env(cls) -> Settings:
        """EXEC windows unless ``ANALYTICAL_WINDOWS_MODE`` asks for FULL."""
        mode = os.environ.get("ANALYTICAL_WINDOWS_MODE", "EXEC").upper()
        return cls(windows=WINDOWS_FULL if mode == "FULL" else WINDOWS_EXEC)
