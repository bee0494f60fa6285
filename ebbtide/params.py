"""Every window, threshold and tier table of the engine, in one place.

All plans take an explicit ``as_of`` date; nothing reads the wall clock unless
the caller leaves ``as_of`` empty.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Business weight of a churner and fewest rows for a tier model.
TIER_WEIGHTS = {
    "VVIP": 15.0,
    "GOLD": 8.0,
    "SILVER": 4.0,
    "BLACK": 2.0,
    "BRONZE": 1.5,
    "unknown": 1.0,
}
TIER_MIN_ROWS = {
    "VVIP": 50,
    "GOLD": 75,
    "SILVER": 100,
    "BLACK": 150,
    "BRONZE": 150,
    "unknown": 100,
}
DEFAULT_WEIGHT = 1.0
DEFAULT_MIN_ROWS = 100

UNKNOWN = "unknown"
GLOBAL_ROUTE = "global"
TIER = "member_tier_when_transact"


@dataclass(frozen=True)
class ChurnParams:
    """Windows are in days back from ``as_of``."""

    as_of: dt.date = field(default_factory=dt.date.today)
    history_days: int = 365
    current_days: int = 60
    previous_days: int = 60
    baseline_days: int = 120
    threshold: float = 0.5
    min_orders: int = 3
    trend_days: int = 90
    cohort_windows: tuple[int, ...] = (30, 60, 90, 120)
    # True reads a history-day count of 0 (not 1) as "no history" in the cohort flags.
    guard_zero: bool = False
    inactive_days: int = 60


@dataclass(frozen=True)
class BoostSpec:
    trees: int
    step: float
    depth: int
    row_share: float
    column_share: float


# Boosting settings per route.
BOOST_SPECS = {
    "VVIP": BoostSpec(300, 0.05, 4, 0.8, 0.8),
    "GOLD": BoostSpec(250, 0.08, 5, 0.85, 0.85),
    "SILVER": BoostSpec(250, 0.08, 5, 0.85, 0.85),
    GLOBAL_ROUTE: BoostSpec(250, 0.08, 6, 0.85, 0.85),
}
OTHER_TIER_SPEC = BoostSpec(200, 0.1, 6, 0.9, 0.9)


@dataclass(frozen=True)
class ModelParams:
    seed: int = 42
    weights: dict[str, float] = field(default_factory=lambda: dict(TIER_WEIGHTS))
    min_rows: dict[str, int] = field(default_factory=lambda: dict(TIER_MIN_ROWS))
    # Boosting settings per route; ``other`` is for tiers without an entry.
    specs: dict[str, BoostSpec] = field(default_factory=lambda: dict(BOOST_SPECS))
    other: BoostSpec = OTHER_TIER_SPEC
    max_bins: int = 32
    # Routes fitted at the same time (jobs of one Spark application).
    parallel_fits: int = 8
    # Rows per task while boosting; small tiers are packed into few tasks.
    rows_per_task: int = 200_000

    def spec(self, route: str) -> BoostSpec:
        return self.specs.get(route, self.other)
