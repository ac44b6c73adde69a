"""Parameters of the analysis and of its physical execution."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Params:
    # demand
    min_loads: int = 20
    since: date = date(2024, 1, 1)
    ship_types: tuple[int, ...] = (25,)
    weeks_network: int = 48
    weeks_partner: int = 40
    min_partner_volume: int = 20
    default_oneway_cost: int = 10000
    # distance
    detour: float = 1.2
    km_per_mile: float = 1.6
    earth_radius_m: float = 6371010.0
    # tours
    max_miles: float = 1200.0
    max_empty: float = 0.50
    max_mid_campuses: int = 3
    # cost
    fuel_per_mile: float = 0.4
    # matching
    description: str = "backhaul matching"
    target_gap: float = 0.01


@dataclass(frozen=True)
class Tuning:
    """How expanding joins are cut into tasks; no effect on results."""

    # output rows one task of an expanding join should produce
    pairs_per_task: int = 500_000
    # upper bound on explicitly requested partitions
    max_tasks: int = 100_000


DEFAULT = Params()
TUNING = Tuning()
