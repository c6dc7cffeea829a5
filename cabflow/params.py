"""Run parameters: date bounds, analysis year, thresholds."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class Params:
    # Earliest pickup/dropoff date kept by silver.
    min_date: date = date(2022, 1, 1)
    # Year analysed by the per-year questions (q01, q03-q05, q09-q11, q15, q16).
    year: int = 2024
    # Services whose slices are expected (coverage grid, LIST partition domain).
    services: tuple[str, ...] = ("yellow", "green")
    # q13: HAVING COUNT(*) >= min_trips.
    min_trips: int = 100
    # Global top-k (q03, q04, q12, q13, q19, q20) and per-group top-n (q05, q06).
    top_k: int = 10
    top_per_group: int = 5
    # Largest dimension we agree to broadcast; above it joins fall back to a
    # shuffle join chosen by Spark.
    broadcast_max_rows: int = 2_000_000
    # Build dim_date / dim_time from pickup and dropoff values (True) or
    # from pickup values only, as the reference's models do (False).
    dropoff_dates: bool = True
    dropoff_times: bool = True

    @property
    def year_start(self) -> date:
        return date(self.year, 1, 1)

    @property
    def next_year_start(self) -> date:
        return date(self.year + 1, 1, 1)

    @property
    def year_end(self) -> date:
        return date(self.year, 12, 31)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Bounds used on the test tables (order dates run 1995-2001).
FIXTURE_PARAMS = Params(min_date=date(1996, 1, 1), year=1997)
