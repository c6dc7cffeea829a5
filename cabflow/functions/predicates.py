"""Date-range predicates that also prune the fact's month directories."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _month_start(d: date) -> date:
    return d.replace(day=1)


def _is_month_end(d: date) -> bool:
    return (d + timedelta(days=1)).day == 1


def pickup_range(lo: date | None = None, hi: date | None = None, *,
                 closed: bool = False, month_col: str | None = "pickup_month",
                 date_col: str = "pickup_date") -> Column:
    """``lo <= pickup_date < hi`` (``<= hi`` when closed), plus the implied
    bound on the ``pickup_month`` partition column so that Spark lists only
    the month directories in range (a filter on pickup_date alone reaches the
    Parquet row groups but not the directory listing).

    ``pickup_month`` is the first day of ``pickup_date``'s month, so when a
    bound falls on a month boundary the month predicate alone is exact and
    the day predicate is left out: whole-month ranges then need no data
    column at all (a count is answered from file metadata).
    """
    d = F.col(date_col)
    conds = []
    if lo is not None:
        if month_col:
            conds.append(F.col(month_col) >= F.lit(_month_start(lo)))
        if not month_col or lo.day != 1:
            conds.append(d >= F.lit(lo))
    if hi is not None:
        last = hi if closed else hi - timedelta(days=1)
        if month_col:
            conds.append(F.col(month_col) <= F.lit(_month_start(last)))
        if not month_col or not _is_month_end(last):
            conds.append(d <= F.lit(hi) if closed else d < F.lit(hi))
    if not conds:
        return F.lit(True)
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
