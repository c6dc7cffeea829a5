"""The reshaped reports (R1-R5) over the questions' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from cabflow.operators.reshape import pivot_counts, route_edges, unpivot_measures
from cabflow.params import Params
from cabflow.plans import questions as Q


def boroughs(zones: DataFrame) -> list[str]:
    """The lookup's boroughs, by name: the columns of a pivot by borough."""
    rows = zones.where(zones["borough"].isNotNull()).select("borough").distinct().collect()
    return sorted(r[0] for r in rows)


def reshaped(t: Q.Tables, zones: DataFrame, p: Params) -> dict[str, Callable[[], DataFrame]]:
    """Name -> report: R1-R3 wide, R4 long, R5 as the edges of a flow."""
    return {
        "pivot_month_borough": lambda: pivot_counts(Q.q05(t, p), "month", "borough", "total_trips", boroughs(zones)),
        "pivot_dow_hour": lambda: pivot_counts(Q.q06(t, p), "day_of_week", "hour", "total_trips", range(24)),
        "pivot_borough_hour": lambda: pivot_counts(Q.q17(t, p), "borough", "hour_slot", "avg_speed_mph", range(24)),
        "unpivot_payment": lambda: unpivot_measures(Q.q14(t, p), "payment_type_key",
                                                    ["total_trips", "total_revenue", "avg_tip_pct"]),
        "route_edges": lambda: route_edges(Q.q20(t, p)),
    }


RESHAPED = ("pivot_month_borough", "pivot_dow_hour", "pivot_borough_hour", "unpivot_payment", "route_edges")
