"""Column-level helpers (calendar, casts, predicates)."""

from cabflow.functions.calendar import (  # noqa: F401
    date_key, day_of_week_sun0, duration_minutes, month_of_text, pg_int,
    time_key, time_period,
)
from cabflow.functions.predicates import pickup_range  # noqa: F401
