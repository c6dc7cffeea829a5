"""Calendar and cast expressions with the reference's semantics.

All return Columns, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabflow.functions._col import col


def pg_int(c) -> Column:
    """double -> int rounding half to even (as ``::int`` does), not truncating."""
    return F.rint(col(c)).cast("int")


_EPOCH = date(1970, 1, 1)


def wall_micros(ts) -> Column:
    """Microseconds from 1970-01-01 00:00 to a TIMESTAMP_NTZ wall-clock value,
    built from its calendar fields.  (``timestamp_diff`` on TIMESTAMP_NTZ
    goes through the session time zone, so a trip spanning a DST change
    would lose or gain an hour.)"""
    t = col(ts)
    days = F.datediff(t.cast("date"), F.lit(_EPOCH)).cast("long")
    secs = F.hour(t).cast("long") * 3600 + F.minute(t).cast("long") * 60
    micros = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return (days * 86400 + secs) * 1_000_000 + micros


def duration_minutes(start, end) -> Column:
    """epoch(end - start) / 60.0 as double, time-zone free."""
    return (wall_micros(end) - wall_micros(start)) / F.lit(60_000_000.0)


def date_key(d) -> Column:
    """YYYYMMDD as int, by arithmetic rather than string formatting."""
    d = col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def day_of_week_sun0(d) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's dayofweek is 1 = Sunday)."""
    return F.dayofweek(col(d)) - 1


def time_key(ts) -> Column:
    """HHMM as int."""
    ts = col(ts)
    return F.hour(ts) * 100 + F.minute(ts)


def time_period(hour) -> Column:
    h = col(hour)
    return (F.when(h.between(5, 11), "morning")
            .when(h.between(12, 16), "afternoon")
            .when(h.between(17, 21), "evening")
            .otherwise("night"))


def month_of_text(s) -> Column:
    """'YYYY-MM' text -> first day of that month; NULL when malformed."""
    return F.try_to_date(col(s), "yyyy-MM")


def ntz_literal(ts) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal, independent of the session and
    Python time zones (a datetime literal would pass through both)."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
