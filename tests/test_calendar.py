"""Calendar helpers cross-checked against DuckDB on the events table
(microsecond timestamps over a month)."""

import duckdb
from pyspark.sql import functions as F

from cabflow.functions.calendar import (
    date_key, day_of_week_sun0, duration_minutes, time_key, time_period,
)
from tests.conftest import SF01


def test_calendar_functions_match_duckdb(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    first = ev.agg(F.min("ts")).first()[0]
    got = ev.select(
        "event_id",
        date_key(F.col("ts").cast("date")).alias("dk"),
        day_of_week_sun0(F.col("ts").cast("date")).alias("dow"),
        F.weekofyear(F.col("ts").cast("date")).alias("wk"),
        time_key("ts").alias("tk"),
        time_period(F.hour("ts")).alias("tp"),
        duration_minutes(F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz"), "ts").alias("mins"),
    )
    spark_rows = {r.event_id: (r.dk, r.dow, r.wk, r.tk, r.tp, r.mins) for r in got.collect()}
    con = duckdb.connect()
    duck_rows = con.execute(f"""
        SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INT), dayofweek(ts), weekofyear(ts),
               hour(ts) * 100 + minute(ts),
               CASE WHEN hour(ts) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 16 THEN 'afternoon'
                    WHEN hour(ts) BETWEEN 17 AND 21 THEN 'evening' ELSE 'night' END,
               CAST(date_diff('microsecond', TIMESTAMP '{first.isoformat(sep=" ")}', ts) AS DOUBLE) / 60000000.0
        FROM read_parquet('{SF01}/events.parquet')""").fetchall()
    assert len(duck_rows) == len(spark_rows) > 0
    for eid, *vals in duck_rows:
        assert spark_rows[eid] == tuple(vals), eid
