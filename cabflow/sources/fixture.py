"""Adapter from the test tables to trip-shaped inputs.

One trip per lineitem row; every dirty case silver must handle occurs in it
(see FIXTURES.md section 3).  ``raw_trips`` is what a monthly landing file
holds; ``write_landing`` lays it out as one folder per (service, month) slice,
green slices with ``lpep_*`` names and one slice with schema drift.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.calendar import ntz_literal
from cabflow.schemas import MONEY

FIXTURE_TABLES = ("lineitem", "orders", "part", "supplier", "customer", "nation", "region")
FIXTURE_INGEST_TS = datetime(2026, 1, 1)
# The slice written with drifted types and an extra column.
DRIFT_SERVICE, DRIFT_MONTH = "yellow", "1996-06"


def load_tables(spark: SparkSession, sf_dir: str, names=FIXTURE_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def trips_view(t: dict[str, DataFrame]) -> DataFrame:
    """Typed, bronze-named trips (FIXTURES.md section 3), without duration.

    Customers meet the orders before these meet the trips: where customers
    outgrow a broadcast, the orders are dealt by customer, not the trips."""
    li, o, p, s, c = t["lineitem"], t["orders"], t["part"], t["supplier"], t["customer"]
    j = (li.join(o.join(c, F.col("c_custkey") == F.col("o_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(p, F.col("p_partkey") == F.col("l_partkey"))
         .join(s, F.col("s_suppkey") == F.col("l_suppkey")))
    pick_off = (F.col("l_orderkey") * 17 + F.col("l_linenumber") * 61) % 1440
    drop_off = pick_off + (F.col("l_partkey") * 7 + F.col("l_linenumber") * 13) % 200 - 5
    price = F.col("l_extendedprice").cast(MONEY)
    return j.select(
        F.nullif(F.col("l_suppkey") % 4, F.lit(3)).cast("int").alias("vendor_id"),
        F.timestamp_add("MINUTE", pick_off.cast("int"), F.col("o_orderdate")).alias("pickup_ts"),
        F.timestamp_add("MINUTE", drop_off.cast("int"), F.col("o_orderdate")).alias("dropff_ts"),
        F.nullif(F.col("p_size"), F.lit(13)).alias("passengers_count"),
        (F.col("l_quantity") - 1).cast(MONEY).alias("trip_distance"),
        F.col("c_nationkey").alias("pickup_location"),
        F.col("s_nationkey").alias("dropff_location"),
        F.col("l_linenumber").alias("ratecode_id"),
        F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(5)).alias("payment_type"),
        F.when(F.col("l_quantity") == 1, F.lit(0.0)).otherwise(F.col("l_extendedprice")).cast(MONEY).alias("fare_amount"),
        (price * F.col("l_discount").cast("decimal(4,2)")).cast(MONEY).alias("tip_amount"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("tolls_amount"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).cast(MONEY).alias("total_amount"),
        F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green").alias("service_type"),
        F.date_format(F.when(F.col("l_linenumber") == 7, F.col("l_shipdate"))
                      .otherwise(F.col("o_orderdate")), "yyyy-MM").alias("source_month"),
        ntz_literal(FIXTURE_INGEST_TS).alias("ingest_ts"),
    )


def raw_trips(t: dict[str, DataFrame]) -> DataFrame:
    """The same trips as a raw landing file stores them: raw names, codes and
    money as double, lineage columns stamped."""
    v = trips_view(t)
    return v.select(
        F.col("vendor_id").alias("vendorid"),
        F.col("pickup_ts").alias("tpep_pickup_datetime"),
        F.col("dropff_ts").alias("tpep_dropoff_datetime"),
        F.col("passengers_count").cast("double").alias("passenger_count"),
        F.col("trip_distance").cast("double"),
        F.col("ratecode_id").cast("double").alias("ratecodeid"),
        F.col("pickup_location").alias("pulocationid"),
        F.col("dropff_location").alias("dolocationid"),
        F.col("payment_type").cast("double"),
        F.col("fare_amount").cast("double"),
        F.col("tip_amount").cast("double"),
        F.col("tolls_amount").cast("double"),
        F.col("total_amount").cast("double"),
        "service_type", "source_month", "ingest_ts",
    )


def zones_view(t: dict[str, DataFrame]) -> DataFrame:
    """Bronze-shaped zones: nations as zones, regions as boroughs; nation 24
    is left out so that some trips hit an unknown zone."""
    return (t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
            .where(F.col("n_nationkey") != 24)
            .select(F.col("n_nationkey").alias("location_id"),
                    F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone_name"),
                    F.lit(None).cast("string").alias("service_zone")))


def zones_csv_frame(t: dict[str, DataFrame]) -> DataFrame:
    """The zone lookup as its CSV names its columns and writes what is missing:
    ``N/A``.  Nation 24, which the lookup lacks, stands there with nothing
    known about it."""
    z = zones_view(t).unionByName(t["nation"].where(F.col("n_nationkey") == 24).select(
        (F.col("n_nationkey") + 240).alias("location_id"), F.lit(None).cast("string").alias("borough"),
        F.lit(None).cast("string").alias("zone_name"), F.lit(None).cast("string").alias("service_zone")))
    return z.select(F.col("location_id").alias("LocationID"), F.coalesce("borough", F.lit("N/A")).alias("Borough"),
                    F.coalesce("zone_name", F.lit("N/A")).alias("Zone"),
                    F.coalesce("service_zone", F.lit("N/A")).alias("service_zone"))


def by_slice(raw: DataFrame) -> DataFrame:
    """Raw trips dealt by slice, so that ``write_landing`` gives a slice as many
    files as its bytes want, not one from every task.  Split by measured bytes:
    a large slice goes to several tasks, small ones share one."""
    return raw.hint("rebalance", "service_type", "source_month")


def write_landing(raw: DataFrame, base: str) -> None:
    """Write raw trips as slice folders ``{base}/{service}/source_month=YYYY-MM``.

    Only the slices present in ``raw`` are (re)written, each replaced as a
    whole with new file names, so this also models a redelivery.  Lineage
    columns are dropped from the files (the reader stamps them).  Green files
    get ``lpep_*`` timestamp names; the drift slice stores ``pulocationid``
    as double and has an extra ``airport_fee`` column.
    """
    body = raw.drop("ingest_ts")
    is_drift = (F.col("service_type") == DRIFT_SERVICE) & (F.col("source_month") == DRIFT_MONTH)
    yellow = body.where((F.col("service_type") == "yellow") & ~is_drift).drop("service_type")
    green = (body.where(F.col("service_type") == "green").drop("service_type")
             .withColumnsRenamed({"tpep_pickup_datetime": "lpep_pickup_datetime",
                                  "tpep_dropoff_datetime": "lpep_dropoff_datetime"}))
    drift = (body.where(is_drift).drop("service_type", "source_month")
             .withColumn("pulocationid", F.col("pulocationid").cast("double"))
             .withColumn("airport_fee", F.lit(1.75)))

    def put(df: DataFrame, path: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("source_month").parquet(path))

    put(yellow, f"{base}/yellow")
    put(green, f"{base}/green")
    if not drift.isEmpty():
        drift.write.mode("overwrite").parquet(f"{base}/{DRIFT_SERVICE}/source_month={DRIFT_MONTH}")
