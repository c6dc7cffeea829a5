"""Published tables (K8): versions, partial replacement, dead and rival writers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cabflow import storage
from cabflow.sinks import versioned
from cabflow.sinks.versioned import CommitConflict, VersionedTable, read_versioned
from cabflow.sinks.writers import write_fact

ROWS = [("2024-01", 1), ("2024-01", 2), ("2024-02", 3), ("2024-03", 4), (None, 5)]


def rows(df):
    return sorted(((r.m, r.v) for r in df.collect()), key=str)


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, "m string, v int")


def test_whole_and_partial_replacement(spark, frame, scratch):
    t = VersionedTable(spark, f"{scratch}/t", "m")
    assert t.state() is None and not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    assert rows(t.replace(frame, meta={"a": 1})) == sorted(ROWS, key=str)
    untouched = {f for f in t.read().inputFiles() if "2024-01" in f}
    new = spark.createDataFrame([("2024-02", 30)], "m string, v int")
    got = t.replace(new, values=["2024-02", "2024-03", None], meta={"b": 2})
    assert rows(got) == [("2024-01", 1), ("2024-01", 2), ("2024-02", 30)]       # 2024-03 and null had no rows left
    assert {f for f in got.inputFiles() if "2024-01" in f} == untouched
    assert t.meta() == {"a": 1, "b": 2} and t.state()["version"] == 2
    with pytest.raises(ValueError):
        t.replace(new, values=["2024-01"])
    assert rows(read_versioned(spark, f"{scratch}/t")) == rows(got)
    assert t.replace(frame.limit(0)).count() == 0 and t.read().columns == ["m", "v"]


def test_dead_writer_leaves_the_table(spark, frame, scratch):
    fact = frame.where("m is not null").select(
        F.to_date(F.concat("m", F.lit("-05"))).alias("pickup_date"), F.col("v").alias("pickup_time_key"),
        F.col("v").alias("pickup_location_key"), F.col("v").alias("dropoff_location_key"),
        F.col("v").cast("decimal(14,2)").alias("total_amount"), F.to_date(F.concat("m", F.lit("-01"))).alias("pickup_month"))
    path = f"{scratch}/fact"
    assert write_fact(fact, path, lo=date(2024, 1, 1), hi=date(2024, 4, 1)).count() == 4
    # some rows are written, then a task fails
    dying = fact.repartition(3).withColumn("pickup_time_key", F.when(F.col("pickup_time_key") == 4, F.raise_error(F.lit("dies")).cast("int"))
                                           .otherwise(F.col("pickup_time_key")))
    with pytest.raises(Exception, match="dies"):
        write_fact(dying, path)
    assert read_versioned(spark, path).count() == 4 and VersionedTable(spark, path).state()["version"] == 1
    with pytest.raises(Exception, match="dies"):
        write_fact(dying, path, months=["2024-01-01", "2024-02-01", "2024-03-01"])
    assert write_fact(fact.where("pickup_time_key > 4"), path, months=["2024-03-01"]).count() == 3


def test_rival_writers(spark, frame, scratch, monkeypatch):
    a, b = VersionedTable(spark, f"{scratch}/t", "m"), VersionedTable(spark, f"{scratch}/t", "m")
    a.replace(frame)
    before = b.state()
    a.replace(frame.where("v = 1"))
    monkeypatch.setattr(b, "state", lambda: before)
    with pytest.raises(CommitConflict):
        b.replace(frame)
    assert rows(a.read()) == [("2024-01", 1)]
    assert len([n for n, _, d in storage.names(spark, f"{scratch}/t") if d and n.startswith("version=")]) == 2


def test_vacuum_keeps_what_is_read(spark, frame, scratch, monkeypatch):
    t = VersionedTable(spark, f"{scratch}/t", "m")
    t.replace(frame)
    for v in (10, 20, 30):
        t.replace(spark.createDataFrame([("2024-02", v)], "m string, v int"), values=["2024-02"])
    earlier = t.read()
    spark.createDataFrame([("x", 1)], "m string, v int").write.parquet(f"{scratch}/t/version=9-dead")
    gone = t.vacuum(keep=2)
    assert len(gone) == 2 and len(t._numbers()) == 2          # the first 2024-02 and the one with 10
    want = sorted([r for r in ROWS if r[0] != "2024-02"] + [("2024-02", 30)], key=str)
    assert rows(earlier) == rows(t.read()) == want
    assert any(n == "version=9-dead" for n, _, _ in storage.names(spark, f"{scratch}/t"))
    monkeypatch.setattr(versioned, "ORPHAN_SECONDS", -10)
    assert t.vacuum(keep=2) == ["version=9-dead"] and rows(t.read()) == want
