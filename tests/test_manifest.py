"""Landing manifest (S1, ST1): footers by one job, arrivals, schemas as Spark reads them."""

import glob
import os
import uuid
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cabflow.sources import manifest as M
from cabflow.sources.manifest import Manifest, read_footers
from cabflow.sources.trips import read_trips

TS = datetime(2024, 1, 1)


def put(base, month, name, n=2, service="yellow", **columns):
    folder = f"{base}/{service}/source_month={month}"
    os.makedirs(folder, exist_ok=True)
    table = {"VendorID": pa.array(range(n), pa.int64()), "tpep_pickup_datetime": pa.array([TS] * n, pa.timestamp("us")),
             "passenger_count": pa.array([1.0] * n)} | columns
    pq.write_table(pa.table(table), f"{folder}/{name}.parquet")


def test_schemas_are_as_spark_reads_them(spark, scratch):
    n = 2
    put(scratch, "2024-01", "a", a=pa.array([1, 2], pa.uint32()), b=pa.array([1, 2], pa.uint8()),
        c=pa.array([TS] * n, pa.timestamp("us", "UTC")), d=pa.array([TS.date()] * n), e=pa.array([b"x"] * n),
        f=pa.array(["x", None]).dictionary_encode(), g=pa.array([[1], [2]]), h=pa.array([True, None]),
        i=pa.array([1, 2], pa.decimal128(14, 2)), j=pa.array([1.5, 2], pa.float32()))
    folder = f"{scratch}/yellow/source_month=2024-02"
    spark.range(3).selectExpr("id", "cast(id as int) i", "timestamp'2024-01-01' t", "timestamp_ntz'2024-01-01' n",
                              "cast(id as decimal(9,3)) d", "named_struct('x', id) s").coalesce(1).write.parquet(folder)
    pq.write_table(pa.table({"t": pa.array([TS], pa.timestamp("ns"))}), f"{folder}/int96.parquet", use_deprecated_int96_timestamps=True)
    found = read_footers(spark, scratch).collect()
    assert len(found) == 3
    for r in found:
        own = spark.read.parquet(r.path)
        assert [(f.name, f.dataType) for f in own.schema] == \
            [(f.name, f.dataType) for f in M.T.StructType.fromJson(M.json.loads(r.schema))], r.path
        assert own.count() == r.row_count


def jobs(spark, fn):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        fn()
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_job_count_does_not_grow_with_files(spark, scratch):
    for m in range(1, 13):
        for i in range(20):
            for base in ("few", "many")[i // 10:]:
                put(f"{scratch}/{base}", f"2024-{m:02d}", f"f{i}", **({"tip_amount": pa.array([1.0] * 2)} if i else {}))
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    counts = [jobs(spark, lambda b=b: read_trips(spark, f"{scratch}/{b}", ["yellow"], months, TS)) for b in ("few", "many")]
    assert counts[0] == counts[1] <= 4     # listings and one footer job
    assert read_trips(spark, f"{scratch}/many", ["yellow"], months, TS).count() == 480


@pytest.mark.parametrize("own_reader", [True, False])
def test_arrivals(spark, scratch, monkeypatch, own_reader):
    if not own_reader:   # a store that only Spark reads
        monkeypatch.setattr(M, "_can_open", lambda landing: False)
    landing = f"{scratch}/landing"
    m = Manifest(spark, f"{scratch}/manifest")
    assert m.changes(landing).slices() == []
    put(landing, "2024-01", "a")
    put(landing, "2024-02", "a", n=5)
    put(landing, "2024-02", "a", service="green")
    first = m.changes(landing)
    assert first.slices() == [("green", "2024-02"), ("yellow", "2024-01"), ("yellow", "2024-02")]
    assert m.changes(landing).slices() == first.slices()        # not recorded yet
    first.publish()
    assert m.changes(landing).slices() == []
    put(landing, "2024-02", "b", n=3)                            # one more file
    for f in glob.glob(f"{landing}/yellow/source_month=2024-01/*"):
        os.remove(f)
    put(landing, "2024-01", "new")                               # redelivered under a new name
    put(landing, "2024-03", "a")
    assert m.changes(landing, months=["2024-02"]).slices() == [("yellow", "2024-02")]
    c = m.changes(landing, services=["yellow"], months=["2024-01", "2024-02"])
    assert c.slices() == [("yellow", "2024-01"), ("yellow", "2024-02")]
    c.publish()
    have = m.read().collect()
    assert sorted((r.service_type, r.source_month, r.path.rsplit("/", 1)[1], r.row_count) for r in have) == [
        ("green", "2024-02", "a.parquet", 2), ("yellow", "2024-01", "new.parquet", 2),
        ("yellow", "2024-02", "a.parquet", 5), ("yellow", "2024-02", "b.parquet", 3)]
    assert m.changes(landing).slices() == [("yellow", "2024-03")]


def test_manifest_spares_the_footers(spark, scratch, monkeypatch):
    landing = f"{scratch}/landing"
    put(landing, "2024-01", "a")
    m = Manifest(spark, f"{scratch}/manifest")
    m.changes(landing).publish()
    import cabflow.sources.trips as trips
    monkeypatch.setattr(trips, "read_footers", lambda *a: pytest.fail("footers were read again"))
    assert read_trips(spark, landing, ["yellow"], ["2024-01", "2024-09"], TS, manifest=m.read()).count() == 2


def test_unreadable_file_is_named(spark, scratch):
    put(scratch, "2024-01", "a")
    with open(f"{scratch}/yellow/source_month=2024-01/broken.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        read_trips(spark, scratch, ["yellow"], ["2024-01"], TS)
