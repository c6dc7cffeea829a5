"""S1/ST1: the landing files and their footers, as a table.

One distributed job reads the footer of every *new* landing file; the manifest
keeps path, slice, size, time, row count and schema of each, so a file is
opened for its schema once in its life and no Spark job is run per file.  The
same table tells which files arrived since the last run.  Files that vanished
from a listed slice leave it, so it never holds more than the landing does,
and nothing of it is kept on the driver.
"""

from __future__ import annotations

import hashlib
import io
import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.session import scratch_path
from cabflow.sinks.versioned import VersionedTable

# the footer job's few functions travel with it: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SLICE = r"/([^/]+)/source_month=([^/]+)/[^/]+$"
_LISTED = "path string, service_type string, source_month string, length long, modified timestamp"
_FOOTER = f"{_LISTED}, row_count long, schema_id string, schema string"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("service_type", T.StringType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("schema_id", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("arrived_in", T.LongType()),
])
_FILE = ["path", "length", "modified"]

# Spark's reading of unsigned integers (the next wider type).
_UNSIGNED = {pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(),
             pa.uint64(): T.DecimalType(20, 0)}
_OWN_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def list_files(spark: SparkSession, landing: str, services=None, months=None, content: bool = False) -> DataFrame:
    """One row per Parquet file ``landing/<service>/source_month=<month>/*``:
    listed, not opened, unless ``content`` asks for the bytes.  Missing and
    empty folders give none."""
    def one_of(values):
        return "{" + ",".join(values) + "}" if values else "*"

    empty = spark.createDataFrame([], _LISTED + (", content binary" if content else ""))
    if (services is not None and not list(services)) or (months is not None and not list(months)):
        return empty
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(f"{landing.rstrip('/')}/{one_of(services)}/source_month={one_of(months)}"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty
        raise
    return files.select("path", F.regexp_extract("path", _SLICE, 1).alias("service_type"),
                        F.regexp_extract("path", _SLICE, 2).alias("source_month"), "length",
                        F.col("modificationTime").alias("modified"), *(["content"] if content else []))


def _opened(path: str):
    """A file that Arrow opens by itself: local or in a store it knows."""
    import pyarrow.fs

    fs, inner = pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and
                                               not path.startswith("file:///") else path)
    return fs.open_input_file(inner)


def _can_open(landing: str) -> bool:
    """Whether Arrow knows the landing's file system; if not, Spark hands the
    bytes of new files over instead."""
    if "://" not in landing and not landing.startswith("file:"):
        return landing.startswith("/")
    return landing.split(":", 1)[0] in ("file", "s3", "gs", "abfs", "abfss")


def spark_schema(meta) -> T.StructType:
    """The schema Spark reads a file by: the one Spark wrote into it, or else
    the columns of the footer as Spark takes them."""
    own = (meta.metadata or {}).get(_OWN_SCHEMA)
    if own:
        return T.StructType.fromJson(json.loads(own)).toNullable()
    from pyspark.sql.pandas.types import from_arrow_type

    physical = {meta.schema.column(i).path: meta.schema.column(i).physical_type for i in range(meta.num_columns)}
    fields = []
    for f in meta.schema.to_arrow_schema():
        if physical.get(f.name) == "INT96":
            t: T.DataType = T.TimestampType()
        else:
            t = _UNSIGNED.get(f.type) or from_arrow_type(f.type, prefer_timestamp_ntz=True)
        fields.append(T.StructField(f.name, t))
    return T.StructType(fields)


def footers(files: DataFrame) -> DataFrame:
    """Row count and schema of each listed file, read by the tasks; files of
    one schema share its id."""
    columns = files.columns
    has_content = "content" in columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            rows, ids, schemas = [], [], []
            for i in range(b.num_rows):
                path = b.column(0)[i].as_py()
                try:
                    source = io.BytesIO(b.column(5)[i].as_py()) if has_content else _opened(path)
                    with source:
                        meta = pq.ParquetFile(source).metadata
                    text = spark_schema(meta).json()
                except Exception as e:
                    raise ValueError(f"unreadable footer of {path}: {e}") from e
                rows.append(meta.num_rows)
                schemas.append(text)
                ids.append(hashlib.sha256(text.encode()).hexdigest()[:16])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(rows, pa.int64()), pa.array(ids, pa.string()), pa.array(schemas, pa.string())],
                names=[*columns[:5], "row_count", "schema_id", "schema"])

    return files.mapInArrow(run, _FOOTER)


def read_footers(spark: SparkSession, landing: str, services=None, months=None) -> DataFrame:
    """Footers of all files of the slices asked for."""
    return footers(list_files(spark, landing, services, months, content=not _can_open(landing)))


class Manifest:
    """The persisted manifest of a landing area, keyed by nothing: a row a file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path)

    def read(self) -> DataFrame:
        return self.table.read(MANIFEST_SCHEMA)

    def changes(self, landing: str, services=None, months=None) -> Changes:
        """What the landing holds beyond the manifest, in the slices asked for
        (all if None); not recorded before ``Changes.publish``."""
        spark = self.spark
        state = self.table.state()
        number = state["version"] + 1 if state else 1
        known = self.read()
        listed = list_files(spark, landing, services, months)
        new = listed.join(known.select(*_FILE), _FILE, "left_anti").select(*listed.columns)
        if not _can_open(landing):  # the bytes of the new files alone
            held = list_files(spark, landing, services, months, content=True).select(*_FILE, "content")
            new = new.join(held, _FILE).select(*listed.columns, "content")
        path = scratch_path(spark, "arrivals")
        footers(new).withColumn("arrived_in", F.lit(number).cast("long")).write.parquet(path)
        arrived = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
        scope = F.lit(True)
        if services is not None:
            scope = scope & F.col("service_type").isin(list(services))
        if months is not None:
            scope = scope & F.col("source_month").isin(list(months))
        kept = known.where(~scope).unionByName(known.where(scope).join(listed.select(*_FILE), _FILE, "left_semi"))
        path = scratch_path(spark, "manifest_kept")
        kept.select(*MANIFEST_SCHEMA.names).coalesce(8).write.parquet(path)
        return Changes(self, arrived, spark.read.schema(MANIFEST_SCHEMA).parquet(path), number)


class Changes:
    """Files that arrived since the manifest's version (``number`` is the next)."""

    def __init__(self, manifest: Manifest, arrived: DataFrame, kept: DataFrame, number: int):
        self.manifest, self.arrived, self._kept, self.number = manifest, arrived, kept, number

    def slices(self) -> list[tuple[str, str]]:
        """The (service, month) slices that received files: one entry a slice."""
        rows = self.arrived.select("service_type", "source_month").distinct().collect()
        return sorted((r.service_type, r.source_month) for r in rows)

    def files(self) -> DataFrame:
        """All files there are now, with their footers: the next version."""
        return self._kept.unionByName(self.arrived)

    def publish(self) -> None:
        """Record the arrivals: call it when they have been processed, so that
        a run that fails finds them again."""
        self.manifest.table.replace(self.files().coalesce(8))
        self.manifest.table.vacuum()
