"""ST1: process newly arrived slice files once, safely rerunnable.

A landing ``Manifest`` under the checkpoint tells which files are new: one row
a landing file, in a table, none of it on the driver.  New files become packs
in an arrival log, which a Structured Streaming query drains (trigger
availableNow): a pack names files of one slice, so a micro-batch tells which
(service, month) slices received files.  The batch function re-reads those
slices whole from their raw folders, each file by the footer schema the
manifest holds, and replaces them in bronze with a dynamic partition overwrite.
Only then are the arrivals recorded, so a run that dies finds them again.

So a slice spread over several micro-batches, a redelivered slice (new file
names, newest delivery wins), files older than others seen before, and a run
with nothing new all leave the bronze counts right.  Trips have no natural key,
so rows are never de-duplicated.

State stays bounded by what is open: drained log files are deleted by the
stream source, whose own record of them ages out, and files that left the
landing leave the manifest.  ``months`` keeps closed months from being listed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.bronze import bronze_trips
from cabflow.sinks.writers import replace_slice
from cabflow.sources.manifest import Changes, Manifest
from cabflow.sources.trips import read_trips

_LOG_SCHEMA = T.StructType([
    T.StructField("service_type", T.StringType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("path", T.StringType()),
])


def landing_manifest(spark: SparkSession, checkpoint: str) -> Manifest:
    """The manifest a checkpoint folder keeps of its landing."""
    return Manifest(spark, f"{checkpoint.rstrip('/')}/manifest")


def log_arrivals(changes: Changes, log: str, max_files: int | None = None) -> None:
    """Append the new files to the arrival log as packs: of one slice and at
    most ``max_files`` files each, or all in one."""
    new = changes.arrived.select(*_LOG_SCHEMA.names)
    if max_files:
        turn = F.row_number().over(Window.partitionBy("service_type", "source_month").orderBy("path")) - 1
        new = new.withColumn("pack", F.concat_ws("_", "service_type", "source_month", F.floor(turn / max_files)))
    else:
        new = new.withColumn("pack", F.lit("all"))
    (new.withColumn("version", F.lit(changes.number)).repartition("pack").write.mode("append")
        .partitionBy("version", "pack").parquet(log))


def arrivals(spark: SparkSession, log: str, packs_per_batch: int | None = None) -> DataFrame:
    """Streaming frame of (service_type, source_month, path) over the log."""
    reader = spark.readStream.schema(_LOG_SCHEMA).option("cleanSource", "delete")
    if packs_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(packs_per_batch))
    return reader.parquet(f"{log}/version=*/pack=*").select(*_LOG_SCHEMA.names)


def ingest_available(spark: SparkSession, landing: str, bronze_path: str, checkpoint: str,
                     ingest_ts: datetime, max_files_per_trigger: int | None = None, months=None):
    """Run once over everything not yet processed (trigger availableNow) and
    return the finished StreamingQuery, or None when nothing ever arrived.
    ``max_files_per_trigger`` bounds the files per micro-batch (availableNow
    still drains everything); ``months`` restricts the run to these months."""
    root = checkpoint.rstrip("/")
    log = f"{root}/arrivals"
    manifest = landing_manifest(spark, root)
    changes = manifest.changes(landing, months=months)
    if changes.slices():
        log_arrivals(changes, log, max_files_per_trigger)
    elif not manifest.table.exists():
        return None
    current = changes.files()

    def process(batch: DataFrame, epoch_id: int) -> None:
        # One row per slice touched by this micro-batch: a bounded set.
        touched = batch.select("service_type", "source_month").distinct().collect()
        for service in sorted({r.service_type for r in touched}):
            of_service = sorted({r.source_month for r in touched if r.service_type == service})
            raw = read_trips(spark, landing, [service], of_service, ingest_ts, manifest=current)
            replace_slice(bronze_trips(raw), bronze_path)

    q = (arrivals(spark, log, 1 if max_files_per_trigger else None).writeStream
         .foreachBatch(process)
         .option("checkpointLocation", f"{root}/stream")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    changes.publish()
    return q
