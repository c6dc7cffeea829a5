"""Monthly trip slices, the zone lookup CSV, plain CSV."""

from __future__ import annotations

import json
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.functions.calendar import ntz_literal
from cabflow.schemas import GREEN_RENAMES, LINEAGE_FIELDS, RAW_TRIP_SCHEMA, ZONE_CSV_SCHEMA
from cabflow.sources.manifest import read_footers

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def slice_path(base: str, service: str, month: str) -> str:
    """Path template of one (service, month) slice."""
    return f"{base.rstrip('/')}/{service}/source_month={month}"


def _cast_to(c: str, src: T.DataType, dst: T.DataType):
    col = F.col(c)
    if isinstance(dst, _INTEGRAL) and isinstance(src, _FRACTIONAL):
        # integral codes stored as double: round half to even, as ::int does;
        # NaN, infinities and values beyond the type are missing
        return F.rint(col).try_cast(dst)
    return col.cast(dst)


def conform_slice(df: DataFrame, service: str, month,
                  ingest_ts: datetime) -> DataFrame:
    """Cast one slice to the canonical raw schema (P1, P2, per-file casts).

    Each file is conformed on its own footer schema before any union, because
    the same column may be bigint in one month and double in another.
    Columns outside the canonical list are carried as they are.  Built as a
    single projection from the footer schema (one analysis per slice).
    ``month`` is the slice's month as text, or a Column holding it (for a
    merged read of several slices).
    """
    have: dict[str, tuple[str, T.DataType]] = {}
    for f in df.schema.fields:
        name = f.name.lower()
        name = GREEN_RENAMES.get(name, name)
        have.setdefault(name, (f.name, f.dataType))
    cols = []
    for f in RAW_TRIP_SCHEMA.fields:
        if f.name in have:
            src, t = have[f.name]
            cols.append(_cast_to(f"`{src}`", t, f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    cols += [F.lit(service).alias("service_type"),
             (month.cast("string") if isinstance(month, Column) else F.lit(month)).alias("source_month"),
             ntz_literal(ingest_ts).alias("ingest_ts")]
    known = {f.name for f in RAW_TRIP_SCHEMA.fields} | {"service_type", "source_month", "ingest_ts"}
    cols += [F.col(f"`{src}`").alias(name) for name, (src, _) in have.items() if name not in known]
    return df.select(*cols)


def _kinds(found: DataFrame) -> list[tuple[str, T.StructType, list[str]]]:
    """(service, schema, paths) of the files, one entry per service and footer
    schema: one job, whose result has a path a file.  A folder whose files all
    agree is given as one path."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    rows = (found.withColumn("folder", folder).groupBy("service_type", "schema_id", "folder")
            .agg(F.first("schema").alias("schema"), F.sort_array(F.collect_list("path")).alias("paths")).collect())
    kinds_of: dict[str, int] = {}
    for r in rows:
        kinds_of[r.folder] = kinds_of.get(r.folder, 0) + 1
    out: dict[tuple[str, str], tuple[T.StructType, list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r.service_type, r.schema_id, r.folder)):
        if (r.service_type, r.schema_id) not in out:
            out[r.service_type, r.schema_id] = (T.StructType.fromJson(json.loads(r.schema)), [])
        out[r.service_type, r.schema_id][1].extend([r.folder] if kinds_of[r.folder] == 1 else r.paths)
    return [(service, *kind) for (service, _), kind in out.items()]


def _read(spark: SparkSession, base: str, found: DataFrame, ingest_ts: datetime) -> list[DataFrame]:
    """One scan per service and footer schema, each with that schema given,
    whatever the number of files and months, so files that do not agree never
    meet in one schema merge.  The months come from the folder names."""
    return [conform_slice(spark.read.schema(schema).option("basePath", f"{base.rstrip('/')}/{service}").parquet(*paths),
                          service, F.col("source_month"), ingest_ts)
            for service, schema, paths in _kinds(found)]


def read_slice(spark: SparkSession, base: str, service: str, month: str,
               ingest_ts: datetime) -> DataFrame | None:
    """One slice, or None when it has no file (coverage marks it ``missing``).
    Any other read error propagates (D9)."""
    parts = _read(spark, base, read_footers(spark, base, [service], [month]), ingest_ts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def read_trips(spark: SparkSession, base: str, services, months,
               ingest_ts: datetime, manifest: DataFrame | None = None) -> DataFrame:
    """S1 + P1 + P2 + U2: every existing (service, month) slice, conformed and
    stacked with ``unionByName(allowMissingColumns=True)``.

    The footers come from ``manifest`` (rows of a ``Manifest``, its files still
    there) or are read by one job over all files."""
    services, months = sorted(set(services)), sorted(set(months))
    if manifest is None:
        found = read_footers(spark, base, services, months)
    else:
        found = manifest.where(F.col("service_type").isin(services) & F.col("source_month").isin(months))
    parts = _read(spark, base, found, ingest_ts)
    if not parts:
        schema = T.StructType(list(RAW_TRIP_SCHEMA.fields) + LINEAGE_FIELDS)
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Texts read as missing in CSV cells (the reader the reference
# uses takes them so by default).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _present(c: str) -> Column:
    """The cell's text, or NULL where it stands for a missing value."""
    return F.when(~F.trim(F.col(f"`{c}`")).isin(*MISSING_TOKENS), F.col(f"`{c}`"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """S3: any CSV with a header; missing-value tokens become NULL, then each
    column is cast to the schema's type (no schema: text)."""
    df = spark.read.csv(path, header=True)
    if schema is None:
        return df.select(*[_present(c).alias(c) for c in df.columns])
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = {c.lower(): c for c in df.columns}
    return df.select(*[_present(names[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header (LocationID, Borough, Zone, service_zone)."""
    return read_csv(spark, path, ZONE_CSV_SCHEMA)
