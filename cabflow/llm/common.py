"""Shared helpers: tables, scratch tables, code shipping, numpy word hashing."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabflow.session import scratch_path

#: Slices of a batch handled at once hold about this many bytes of text.
SLICE_BYTES = 2 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors once per application, by way
    of the shared checkpoint folder, so that Python tasks run wherever the job
    was submitted from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    p = os.path.join(folder, name)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    path = f"{scratch_path(spark, 'src')}/cabflow_src.zip"
    jvm_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = jvm_path.getFileSystem(sc._jsc.hadoopConfiguration()).create(jvm_path)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a new folder below the shared checkpoint folder and read back:
    lineage ends there and a lost executor costs nothing that came before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes in ``column``
    (a single longer value stays whole)."""
    for b in batches:
        if not b.num_rows:
            continue
        a = b.column(b.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(a), 0), dtype=np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
            yield b.slice(lo, hi - lo)


def emit(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array)
         else columns[f.name].cast(f.type) for f in schema], schema=schema)


_resident: list = []


def resident(key, build: Callable):
    """The large object of a worker: kept between tasks, one at a time, so
    that a worker that serves one operator after another holds only the last
    one's tables."""
    if not _resident or _resident[0] != key:
        _resident.clear()
        _resident[:] = [key, build()]
    return _resident[1]


def unsigned_crc32(col):
    return F.crc32(F.encode(col.cast("string"), "UTF-8"))


# --------------------------------------------------------------- word hashing

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    have = _pow.get("p")
    if have is None or len(have) < n:
        m = max(n, SLICE_BYTES + (1 << 16))
        for key, base in (("p", _B), ("q", _B_INV)):
            a = np.full(m, base, dtype=np.uint64)
            a[0] = 1
            _pow[key] = np.multiply.accumulate(a)
    return _pow["p"][:n], _pow["q"][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values on end and the value offsets (null: empty)."""
    a = a.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def word_bounds(data: np.ndarray, off: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of non-separator bytes inside each value."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~sep
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[s:e] for each span, by differences of one running
    polynomial sum."""
    p, q = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:len(data)], out=run[1:])
    return mix64((run[ends] - run[starts]) * q[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# ------------------------------------------------------------ added columns

def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_computed(df: DataFrame, fn: Callable, fields: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """All columns of df plus ``fields`` (name, Spark type): ``fn(texts)``
    takes a pyarrow string array and returns one list or array per field."""
    names = [n for n, _ in fields]
    if {n.lower() for n in names} & {c.lower() for c in df.columns}:
        raise ValueError("computed columns must have new names")
    spark_schema = StructType(list(df.schema.fields))
    for n, t in fields:
        spark_schema = spark_schema.add(n, t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            made = fn(b.column(b.schema.get_field_index(text)))
            arrays = [*b.columns, *(pa.array(m) if not isinstance(m, pa.Array) else m for m in made)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, *names])

    ship(df.sparkSession)
    return df.mapInArrow(run, spark_schema)


def hashed_fraction(key, seed: int):
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
