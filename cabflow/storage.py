"""Small metadata operations on any file system Spark reaches (Hadoop's file
system layer, driver side; data is only ever read and written by Spark jobs)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(FileExistsError):
    """The file a commit wanted to create exists."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name


def names(spark: SparkSession, folder: str) -> list[tuple[str, int, bool]]:
    """(name, modification time in ms, is a folder) of what a folder holds,
    by name; nothing for a folder that is not there."""
    try:
        found = _fs(spark, folder).listStatus(_path(spark, folder))
    except Py4JJavaError as e:
        if _is(e, "FileNotFoundException"):
            return []
        raise
    return sorted((s.getPath().getName(), s.getModificationTime(), s.isDirectory()) for s in found)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_whole(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with ``text`` in one step: a reader sees all of it or no
    file.  Raises ``AlreadyThere`` when the file exists."""
    folder = path.rsplit("/", 1)[0]
    half = f"{folder}/.{uuid.uuid4().hex}.tmp"
    out = _fs(spark, half).create(_path(spark, half), False)
    out.write(bytearray(text.encode()))
    out.close()
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, path).getUri(), sc._jsc.hadoopConfiguration())
    keep = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, half), _path(spark, path), keep)
    except Py4JJavaError as e:
        delete(spark, half)
        if _is(e, "FileAlreadyExistsException"):
            raise AlreadyThere(path) from None
        raise


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing if it is not there."""
    _fs(spark, path).delete(_path(spark, path), True)
