"""Tables published whole: versioned folders behind a commit.

    root/version=<n>-<token>/<key>=<value>/part-*.parquet
    root/_commits/<n>.json      which folder holds each partition of version n

A write goes to a folder of its own and becomes the table by one commit file,
created in one step.  A job that dies before that leaves the table as it was;
readers of the version before keep their files; of two writers that started
from one version the second one's commit is refused.  A write of some
partitions carries the others over by name, without touching their files.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cabflow import storage

_COMMITS = "_commits"
_NULL = "__HIVE_DEFAULT_PARTITION__"
#: Folders no commit names are a dead job's once they are this old.
ORPHAN_SECONDS = 24 * 3600


class CommitConflict(RuntimeError):
    """Another writer published a version first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, key: str | None = None):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key

    # ------------------------------------------------------------- commits
    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _, _ in storage.names(self.spark, f"{self.root}/{_COMMITS}")
                      if n.endswith(".json") and not n.startswith("."))

    def _commit(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.root}/{_COMMITS}/{number:010d}.json"))

    def state(self) -> dict | None:
        """The current commit: version, parts (partition folder -> folder that
        holds it), schema, meta; None before the first."""
        have = self._numbers()
        return self._commit(have[-1]) if have else None

    def exists(self) -> bool:
        return bool(self._numbers())

    def meta(self) -> dict:
        state = self.state()
        return state["meta"] if state else {}

    def part(self, value) -> str:
        """Name of the folder of a partition value."""
        return f"{self.key}={_NULL if value is None else value}"

    # ------------------------------------------------------------- reading
    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The current version (``schema`` gives the columns while none exists)."""
        state = self.state()
        if state is None:
            if schema is None:
                raise FileNotFoundError(f"no version of {self.root}")
            return self.spark.createDataFrame([], schema)
        schema = T.StructType.fromJson(state["schema"])
        if not state["parts"]:
            return self.spark.createDataFrame([], schema)
        paths = sorted(f"{self.root}/{folder}" for folder in state["parts"].values())
        return (self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
                .select(*[f"`{c}`" for c in schema.names]))

    # ------------------------------------------------------------- writing
    def replace(self, df: DataFrame, values=None, meta: dict | None = None) -> DataFrame:
        """Publish ``df`` as the whole table or, with ``values``, as the
        partitions of these key values: the ones ``df`` has rows of are
        replaced, the others of ``values`` disappear, all else stays.  Returns
        a frame reading the new version."""
        before = self.state()
        number = before["version"] + 1 if before else 1
        folder = f"version={number}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("errorifexists").option("partitionOverwriteMode", "static")
        (writer.partitionBy(self.key) if self.key else writer).parquet(f"{self.root}/{folder}")
        if self.key:
            made = {n: f"{folder}/{n}" for n, _, is_folder in storage.names(self.spark, f"{self.root}/{folder}")
                    if is_folder and n.startswith(f"{self.key}=")}
        else:
            made = {"": folder}
        parts = dict(made)
        if values is not None:
            asked = {self.part(v) for v in values}
            if not made.keys() <= asked:
                raise ValueError(f"rows outside the partitions asked for: {sorted(made.keys() - asked)}")
            parts = {n: f for n, f in (before["parts"] if before else {}).items() if n not in asked} | made
        carried = (before["meta"] if before else {}) | (meta or {})
        # partition columns come last when read back: keep the frame's own order
        schema = json.loads(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]).json())
        text = json.dumps({"version": number, "parts": parts, "schema": schema, "meta": carried})
        try:
            storage.create_whole(self.spark, f"{self.root}/{_COMMITS}/{number:010d}.json", text)
        except storage.AlreadyThere:
            storage.delete(self.spark, f"{self.root}/{folder}")
            raise CommitConflict(f"version {number} of {self.root} was published by another writer") from None
        return self.read()

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the commits before the last ``keep`` with the folders only
        they name, and what dead jobs left; returns the deleted folders."""
        numbers = self._numbers()
        last = numbers[-max(1, keep):]
        live = {f for n in last for f in self._commit(n)["parts"].values()}
        gone, named = [], set(live)
        for n in numbers[:-max(1, keep)]:
            old = set(self._commit(n)["parts"].values())
            gone += sorted(old - named)
            named |= old
            storage.delete(self.spark, f"{self.root}/{_COMMITS}/{n:010d}.json")
        roots = {f.split("/")[0] for f in live}
        for name, changed, is_folder in storage.names(self.spark, self.root):
            if not is_folder or not name.startswith("version=") or name in roots:
                continue
            if any(f.split("/")[0] == name for f in gone) or changed < (time.time() - ORPHAN_SECONDS) * 1000:
                gone = [f for f in gone if f.split("/")[0] != name] + [name]
        for folder in gone:
            storage.delete(self.spark, f"{self.root}/{folder}")
        return gone


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a published table."""
    return VersionedTable(spark, root).read()
