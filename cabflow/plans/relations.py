"""Relations by name.

A *source* is an input that exists; a *model* is a relation built from others,
which it names.  ``ref`` resolves a name: what it needs is built first, in
lineage order and once each, every model the way its kind says (``table``,
``view``, ``incremental``), and the frame reads the built relation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators.bronze import bronze_trips
from cabflow.operators.dims import dim_date, dim_service_type, dim_time, dim_zone, dimension_domains
from cabflow.operators.fact import fct_trips
from cabflow.operators.silver import silver_trips
from cabflow.params import Params
from cabflow.schemas import STATIC_DIMS
from cabflow.sinks.writers import SLICE_KEYS, materialize
from cabflow.sources.generators import static_dim


class UnknownRelation(KeyError):
    """No source or model has this name."""


class LineageCycle(ValueError):
    """A model needs itself."""


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    needs: tuple[str, ...]
    kind: str
    keys: tuple[str, ...] = ()


class Relations:
    """Names resolved to frames; models are written below ``base`` or, as
    views, registered under ``prefix`` and their name."""

    def __init__(self, spark: SparkSession, base: str, prefix: str = "cabflow_"):
        self.spark, self.base, self.prefix = spark, base, prefix
        self._sources: dict[str, DataFrame | Callable[[], DataFrame]] = {}
        self._models: dict[str, Model] = {}
        self._built: dict[str, DataFrame] = {}

    def _free(self, name: str) -> None:
        if name in self._sources or name in self._models:
            raise ValueError(f"relation {name!r} is declared twice")

    def source(self, name: str, frame: DataFrame | Callable[[], DataFrame]) -> None:
        """An input: a frame, or how to open it when it is first needed."""
        self._free(name)
        self._sources[name] = frame

    def model(self, name: str, build: Callable[..., DataFrame], needs=(), kind: str = "table", keys=()) -> None:
        """``build`` takes the frames of ``needs`` in their order."""
        self._free(name)
        if kind not in ("table", "view", "incremental"):
            raise ValueError(f"unknown materialization {kind!r}")
        self._models[name] = Model(build, tuple(needs), kind, tuple(keys))

    def lineage(self, name: str) -> list[str]:
        """All that ``name`` rests on and itself, needs before users."""
        order: list[str] = []
        done: set[str] = set()
        path: list[str] = []

        def visit(n: str) -> None:
            if n in done:
                return
            if n in path:
                raise LineageCycle(" -> ".join([*path[path.index(n):], n]))
            if n not in self._sources and n not in self._models:
                raise UnknownRelation(n)
            path.append(n)
            for need in self._models[n].needs if n in self._models else ():
                visit(need)
            path.pop()
            done.add(n)
            order.append(n)

        visit(name)
        return order

    def ref(self, name: str) -> DataFrame:
        """The relation, built with all it needs where that has not happened yet."""
        for n in self.lineage(name):
            if n in self._built:
                continue
            if n in self._sources:
                made = self._sources[n]
                self._built[n] = made() if callable(made) else made
                continue
            m = self._models[n]
            df = m.build(*[self._built[need] for need in m.needs])
            if m.kind == "view":
                self._built[n] = materialize(df, f"{self.prefix}{n}", "view")
            else:
                self._built[n] = materialize(df, n, m.kind, base=self.base, keys=m.keys or None)
        return self._built[name]

    def rebuild(self, name: str) -> DataFrame:
        """Build ``name`` again, and whatever rests on it when next asked for."""
        stale = {n for n in self._built if name in self.lineage(n)}
        for n in stale:
            if n in self._models:
                del self._built[n]
        return self.ref(name)


def gold_relations(spark: SparkSession, base: str, raw_trips: DataFrame | Callable[[], DataFrame],
                   zones: DataFrame | Callable[[], DataFrame], params: Params) -> Relations:
    """The medallion's relations by the reference's names and kinds: bronze
    incremental by slice, silver a view, gold tables."""
    r = Relations(spark, base)
    r.source("raw.trips", raw_trips)
    r.source("raw.zones", zones)
    r.model("bronze_trips", bronze_trips, ["raw.trips"], "incremental", SLICE_KEYS)
    r.model("bronze_zones", lambda z: z, ["raw.zones"])
    r.model("silver_trips", lambda t, z: silver_trips(t, z, params), ["bronze_trips", "bronze_zones"], "view")
    r.model("dimension_domains", dimension_domains, ["silver_trips"])
    r.model("dim_date", lambda d: dim_date(d, params), ["dimension_domains"])
    r.model("dim_time", lambda d: dim_time(d, params), ["dimension_domains"])
    r.model("dim_zone", dim_zone, ["dimension_domains"])
    r.model("dim_service_type", dim_service_type, ["dimension_domains"])
    for name in STATIC_DIMS:
        r.model(name, lambda n=name: static_dim(spark, n))
    dims = ["dim_date", "dim_time", "dim_zone", "dim_service_type", *STATIC_DIMS]
    r.model("fct_trips", lambda s, *d: fct_trips(s, dict(zip(dims, d, strict=True)), params), ["silver_trips", *dims],
            "incremental", ["pickup_month"])
    return r
