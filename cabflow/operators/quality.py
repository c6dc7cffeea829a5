"""Declarative data-quality tests.

Column tests of one table (not_null, accepted_values, expression_is_true)
run as ONE aggregate over that table; each relationship test is an anti join
of the child's distinct keys against the parent's keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.joins import bounded_broadcast


def run_checks(df: DataFrame, *, not_null=(), accepted: dict | None = None,
               expressions: dict | None = None) -> DataFrame:
    """(test, failures) rows: NULLs per not_null column, rows outside the
    accepted values (NULL passes), rows where an expression is not true."""
    aggs = {}
    for c in not_null:
        aggs[f"not_null_{c}"] = F.count_if(F.col(c).isNull())
    for c, values in (accepted or {}).items():
        aggs[f"accepted_values_{c}"] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
    for name, expr in (expressions or {}).items():
        e = F.expr(expr) if isinstance(expr, str) else expr
        aggs[f"expression_{name}"] = F.count_if(~F.coalesce(e, F.lit(False)))
    wide = df.agg(*[v.alias(k) for k, v in aggs.items()])
    return wide.unpivot([], list(aggs), "test", "failures")


def relationship_failures(child: DataFrame, key: str, parent: DataFrame, parent_key: str,
                          name: str, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Child rows whose non-NULL ``key`` has no ``parent_key`` (NULL passes)."""
    return relationships_report([(name, child, key, parent, parent_key)], max_broadcast_rows)


def _comparable(c: Column, kind: T.DataType) -> Column:
    """A key as text after a cast to the type both sides are compared in, so
    that equal values have equal texts (1 and 1.00, 0.0 and -0.0)."""
    c = c.cast(kind)
    return (c + F.lit(0.0) if isinstance(kind, (T.FloatType, T.DoubleType)) else c).cast("string")


def _failures(checks, max_broadcast_rows: int) -> DataFrame:
    """Relationship tests that share one child frame, in one pass over it.

    A GROUPING SETS aggregate (one set per key column) reduces the child to
    (key column, key, rows) with map-side partial aggregation, so a hot key
    costs one row per task.  Each test compares its key in the common type of
    child and parent; a single anti join against the union of the parents'
    keys, tagged by test, finds the orphans."""
    child = checks[0][1]
    spark = child.sparkSession
    keys = sorted({c[2] for c in checks})
    counts = child.groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    tested, parents = [], None
    for name, _, key, parent, pkey in checks:
        # analysis only: the type a comparison of the two columns would use
        kind = child.select(F.col(key).alias("_k")).union(parent.select(F.col(pkey).alias("_k"))).schema[0].dataType
        tested.append(F.when((F.col(f"_g_{key}") == 0) & F.col(key).isNotNull(),
                             F.struct(F.lit(name).alias("test"), _comparable(F.col(key), kind).alias("_k"))))
        p = parent.where(F.col(pkey).isNotNull()).select(
            F.lit(name).alias("test"), _comparable(F.col(pkey), kind).alias("_k"))
        parents = p if parents is None else parents.unionByName(p)
    long = counts.select("_n", F.explode(F.filter(F.array(*tested), lambda x: x.isNotNull())).alias("_t")).select(
        "_n", "_t.test", "_t._k")
    parents = bounded_broadcast(parents.distinct(), max_broadcast_rows)
    orphans = long.join(parents, ["test", "_k"], "left_anti").groupBy("test").agg(F.sum("_n").alias("_f"))
    tests = spark.createDataFrame([(c[0],) for c in checks], "test string")
    # at most one row per test: a structural bound, so it is broadcast
    return (tests.join(F.broadcast(orphans), "test", "left")
            .select("test", F.coalesce(F.col("_f"), F.lit(0)).cast("long").alias("failures")))


def relationships_report(checks, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Union of relationship tests given as (name, child, key, parent, parent_key).

    Tests on the same child frame share ONE pass over it, so the ten foreign
    keys of the fact cost one narrow scan of the fact."""
    by_child: dict[int, list] = {}
    for chk in checks:
        by_child.setdefault(id(chk[1]), []).append(chk)
    out = None
    for group in by_child.values():
        r = _failures(group, max_broadcast_rows)
        out = r if out is None else out.unionByName(r)
    return out


def assert_defined(df: DataFrame | None, name: str = "output") -> DataFrame:
    """T5: a block's output must exist and hold at least one row (a limit-1
    job, whatever the size of ``df``)."""
    if df is None:
        raise AssertionError(f"{name} is undefined")
    if df.isEmpty():
        raise AssertionError(f"{name} is empty")
    return df


#: SQL names of the types the layers use.
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def column_types(df: DataFrame, layer: str) -> DataFrame:
    """(layer, column_name, type, present): each column's own type under its
    SQL name and the number of its values, in one aggregate."""
    types = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, SQL_TYPES.get(t, t.upper()))])
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "present").select(
        F.lit(layer).alias("layer"), "column_name", types[F.col("column_name")].alias("type"), "present")
