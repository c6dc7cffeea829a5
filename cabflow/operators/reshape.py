"""Reshaping of question results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, index, column: str, value: str, values=None) -> DataFrame:
    """One row per ``index``, one column per value of ``column``.

    With ``values`` the pivot needs no extra job; without them Spark finds the
    distinct values first (bounded by spark.sql.pivotMaxValues), which runs
    ``df`` once more, so pass a materialized (checkpointed) ``df`` then."""
    idx = index if isinstance(index, (list, tuple)) else [index]
    g = df.groupBy(*idx)
    g = g.pivot(column, list(values)) if values is not None else g.pivot(column)
    return g.agg(F.first(value))


def unpivot_measures(df: DataFrame, ids, measures, name: str = "measure",
                     value: str = "value") -> DataFrame:
    """Long form (ids..., measure, value); measures are cast to double."""
    ids = ids if isinstance(ids, (list, tuple)) else [ids]
    cast = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in measures])
    return cast.unpivot(ids, list(measures), name, value)


def route_edges(routes: DataFrame, src: str = "p_bor", dst: str = "d_bor",
                weight: str = "total") -> DataFrame:
    """Flow edges with dense node ids.  Nodes are the distinct labels of a
    top-k result (at most 2k rows), numbered in label order."""
    labels = routes.select(F.col(src).alias("label")).union(routes.select(F.col(dst).alias("label"))).distinct()
    nodes = labels.withColumn("node_id", F.row_number().over(Window.orderBy("label")) - 1)
    s = nodes.select(F.col("label").alias(src), F.col("node_id").alias("source"))
    d = nodes.select(F.col("label").alias(dst), F.col("node_id").alias("target"))
    return (routes.join(s, src).join(d, dst)
            .select("source", "target", F.col(weight).alias("value"),
                    F.col(src).alias("source_label"), F.col(dst).alias("target_label")))
