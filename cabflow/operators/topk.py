"""Top-k (O3) and top-n per group with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Global top-k: sort + limit, planned as TakeOrderedAndProject (each
    task keeps k rows, the final merge sees tasks x k rows)."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(df: DataFrame, group, order: Column, n: int, rank_col: str = "rnk") -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY order) <= n.

    Ties share a rank, so more than n rows may pass.  Meant for aggregated
    input (one row per group x item); Spark inserts a WindowGroupLimit
    before the shuffle so each task forwards only rows that can still rank
    within n."""
    groups = group if isinstance(group, (list, tuple)) else [group]
    w = Window.partitionBy(*groups).orderBy(order)
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= n)
