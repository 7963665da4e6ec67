"""Counting, shares, top-k and sampling (A1-A12, A21, O1-O6, B-series helpers).

Shares use a scalar subquery for the total (computed once, inlined as a
literal) rather than a global window, which would pull every row into one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """A3: round(part * 100 / total, digits) in double arithmetic."""
    return F.round(part.cast("double") * 100.0 / total.cast("double"), digits)


def value_counts(df: DataFrame, cols: Sequence[str] | str, dropna: bool = True,
                 share: bool = True) -> DataFrame:
    """Counts per value (or value tuple) with share of all rows."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    src = df.dropna(subset=cols) if dropna else df
    out = src.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))
    if share:
        # total = sum of the group counts: the subquery aggregates the same
        # grouped exchange as the main plan (reused), not the input again
        total = out.select(F.sum("count")).scalar()
        out = out.withColumn("share_pct", pct(F.col("count"), total))
    return out


def top_k(df: DataFrame, value_col: str, by: str, k: int) -> DataFrame:
    """O2: k largest by ``by`` (ties by value) -> TakeOrderedAndProject."""
    return df.orderBy(F.desc(by), F.asc(value_col)).limit(k)


def top_k_per_group(df: DataFrame, group: str, value_col: str, by: str, k: int) -> DataFrame:
    """Top-k per group.  ``df`` is already aggregated to one row per
    (group, value), so a window partition is bounded by the number of
    distinct values in a group, not by raw rows."""
    w = Window.partitionBy(group).orderBy(F.desc(by), F.asc(value_col))
    return df.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def repeatable_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows chosen by a seeded hash of the key (same rows at any
    partitioning / re-run); a top-n by hash, not a global shuffle-sort."""
    return df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed))).orderBy("_h", key).limit(n).drop("_h")


def before_after(before: DataFrame, after: DataFrame, col: str) -> DataFrame:
    """Q15: value counts of one column before and after a step, with delta."""
    b = before.groupBy(col).agg(F.count(F.lit(1)).alias("before"))
    a = after.groupBy(col).agg(F.count(F.lit(1)).alias("after"))
    j = b.join(a, col, "full_outer").na.fill(0, ["before", "after"])
    return j.withColumn("delta", F.col("after") - F.col("before"))
