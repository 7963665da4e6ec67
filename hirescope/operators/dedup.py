"""Deduplication.

Keep-first / keep-last rank the rows of a key and keep rank one.  Columns that
nobody reads are pruned through the window, and Spark's window group limit
keeps one row per key and task before the shuffle, so a key that holds a third
of all rows is reduced before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _pick(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").select(*keys, *rest)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row with the greatest ``order`` tuple."""
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the row with the smallest ``order`` tuple."""
    return _pick(df, keys, [F.col(c).asc_nulls_first() for c in order])


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D3 (``keep=False``): every row whose key occurs more than once.

    Semi-join against the keys that repeat; the key counts are a partial
    aggregate and AQE splits a hot key's partition of the big side."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    return df.join(dup, list(keys), "left_semi")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows minus distinct non-null keys (one aggregate row)."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicates"))


def ordered_distinct_list(df: DataFrame, key: str, value: str, order: Sequence[str],
                          sep: str = ",") -> DataFrame:
    """Per key, its distinct values ordered by first occurrence.

    Values are first reduced to one row per (key, value) with their first
    position (partial aggregate), so the list for a key is bounded by the
    number of distinct values, never by the key's row count.
    """
    first = df.groupBy(key, value).agg(F.min(F.struct(*order)).alias("_first"))
    lst = F.array_sort(F.collect_list(F.struct(F.col("_first").alias("o"), F.col(value).alias("v"))))
    return first.groupBy(key).agg(F.array_join(F.transform(lst, lambda x: x["v"]), sep).alias(f"{value}_list"))


def first_seen_per_key(df: DataFrame, key: str, group: str, order: Sequence[str]) -> DataFrame:
    """D5 new-unique count: keys counted under the group where they appear first."""
    first = keep_first(df.select(key, group, *order), [key], order)
    return first.groupBy(group).agg(F.count(F.lit(1)).alias("new_unique"))
