"""Join helpers: bounded broadcast lookups (J10) and SQL over named models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str,
           fallback: Column | None = None) -> DataFrame:
    """Dictionary lookup against a table-form map with a fallback.

    No hint: Spark broadcasts the map if its measured size allows and shuffles
    otherwise.  Keys are de-duplicated first so the lookup cannot fan out.
    """
    m = table.select(F.col(key).alias("_lk"), F.col(value).alias("_lv")).dropDuplicates(["_lk"])
    j = df.join(m, df[col] == F.col("_lk"), "left")
    dflt = F.col(col) if fallback is None else fallback
    return j.withColumn(out, F.coalesce(F.col("_lv"), dflt)).drop("_lk", "_lv")


def map_table(spark, mapping: dict, key: str = "key", value: str = "value") -> DataFrame:
    """A rule map as a (fixed-size) DataFrame."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")
