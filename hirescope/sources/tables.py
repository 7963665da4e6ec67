"""Driver tables and named sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the driver's data set (column pruning and
    filter pushdown happen at this scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose tables by name for ``spark.sql`` / ``spark.table``."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """SHOW TABLES as a DataFrame."""
    q = "SHOW TABLES" + (f" IN {database}" if database else "")
    return spark.sql(q)
