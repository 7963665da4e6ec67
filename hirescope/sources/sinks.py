"""Writers (S9-S14, S16, S18).

Every sink is a distributed write (one file per task).  Arrays are kept as
arrays in Parquet and serialized to JSON text only for CSV.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    """S10."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV, complex columns as JSON text (CSV cannot hold arrays)."""
    cols = [F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct")
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode(mode).option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite", list_as_text: bool = False) -> str:
    """JSON lines; optionally serialize list columns to text first."""
    if list_as_text:
        df = df.select(*[F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
                         for f in df.schema.fields])
    df.write.mode(mode).json(path)
    return path


def write_keyword_files(jobs: DataFrame, path: str, batch_meta: DataFrame | None = None,
                        mode: str = "overwrite") -> str:
    """Jobs partitioned by keyword (JSON lines) plus one metadata row per
    keyword (counts, last update, source) under ``_batch_metadata``.  The
    metadata is an aggregate; no keyword's jobs are ever gathered in one task."""
    jobs.write.mode(mode).partitionBy("keyword").json(f"{path}/jobs")
    meta = jobs.groupBy("keyword").agg(F.count(F.lit(1)).alias("total_jobs")) \
        .withColumn("last_updated", F.current_timestamp()).withColumn("source", F.lit("wuzzuf.net"))
    if batch_meta is not None:
        meta = meta.join(batch_meta, "keyword", "left")
    meta.write.mode(mode).json(f"{path}/_batch_metadata")
    return path


def write_quality_report(checks: DataFrame, path: str, source_path: str) -> DataFrame:
    """One-row-per-check detail plus a one-row summary (timestamp,
    counts, failures, status), both as JSON."""
    checks.write.mode("overwrite").json(f"{path}/checks")
    summary = checks.agg(
        F.count_if("passed").alias("checks_passed"), F.count_if(~F.col("passed")).alias("checks_failed"),
        F.collect_list(F.when(~F.col("passed"), F.col("check"))).alias("failures")
    ).select(F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("timestamp"),
             F.lit(source_path).alias("parquet_path"), "checks_passed", "checks_failed", "failures",
             F.when(F.col("checks_failed") == 0, "PASSED").otherwise("FAILED").alias("status"))
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/summary")
    return summary


def staged_write(spark: SparkSession, df: DataFrame, stage_table: str) -> int:
    """Write a stage table (auto-created, overwritten), verify its row
    count, and hand back the count; callers drop it with ``drop_table``."""
    obs = Observation("stage")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(stage_table)
    written = obs.get["rows"]
    stored = spark.table(stage_table).count()
    if stored != written:
        raise RuntimeError(f"stage {stage_table}: wrote {written} rows, table holds {stored}")
    return stored


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by the next action (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
