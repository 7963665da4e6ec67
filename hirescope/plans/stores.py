"""Round trips: rows written, changed and read back through the table layer.

Each query writes to a fresh folder beside the session's checkpoints and
returns what a reader then finds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import parse as P
from hirescope.operators import filetable
from hirescope.plans import daily
from hirescope.plans.events import _upsert_sides
from hirescope.plans.postings import clean_postings, cleaned_postings, normalize_raw, quality_checks, raw_postings
from hirescope.session import checkpoint_dir, written
from hirescope.sources import raw, sinks, tables

ORDER = ("scraped_at", "pos")
DELTAS = 3
JOBS_PER_DOCUMENT = 2000


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def upsert_order_files(spark: SparkSession, sf: str) -> DataFrame:
    """J5 by files: target written, source merged in, table read."""
    target, source = _upsert_sides(spark, sf)
    base = _scratch(spark, "orders")
    filetable.upsert(target, base, "o_orderkey", ["o_orderdate"], "target")
    filetable.upsert(source, base, "o_orderkey", ["o_orderdate"], "source")
    return filetable.read(spark, base).select(target.columns)


def incremental_marts(spark: SparkSession, sf: str) -> DataFrame:
    """Postings arrive in three deltas that share URLs; the
    marts come from the partial sums that the deltas left."""
    rows = normalize_raw(raw_postings(spark, sf))
    as_of = P.iso_to_date(rows.where(F.col("scraped_at").isNotNull()).select(F.min_by("scraped_at", "pos")).scalar())
    base = _scratch(spark, "daily")
    for n in range(DELTAS):
        delta = clean_postings(rows.where(F.col("pos") % DELTAS == n), as_of=as_of, keep=ORDER)
        daily.load_day(spark, delta, base, f"delta-{n}", newer_only=True, order=ORDER)
    marts = daily.incremental_star(spark, base)
    skills = marts["mart_job_metrics"].select(
        F.lit("skill").alias("mart"), F.col("skill_name").alias("name"), F.col("demand_category").alias("part"),
        F.col("jobs_requiring_skill").alias("n"), F.col("skill_demand_score").alias("share"), F.col("skill_rarity_score").alias("other"))
    return skills.unionByName(marts["category_metrics"].select(
        F.lit("category").alias("mart"), F.col("job_category").alias("name"), F.col("experience_level").alias("part"),
        F.col("job_count").alias("n"), F.col("market_demand_index").alias("share"), F.col("remote_ratio").alias("other")))


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The raw postings as wrapped documents (``doc, metadata, jobs``), 2000 jobs each."""
    fields = ["job_id", "title", "company", "location", "job_type", "experience", "skills", "posted_date", "url", "scraped_at", "keyword"]
    rows = raw_postings(spark, sf).select(F.floor(F.col("pos") / JOBS_PER_DOCUMENT).alias("doc"), "pos", F.struct(*fields).alias("job"))
    jobs = F.transform(F.sort_array(F.collect_list(F.struct("pos", "job"))), lambda x: x["job"])
    return rows.groupBy("doc").agg(jobs.alias("jobs")).select(
        "doc", F.struct(F.lit("all").alias("keyword"), F.size("jobs").alias("total_jobs")).alias("metadata"), "jobs")


def stream_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents land as JSON files, all of them twice, and stream
    into the table in several micro-batches."""
    from hirescope.streaming import incremental
    base = _scratch(spark, "stream")
    # Both copies and their count come from documents put together once.
    docs = written(raw_documents(spark, sf))
    for copy in ("a", "b"):
        docs.write.partitionBy("doc").json(f"{base}/landing/{copy}")
    files = docs.select(F.count("*")).first()[0]
    incremental.start(spark, f"{base}/landing/*/*", f"{base}/table", f"{base}/checkpoint",
                      max_files_per_trigger=max(1, 2 * files // 3 + 1)).awaitTermination()
    return incremental.current_table(spark, f"{base}/table").select(
        "job_url", "job_title", "company_name", "job_category", "experience_level", "min_experience", "city", "work_type")


def catalog_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tables registered by name, found in the catalog, counted by name."""
    tables.register_views(spark, sf)
    names = [r["tableName"] for r in tables.list_tables(spark).where(F.col("tableName").isin(tables.TABLES)).collect()]
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in sorted(names)))


def raw_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Postings written as wrapped JSON documents and loaded again."""
    base = _scratch(spark, "raw")
    raw_documents(spark, sf).repartition("doc").write.partitionBy("doc").json(f"{base}/landing")
    back = raw.load_raw_json(spark, f"{base}/landing/*")
    return back.select("job_url", "job_title", "company_name", "job_type", "experience_raw", F.array_join("skills_list", "|").alias("skills"),
                       "posted_date", "scraped_at", "job_category")


def raw_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV export, with lists as text and line breaks in cells, written and read."""
    base = _scratch(spark, "csv")
    none = F.lit(None).cast("string")
    r = raw_postings(spark, sf).withColumnsRenamed({"url": "job_url", "title": "job_title"}).select(
        "*", F.array("keyword").alias("search_keywords"))
    sinks.write_csv(r.select(*[F.col(c) if c in r.columns else none.alias(c) for c in raw.CSV_FIELDS]), f"{base}/export")
    back = raw.read_raw_csv(spark, f"{base}/export")
    return back.select("job_url", "job_title", "posted_date", "job_type", "experience", F.array_join("skills", "|").alias("skills"),
                       "scraped_at", F.element_at("search_keywords", 1).alias("keyword"))


def gate_status(spark: SparkSession, sf: str) -> DataFrame:
    """The gate's report as written, and the rows of the staged
    table, counted while they pass."""
    base = _scratch(spark, "gate")
    cleaned, counted = sinks.observe_counts(cleaned_postings(spark, sf), "stored")
    sinks.write_parquet(cleaned, f"{base}/cleaned")
    sinks.write_quality_report(quality_checks(spark, sf), f"{base}/report", f"{base}/cleaned")
    summary = spark.read.json(f"{base}/report/summary")
    return summary.select("checks_passed", "checks_failed", "status", F.lit(counted.get["rows"]).cast("long").alias("n_stored"))
