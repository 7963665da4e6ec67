"""Raw posting readers.

The scraper's wrapped document ``{metadata, jobs[]}`` is read with an
explicit schema (no inference pass) and exploded.  ``multiLine`` JSON is not
splittable -- one task per file -- so at scale raw files should be many and
small (one per keyword per day), and are landed once as Parquet; every later
job reads the Parquet copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirescope.functions import parse as P
from hirescope.functions import rules as R
from hirescope.functions.skills import parse_list_literal

JOB = T.StructType([T.StructField(n, T.StringType()) for n in
                    ["job_id", "title", "company", "location", "job_type", "experience"]]
                   + [T.StructField("skills", T.ArrayType(T.StringType()))]
                   + [T.StructField(n, T.StringType()) for n in ["posted_date", "url", "scraped_at", "keyword"]])
METADATA = T.StructType([
    T.StructField("keyword", T.StringType()), T.StructField("total_jobs", T.LongType()),
    T.StructField("pages_scraped", T.LongType()), T.StructField("last_updated", T.StringType()),
    T.StructField("updated_count", T.LongType()), T.StructField("appended_count", T.LongType()),
    T.StructField("keywords_count", T.LongType()), T.StructField("scrape_date", T.StringType()),
    T.StructField("source", T.StringType())])
RAW_DOC = T.StructType([T.StructField("metadata", METADATA), T.StructField("jobs", T.ArrayType(JOB)),
                        T.StructField("_corrupt_record", T.StringType())])

CSV_FIELDS = ["job_url", "source_platform", "search_keywords", "scraped_at", "job_title",
              "company_location_text", "posted_date", "job_type", "workplace_type", "experience",
              "salary", "skills", "job_description", "job_requirements"]
CSV_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in CSV_FIELDS])


def read_raw_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Wrapped documents, one row per file; unreadable files land in
    ``_corrupt_record`` instead of failing the batch."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.schema(RAW_DOC).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
            .withColumn("file", F.col("_metadata.file_name")))


def corrupt_documents(docs: DataFrame) -> DataFrame:
    """The files that could not be read, with their text, for a quarantine."""
    return (docs.filter(F.col("_corrupt_record").isNotNull() & F.col("jobs").isNull())
            .select("file", "_corrupt_record"))


def explode_jobs(docs: DataFrame) -> DataFrame:
    """S1 body: one row per job with the raw field names (defaults applied to
    missing values) and a ``pos`` ordering struct (file, index in file)."""
    j = docs.select("file", F.posexplode_outer("jobs").alias("idx", "job")).filter(F.col("job").isNotNull())
    d = R.RAW_DEFAULTS
    return j.select(
        F.struct("file", "idx").alias("pos"),
        F.col("job.job_id").alias("job_id"),
        *[F.coalesce(F.col(f"job.{k}"), F.lit(v)).alias(k) for k, v in d.items() if k not in ("location",)],
        F.coalesce(F.col("job.location"), F.lit(d["location"])).alias("location"),
        F.coalesce(F.col("job.skills"), F.array().cast("array<string>")).alias("skills"))


def load_raw_json(spark: SparkSession, paths: str | Sequence[str], check_nonempty: bool = True) -> DataFrame:
    """Raw postings in pipeline naming (city and work type derived)."""
    from hirescope.plans.postings import normalize_raw
    jobs = explode_jobs(read_raw_documents(spark, paths))
    if check_nonempty and jobs.isEmpty():   # S15: one tiny job, stops at the first row
        raise ValueError(f"No jobs found in {paths}")
    return normalize_raw(jobs)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """S3: recursively flatten struct columns into top-level columns."""
    cols = []

    def walk(prefix, dtype, path):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f"{prefix}{sep}{f.name}" if prefix else f.name, f.dataType, path + [f.name])
        else:
            cols.append(F.col("`" + "`.`".join(path) + "`").alias(prefix))
    for f in df.schema.fields:
        walk(f.name, f.dataType, [f.name])
    return df.select(*cols)


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header CSV with quoted multi-line cells; list-literal cells parsed
    into arrays (F19)."""
    df = (spark.read.schema(CSV_SCHEMA).option("header", True).option("multiLine", True)
          .option("escape", '"').csv(paths))
    return (df.withColumn("skills", parse_list_literal("skills"))
              .withColumn("search_keywords", parse_list_literal("search_keywords")))


def csv_to_postings(df: DataFrame) -> DataFrame:
    """CSV rows aligned to the JSON raw schema (U1 input): company and
    location split from the combined text, first search keyword as category."""
    loc = P.split_location(F.regexp_replace("company_location_text", r"^[^-]*-\s*", ""))
    company = F.trim(F.regexp_extract("company_location_text", r"^([^-]*)-", 1))
    return df.select(
        F.col("job_url").alias("url"), F.col("job_title").alias("title"),
        F.nullif(company, F.lit("")).alias("company"),
        F.concat_ws(", ", loc["city"], loc["country"]).alias("location"),
        "job_type", "experience", "skills", "posted_date", "scraped_at",
        F.try_element_at("search_keywords", F.lit(1)).alias("keyword"))
