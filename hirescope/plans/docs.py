"""Postings read from the ``documents`` table.

A document stands for a posting and its distinct lower-cased tokens for its
skills, so the skill marts (M7, M9, M10), token frequency (A11, O2, O3, U3)
and text cleaning helpers run over real, whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions.keys import surrogate_key
from hirescope.plans import star
from hirescope.sources.tables import table

URL_PREFIX = "https://wuzzuf.net/jobs/p/doc-"


def doc_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Staging-shaped projection of documents (only the columns marts need)."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    url = F.concat(F.lit(URL_PREFIX), F.col("doc_id").cast("string"))
    return d.select(url.alias("job_url"), surrogate_key(url).alias("job_id"),
                    F.split(F.lower("text"), r"\s+").alias("skills"))


def skill_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return star.job_skill_pairs(doc_postings(spark, sf))


def mart_skill_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """M10 over documents: demand / rarity / bucket per token."""
    # the posting total is counted straight off the scan (metadata-only)
    return star.skill_metrics(skill_pairs(spark, sf), table(spark, sf, "documents"))


def dim_skills(spark: SparkSession, sf: str) -> DataFrame:
    """M7 over documents."""
    return star.dim_skills(skill_pairs(spark, sf))


def bridge_job_skills(spark: SparkSession, sf: str) -> DataFrame:
    """M9 over documents."""
    return star.bridge_job_skills(skill_pairs(spark, sf))


def top_skills(spark: SparkSession, sf: str, k: int = 20) -> DataFrame:
    """A11 + O2 / B3: the k most frequent tokens (ties by name)."""
    per = skill_pairs(spark, sf).groupBy("skill_name").agg(F.count(F.lit(1)).alias("n_jobs"))
    return per.orderBy(F.desc("n_jobs"), "skill_name").limit(k)


def skill_slice(spark: SparkSession, sf: str, offset: int = 50, n: int = 50) -> DataFrame:
    """Sorted distinct skills, positions [offset, offset+n)."""
    return (skill_pairs(spark, sf).select("skill_name").distinct()
            .orderBy("skill_name").offset(offset).limit(n))
