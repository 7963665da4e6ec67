"""Staging model and star schema (M2-M13) as DataFrame builders.

Input is a staging-shaped frame with one row per posting:
``job_url, job_title, job_category, experience_level, job_type, work_type,
skills (array<string>), min_experience, max_experience, company_name,
company_type, city, posted_date, scrape_date``.

Scale notes
* Dimensions are ``distinct`` projections: partial aggregation on the map
  side means a hot value (the ``Confidential`` company, ``Cairo``) costs one
  row per task before the shuffle, never a hot reducer.
* Skills are de-duplicated *inside* each row (``array_distinct``) before the
  explode, so the bridge needs no DISTINCT shuffle and per-skill counts are a
  single partial+final aggregate.
* Fact joins are left equi-joins on hash keys; small dims are broadcast by AQE
  at run time from their measured size (no fixed size assumption).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.functions.keys import date_parts, surrogate_key
from hirescope.functions.parse import demand_bucket
from hirescope.functions.rules import DEFAULT_COUNTRY
from hirescope.functions.skills import normalized_skills
from hirescope.functions.text import std_lower


def stg_jobs(raw: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """M2: key, trimmed / lower-cased text, experience gap, days on market."""
    return (raw.filter(F.col("job_url").isNotNull())
            .select(
                surrogate_key("job_url").alias("job_id"),
                F.trim("job_title").alias("job_title"),
                std_lower("job_category").alias("job_category"),
                std_lower("experience_level").alias("experience_level"),
                F.trim("job_type").alias("job_type"),
                F.trim("work_type").alias("work_type"),
                "job_url", "skills", "min_experience", "max_experience",
                (F.col("max_experience") - F.col("min_experience")).alias("experience_gap"),
                F.trim("company_name").alias("company_name"),
                F.trim("company_type").alias("company_type"),
                F.trim("city").alias("city"),
                F.lit(country).alias("country"),
                "posted_date", "scrape_date",
                F.datediff("scrape_date", "posted_date").cast("bigint").alias("days_on_market")))


def dim_job(stg: DataFrame) -> DataFrame:
    """M3."""
    return stg.select("job_id", "job_title", "job_category", "experience_level", "scrape_date")


def dim_company(stg: DataFrame) -> DataFrame:
    """M4: one row per company name (latest type wins, so the key stays unique
    and the fact join cannot fan out)."""
    return (stg.filter(F.col("company_name").isNotNull())
            .groupBy("company_name")
            .agg(F.max_by("company_type", F.struct("scrape_date", "company_type")).alias("company_type"))
            .select(surrogate_key("company_name").alias("company_id"), "company_name", "company_type"))


def dim_location(stg: DataFrame) -> DataFrame:
    """M5."""
    return (stg.filter(F.col("city").isNotNull()).select("city", "country").distinct()
            .select(surrogate_key("city", "country").alias("location_id"), "city", "country"))


def dim_date(stg: DataFrame, date_col: str = "posted_date") -> DataFrame:
    """M6: distinct dates + calendar parts."""
    d = stg.filter(F.col(date_col).isNotNull()).select(F.col(date_col).alias("full_date")).distinct()
    return d.select(surrogate_key("full_date").alias("date_id"), "full_date", *date_parts("full_date"))


def job_skill_pairs(stg: DataFrame) -> DataFrame:
    """J11 + F47: one row per (job, skill) -- distinct by construction."""
    return stg.select("job_id", F.explode(normalized_skills("skills")).alias("skill_name"))


def dim_skills(pairs: DataFrame) -> DataFrame:
    """M7."""
    return (pairs.select("skill_name").distinct()
            .select(surrogate_key("skill_name").alias("skill_id"), "skill_name"))


def bridge_job_skills(pairs: DataFrame) -> DataFrame:
    """M9: the skill id is the hash of the name, so joining the dimension back
    (J2) is an identity -- the key is computed in place, no shuffle join."""
    return pairs.select("job_id", surrogate_key("skill_name").alias("skill_id"))


def fact_jobs(stg: DataFrame) -> DataFrame:
    """M8 with keys derived in place: every dimension key is md5 of a staging
    column, and each dimension holds exactly the non-null values of that
    column (one row per company name; city -> (city, constant country); one
    row per date), so the left joins of J1 resolve to ``md5(col)`` where the
    column is non-null, else null.  A map-only projection -- no joins, no
    shuffle, whatever the skew of company or city."""
    def key(*cols):
        present = F.col(cols[0]).isNotNull()
        return F.when(present, surrogate_key(*cols))
    return stg.select(surrogate_key("job_url").alias("fact_id"), "job_id",
                      key("company_name").alias("company_id"), key("city", "country").alias("location_id"),
                      key("posted_date").alias("date_id"),
                      "min_experience", "max_experience", "job_type", "work_type", "job_url")


def fact_jobs_joined(stg: DataFrame, companies: DataFrame, locations: DataFrame, dates: DataFrame,
                     jobs: DataFrame) -> DataFrame:
    """M8 (J1) as the model writes it: left joins to the four dimensions."""
    keyed = stg.withColumn("_job", F.col("job_id")).drop("job_id")
    f = (keyed.join(jobs.select("job_id"), F.col("_job") == F.col("job_id"), "left")
         .join(companies.select("company_name", "company_id"), "company_name", "left")
         .join(locations.select("city", "location_id"), "city", "left")
         .join(dates.select(F.col("full_date").alias("posted_date"), "date_id"), "posted_date", "left"))
    return f.select(surrogate_key("job_url").alias("fact_id"), "job_id", "company_id", "location_id", "date_id",
                    "min_experience", "max_experience", "job_type", "work_type", "job_url")


def skill_metrics(pairs: DataFrame, fact: DataFrame) -> DataFrame:
    """Demand / rarity per skill against the total posting count.

    The total is a scalar subquery (one partial+final count, evaluated once and
    inlined as a literal) -- no cross join and nothing collected by hand.
    """
    total = fact.select(F.count(F.lit(1)).cast("double")).scalar()
    per = pairs.groupBy("skill_name").agg(F.count(F.lit(1)).alias("jobs_requiring_skill"))
    pct = F.col("jobs_requiring_skill").cast("double") * 100.0 / total
    return per.select(
        "skill_name", "jobs_requiring_skill",
        F.round(pct, 2).alias("skill_demand_score"),
        F.round(100.0 - pct, 2).alias("skill_rarity_score"),
        demand_bucket(F.round(pct, 2)).alias("demand_category"))


def category_metrics(stg: DataFrame) -> DataFrame:
    """M11 (A4-A6): per category x level: count, mean min years, remote share,
    share of all postings.

    The model joins fact to dim_job on job_id; both are projections of the
    same de-duplicated staging rows keyed by md5(job_url), so that join is
    1:1 and the aggregate reads staging directly -- no shuffle join of two
    posting-sized tables.
    """
    total = stg.select(F.count(F.lit(1)).cast("double")).scalar()
    j = stg
    return (j.groupBy("job_category", "experience_level").agg(
        F.count("job_id").alias("job_count"),
        F.round(F.avg("min_experience"), 1).alias("avg_min_experience"),
        F.round(F.avg(F.when(F.col("work_type") == "Remote", 1.0).otherwise(0.0)) * 100, 2).alias("remote_ratio"),
        F.round(F.count("job_id").cast("double") * 100.0 / total, 2).alias("market_demand_index")))


def skill_count_frame(stg: DataFrame) -> DataFrame:
    """Distinct skills per job with level and category.  The bridge
    holds each row's de-duplicated skill array exploded, so the per-job count
    is the array size -- computed in place, no group-by and no join; jobs
    without skills drop out as in the inner join."""
    n = F.size(normalized_skills("skills")).cast("bigint")
    return (stg.select("job_id", "experience_level", "job_category", n.alias("skill_count"))
            .filter(F.col("skill_count") > 0))


def skill_pairs_with(stg: DataFrame, *cols: str) -> DataFrame:
    """(job, skill) rows carrying job attributes -- bridge ⋈ dim_skills ⋈
    dim_job without the joins (skill_id = md5(name), job attributes are on
    the same staging row)."""
    return stg.select("job_id", *cols, F.explode(normalized_skills("skills")).alias("skill_name"))


def skill_category_pairs(stg: DataFrame) -> DataFrame:
    """One row per job-skill with the job's category."""
    return skill_pairs_with(stg, "job_category").select("skill_name", "job_category")


# ------------------------------------------------ marts kept from partial sums
def skill_state(applied: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """What a day changes in the postings per skill: those that came or changed
    count, those they replace count against."""
    new = job_skill_pairs(applied).select("skill_name", F.lit(1).alias("n"))
    rows = new if replaced is None else new.unionByName(job_skill_pairs(replaced).select("skill_name", F.lit(-1).alias("n")))
    return rows.groupBy("skill_name").agg(F.sum("n").alias("n")).where("n <> 0")


def category_state(applied: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """What a day changes per category and level: postings, remote ones, and the
    sum and number of least years."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select("job_category", "experience_level", F.lit(sign).alias("n"),
                         F.when(F.col("work_type") == "Remote", sign).otherwise(0).alias("remote"),
                         (sign * F.col("min_experience")).alias("years"), F.when(F.col("min_experience").isNotNull(), sign).alias("with_years"))
    rows = signed(applied, 1) if replaced is None else signed(applied, 1).unionByName(signed(replaced, -1))
    return fold_category(rows)


def fold_skills(state: DataFrame) -> DataFrame:
    return state.groupBy("skill_name").agg(F.sum("n").alias("n")).where("n <> 0")


def fold_category(state: DataFrame) -> DataFrame:
    return state.groupBy("job_category", "experience_level").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("n", "remote", "years", "with_years")])


def skill_metrics_of(skills: DataFrame, categories: DataFrame) -> DataFrame:
    """M10 from the partial sums alone."""
    total = categories.select(F.sum("n").cast("double")).scalar()
    pct = F.col("n").cast("double") * 100.0 / total
    return fold_skills(skills).select(
        "skill_name", F.col("n").alias("jobs_requiring_skill"), F.round(pct, 2).alias("skill_demand_score"),
        F.round(100.0 - pct, 2).alias("skill_rarity_score"), demand_bucket(F.round(pct, 2)).alias("demand_category"))


def category_metrics_of(categories: DataFrame) -> DataFrame:
    """M11 from the partial sums alone."""
    total = categories.select(F.sum("n").cast("double")).scalar()
    n = F.col("n").cast("double")
    return fold_category(categories).where("n > 0").select(
        "job_category", "experience_level", F.col("n").alias("job_count"),
        F.round(F.when(F.col("with_years") > 0, F.col("years") / F.col("with_years")), 1).alias("avg_min_experience"),
        F.round(F.col("remote").cast("double") / n * 100, 2).alias("remote_ratio"),
        F.round(n * 100.0 / total, 2).alias("market_demand_index"))


def build_star(stg: DataFrame) -> dict[str, DataFrame]:
    """All marts from one staging frame (callers persist / write as needed)."""
    pairs = job_skill_pairs(stg)
    comp, loc, dates = dim_company(stg), dim_location(stg), dim_date(stg)
    jobs = dim_job(stg)
    fact = fact_jobs(stg)
    skills = dim_skills(pairs)
    bridge = bridge_job_skills(pairs)
    return {
        "stg_jobs": stg, "dim_job": jobs, "dim_company": comp, "dim_location": loc,
        "dim_date": dates, "dim_skills": skills, "bridge_job_skills": bridge, "fact_jobs": fact,
        "fact_jobs_joined": fact_jobs_joined(stg, comp, loc, dates, stg.select("job_id")),
        "mart_job_metrics": skill_metrics(pairs, fact),
        "category_metrics": category_metrics(stg),
    }
