"""Raw postings derived from ``orders`` and the cleaning chain M1 over them.

The driver has no postings table, so one raw posting is built per order
(SURVEY 7.3b): the raw *texts* -- titles, experience strings, multi-line
dates, location lists, skill lists with bullets and noise -- are picked from
short literal lists by the order key, and the URL / scrape time come from the
order itself.  Work therefore grows with ``orders``; the literal lists only
supply realistic text shapes.  Pairs of orders share a URL, so the dedup step
has real duplicates to resolve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.functions import parse as P
from hirescope.functions.skills import clean_skills_list, list_to_text
from hirescope.functions.text import collapse_ws, py_strip
from hirescope.operators.dedup import keep_first, keep_last
from hirescope.session import written
from hirescope.sources.tables import table

HOST = "https://wuzzuf.net"

# Text shapes for the derived postings (test inputs, not rules).
TITLES = ["Senior Data Engineer", "Middle Data Engineer", "  Junior   Data Analyst ",
          "Machine Learning Engineer", "Backend Developer (PHP/Laravel)", "Head of Data Science",
          "BI Developer - Power BI", "HR Specialist", "Sales Manager", "QA Engineer",
          "DevOps Engineer", "Accountant", "Civil Site Engineer", "Business Analyst",
          "AI Engineer", "Flutter Developer", "Mid-Level Python Developer", "Data Scientist Intern",
          "IT", "Graphic Designer"]
COMPANIES = ["Confidential", "Vertex Technologies", "Samsung Egypt", "ITIDA", "Smart Data Labs",
             "B Tech", "Experienced", "Cairo Cement Company", "Digital Apps Studio", "Raya Holding",
             "Nile Software Solutions Group International", "Pachin For Paints"]
LOCATIONS = ["Cairo, Egypt, On-site", "Maadi, Cairo, Egypt", "Giza, Egypt, Hybrid", "Alexandria, Egypt",
             "Riyadh, Saudi Arabia", "Egypt", "New Cairo, Cairo, Egypt, Remote",
             "Dubai, United Arab Emirates", "Sheikh Zayed, Giza, Egypt", ""]
JOB_TYPES = ["Full Time", "Part Time", "Freelance / Project", "Internship", "Remote Full Time"]
EXPERIENCE = ["· 2 - 4 Yrs of Exp", "· 5+ Yrs of Exp", "0 To 1 Year", "Not specified",
              "More Than 3 Years", "· 10 Yrs of Exp", "1 to 3 years", "· 7 - 10 Yrs of Exp"]
SKILL_POOL = ["· Python", "SQL", "Apache Spark", "Communication Skills", "English", "Power BI",
              "scikit-learn", "QuickBooks", "Stakeout", "Calendar Management", "Senior Data Engineer",
              "Docker -", "R", "AWS", "Data Analysis and Reporting", "Excel", "Tableau",
              "Machine Learning", "· Databricks", "Git", "Microsoft Office", "Kubernetes",
              "A very long skill description that clearly exceeds fifty chars", "C++"]
POSTED_TAILS = ["3 days ago", "2 weeks ago", "1 month ago", "5 hours ago", "24 hours ago",
                "2024-01-05", "15/03/2024", "yesterday", "03/25/2024"]
KEYWORDS = ["data engineer", "data analyst", "machine learning", "backend developer"]


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def _slug(v: str) -> str:
    """Constant-folded ``text.slugify(_, '-')`` for the fixed text lists."""
    import re
    return re.sub(r"[^a-z0-9]+", "-", v.lower()).strip("-")


def raw_postings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw-shaped postings (the 11 scraper fields + a position column)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    pair = F.floor(k / 2)
    title = _pick(TITLES, k)
    company = _pick(COMPANIES, F.col("o_custkey"))
    location = _pick(LOCATIONS, pair)
    tail = _pick(POSTED_TAILS, F.floor(k / 3))
    posted = F.when(k % 3 == 0, tail).otherwise(
        F.concat_ws("\n", title, F.concat_ws(" - ", company, location), tail))
    skills = F.slice(F.array(*[F.lit(s) for s in SKILL_POOL]), (k % len(SKILL_POOL)).cast("int") + 1,
                     (k % 7).cast("int"))
    job_id = F.concat_ws("-", pair.cast("string"), _pick([_slug(t) for t in TITLES], pair),
                         _pick([_slug(c) for c in COMPANIES], pair), _pick([_slug(x) for x in LOCATIONS], pair))
    scraped = F.concat(F.date_format(F.date_add(F.to_date("o_orderdate"), (k % 5).cast("int")),
                                     "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return o.select(
        k.alias("pos"),
        job_id.alias("job_id"), title.alias("title"), company.alias("company"),
        location.alias("location"), _pick(JOB_TYPES, k).alias("job_type"),
        _pick(EXPERIENCE, k).alias("experience"), skills.alias("skills"), posted.alias("posted_date"),
        F.concat(F.lit(HOST + "/jobs/p/"), job_id).alias("url"), scraped.alias("scraped_at"),
        _pick(KEYWORDS, k).alias("keyword"))


def notebook_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Notebook cleaning variants over the raw postings: F6/F7 experience
    parsers with F8 banding, F26 location split, F27 company clean, F28 label
    maps, F29 location from URL (+ F30 rebuilt location text), F36 company
    from URL, F37 district lookup,
    F41/F42 work type, F53 location-tail peeling."""
    from hirescope.functions import rules as R
    from hirescope.functions import slug as S
    r = S.with_company_from_url(raw_postings(spark, sf), "url", "title", "url_company")
    ej = P.parse_experience_patterns("experience", P.JSON_EXPERIENCE_PATTERNS)
    ec = P.parse_experience_patterns("experience", P.CSV_EXPERIENCE_PATTERNS, strip_bullet=False)
    loc = P.split_location("location")
    ul = S.location_from_url("url")
    hier = S.location_hierarchy(loc["city"])
    peel = P.peel_location_tail(F.split("location", ","))
    tail = py_strip(F.element_at(F.split("location", ","), -1))
    return r.select(
        "pos",
        ej["min_experience"].alias("json_min"), ej["max_experience"].alias("json_max"),
        ej["experience_level"].alias("json_level"),
        ec["min_experience"].alias("csv_min"), ec["max_experience"].alias("csv_max"),
        ec["experience_level"].alias("csv_level"),
        loc["city"].alias("loc_city"), loc["country"].alias("loc_country"),
        P.clean_company("company").alias("company_clean"),
        S.map_label("job_type", R.JOB_TYPE_MAP, R.JOB_TYPE_NULL).alias("job_type_label"),
        S.map_label(tail, R.WORKPLACE_MAP, R.WORKPLACE_NULL).alias("workplace_label"),
        ul["city"].alias("url_city"), ul["country"].alias("url_country"),
        F.when(ul["city"] != "Unknown", F.concat_ws(", ", ul["city"], ul["country"]))
        .otherwise("Unknown").alias("location_raw"),
        "url_company",
        hier["governorate"].alias("governorate"), hier["district"].alias("district"),
        P.work_type_from_text("title", "url").alias("work_type_title"),
        P.work_type_from_text(*[c for c in r.columns if c not in ("pos", "skills", "url_company")],
                              remote_words=P.REMOTE_WORDS_EVERYWHERE).alias("work_type_any"),
        F.array_join(peel["location"], ",").alias("peeled_location"), peel["job_type"].alias("peeled_type"))


def normalize_raw(raw: DataFrame) -> DataFrame:
    """S1 mapping: raw field names -> pipeline names, city and work type derived."""
    return raw.select(
        "pos",
        F.col("title").alias("job_title"), F.col("company").alias("company_name"), "job_type",
        F.col("experience").alias("experience_raw"), F.col("skills").alias("skills_list"),
        F.col("keyword").alias("job_category"), "posted_date", F.col("url").alias("job_url"),
        P.extract_city("location").alias("city"),
        P.extract_work_type("location", "job_type").alias("work_type"), "scraped_at")


def clean_postings(df: DataFrame, scrape_date_mode: str = "row", bullet: str = "strip", as_of=None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """M1: filter, keep the last row per URL, then derive.

    The rules read the surviving row only, so they run once per kept posting,
    and a consumer that needs few columns has the other rules pruned.

    The scrape date is ``as_of`` (a date or Column) if given; else each row's
    own scrape time (``'row'``), or that of the batch's first row by position
    (``'batch'``, a scalar subquery over two pruned columns).  Without any
    scrape time it is null; the wall clock is never read.  ``keep`` names columns
    of ``df`` to return as well.
    """
    t = df.withColumn("job_title", collapse_ws(F.coalesce(F.col("job_title"), F.lit("None"))))
    t = t.filter((F.length("job_title") > 2) & P.egypt_only("job_url", "city"))
    if as_of is not None:
        sd = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    elif scrape_date_mode == "batch":
        first = t.filter(F.col("scraped_at").isNotNull()).select(F.min_by("scraped_at", "pos")).scalar()
        sd = P.iso_to_date(first)
    else:
        sd = P.iso_to_date("scraped_at")
    t = keep_last(t, ["job_url"], ["scraped_at", "pos"])
    exp = P.parse_experience_years("experience_raw")
    t = t.withColumns({"min_experience": exp["min_experience"], "max_experience": exp["max_experience"],
                       "scrape_date": sd})
    t = t.withColumns({
        "experience_level": P.classify_experience_level("job_title", "min_experience", "experience_raw"),
        "posted_date": P.relative_posted_date("posted_date", "scrape_date"),
        "skills": clean_skills_list("skills_list", bullet=bullet),
        "job_category": P.classify_job_category("job_title"),
        "company_type": P.classify_company_type("company_name"),
    })
    return t.select("job_title", "company_name", "job_type", "skills", "job_category", "posted_date",
                    "job_url", "city", "work_type", "min_experience", "max_experience",
                    "experience_level", "scrape_date", "company_type", *keep)


def cleaned_postings(spark: SparkSession, sf: str) -> DataFrame:
    """M1 over the derived raw postings (skills kept as array)."""
    return clean_postings(normalize_raw(raw_postings(spark, sf)), scrape_date_mode="batch")


def cleaned_skills_without_bullets(spark: SparkSession, sf: str) -> DataFrame:
    """M1 skills under the stricter rule that drops bulleted skills."""
    c = clean_postings(normalize_raw(raw_postings(spark, sf)), scrape_date_mode="batch", bullet="drop")
    return c.select("job_url", list_to_text("skills").alias("skills_list"))


def cleaned_postings_report(spark: SparkSession, sf: str) -> DataFrame:
    """M1 output as written to text sinks: skills as JSON text."""
    c = cleaned_postings(spark, sf)
    return c.withColumn("skills_list", list_to_text("skills")).drop("skills")


# ------------------------------------------------------------ star schema
def staged(spark: SparkSession, sf: str) -> DataFrame:
    """M2 over the cleaned postings."""
    from hirescope.plans import star
    return star.stg_jobs(cleaned_postings(spark, sf))


def materialized_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The staging table, computed once and cut from its lineage.

    Star models read staging several times, each consumer pruning different
    columns, so Spark cannot reuse one exchange and would re-run the cleaning
    chain per branch.  Written to the shared ``spark.checkpoint.dir`` (survives
    executor loss; never a local one), every model reads its columns of the same
    stored rows -- as the production flow does with its cleaned Parquet file.
    """
    return written(staged(spark, sf))


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    from hirescope.plans import star
    return star.build_star(materialized_stage(spark, sf))


def _model(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One star model that reads staging once: nothing to store in between."""
    from hirescope.plans import star
    return star.build_star(staged(spark, sf))[name]


def stg_report(spark, sf):
    return staged(spark, sf).withColumn("skills", list_to_text("skills"))


def dim_job(spark, sf):
    return _model(spark, sf, "dim_job")


def dim_company(spark, sf):
    return _model(spark, sf, "dim_company")


def dim_location(spark, sf):
    return _model(spark, sf, "dim_location")


def dim_date(spark, sf):
    return _model(spark, sf, "dim_date")


def fact_jobs(spark, sf):
    return _model(spark, sf, "fact_jobs")


def fact_jobs_joined(spark, sf):
    """The fact table through its four left joins (same rows as fact_jobs)."""
    return _star(spark, sf)["fact_jobs_joined"]


def skill_metrics(spark, sf):
    return _star(spark, sf)["mart_job_metrics"]


def category_metrics(spark, sf):
    return _star(spark, sf)["category_metrics"]


def skill_count(spark, sf):
    """M12."""
    from hirescope.plans import star
    return star.skill_count_frame(staged(spark, sf))


def skill_category(spark, sf):
    """M13 as counts per (skill, category) -- the long-form crosstab."""
    from hirescope.plans import star
    pairs = star.skill_category_pairs(staged(spark, sf))
    return pairs.groupBy("skill_name", "job_category").agg(F.count(F.lit(1)).alias("n"))


#: Staging columns that the keys of the star's tables are made of.
KEYED = ["job_id", "job_url", "company_name", "city", "country", "posted_date"]


def integrity(spark, sf):
    """Fact rows whose foreign key has no dimension row, per relationship."""
    from hirescope.operators.quality import relationship_failures
    from hirescope.plans import star
    stg = staged(spark, sf)
    # Only what keys are made of is derived and stored; the models' other columns stand empty.
    stored = written(stg.select(*KEYED))
    s = star.build_star(stored.select(*[F.col(c) if c in KEYED else F.lit(None).cast(t).alias(c) for c, t in stg.dtypes]))
    return relationship_failures(s["fact_jobs"], {
        "company_id": (s["dim_company"], "company_id"),
        "location_id": (s["dim_location"], "location_id"),
        "date_id": (s["dim_date"], "date_id"),
        "job_id": (s["dim_job"], "job_id"),
    })


# ---------------------------------------------------------- quality / reports
def quality_checks(spark, sf):
    """Q1-Q11 over the cleaned postings; as-of = the batch scrape date."""
    from hirescope.functions import rules as R
    from hirescope.operators.quality import quality_gate
    c = written(cleaned_postings(spark, sf).withColumnRenamed("skills", "skills_list"))
    as_of = c.select(F.max("scrape_date")).scalar()
    return quality_gate(
        c, as_of, R.GATE_REQUIRED_COLUMNS, R.GATE_CRITICAL_COLUMNS, "job_url",
        {"experience_level": R.VALID_EXPERIENCE_LEVELS, "work_type": R.VALID_WORK_TYPES,
         "company_type": R.VALID_COMPANY_TYPES},
        "job_url", R.GATE_URL_PREFIX, "posted_date", R.GATE_MAX_DATE_SPAN_DAYS, "skills_list",
        R.GATE_MAX_EMPTY_SKILLS_PCT, R.GATE_MIN_ROWS, R.GATE_MAX_ROWS)


def quality_offenders(spark, sf):
    """Q5-Q7 over the raw postings: what narrow checks refuse, and how often."""
    from hirescope.operators.quality import offenders
    return offenders(raw_postings(spark, sf), {
        "job_type": ["Full Time", "Part Time", "Internship"], "company": ["Samsung Egypt", "ITIDA"], "keyword": KEYWORDS, "title": ["IT"]})


def null_profile(spark, sf):
    """A13 over the cleaned postings."""
    from hirescope.operators.quality import null_counts
    return null_counts(cleaned_postings_report(spark, sf))


def raw_completeness(spark, sf):
    """A17 / Q13 over the raw postings, one 'file' per search keyword."""
    from hirescope.functions import rules as R
    from hirescope.operators.quality import raw_completeness as rc
    raw = raw_postings(spark, sf)
    return rc(raw, "keyword", "job_id", R.RAW_REQUIRED_FIELDS, R.RAW_MISSING_TOKENS, "skills")


def raw_top_locations(spark, sf):
    """A17 top-5 locations per keyword file."""
    from hirescope.operators.quality import top_values_per_group
    return top_values_per_group(raw_postings(spark, sf), "keyword", "location", 5)


def model_tests(spark, sf):
    """Q12 over the star schema: every declared test, and some of our own."""
    from hirescope.functions import rules as R
    from hirescope.operators.quality import model_tests as mt

    def pairs(*groups):
        return [(t, c) for g in groups for t, cols in g.items() for c in cols]
    return mt(_star(spark, sf), not_null=pairs(R.MODEL_NOT_NULL, R.EXTRA_NOT_NULL), unique=pairs(R.MODEL_UNIQUE),
              accepted=R.MODEL_ACCEPTED + R.EXTRA_ACCEPTED, relationships=R.MODEL_RELATIONSHIPS + R.EXTRA_RELATIONSHIPS)


def raw_top_companies(spark, sf):
    """Top-5 companies per keyword file."""
    from hirescope.operators.quality import top_values_per_group
    return top_values_per_group(raw_postings(spark, sf), "keyword", "company", 5)


def missing_counts(spark, sf):
    """Missing values per field over all files, most missing first."""
    from hirescope.functions import rules as R
    per = raw_completeness(spark, sf)
    total = per.agg(*[F.sum(f"missing_{c}").alias(f"missing_{c}") for c in R.RAW_REQUIRED_FIELDS])
    fields = ", ".join(f"'{c}', missing_{c}" for c in R.RAW_REQUIRED_FIELDS)
    return (total.selectExpr(f"stack({len(R.RAW_REQUIRED_FIELDS)}, {fields}) AS (field, missing)")
            .orderBy(F.desc("missing"), "field"))


def top_skills_per_category(spark, sf, k: int = 3):
    """Top-k skills per job category."""
    from hirescope.operators.metrics import top_k_per_group
    from hirescope.plans import star
    per = (star.skill_pairs_with(staged(spark, sf), "job_category")
           .groupBy("job_category", "skill_name").agg(F.count(F.lit(1)).alias("n_jobs")))
    return top_k_per_group(per, "job_category", "skill_name", "n_jobs", k)


def kpis(spark, sf):
    """B1: postings, companies, skills, job-skill pairs, cities, date range."""
    s = _star(spark, sf)
    f = s["stg_jobs"].agg(F.count(F.lit(1)).alias("postings"), F.count_distinct("company_name").alias("companies"),
                          F.count_distinct("city").alias("cities"), F.min("posted_date").alias("first_posted"),
                          F.max("posted_date").alias("last_posted"))
    k = s["dim_skills"].agg(F.count(F.lit(1)).alias("skills"))
    p = s["bridge_job_skills"].agg(F.count(F.lit(1)).alias("job_skill_pairs"))
    return f.select("*", k.scalar().alias("skills"), p.scalar().alias("job_skill_pairs"))


def postings_by(col):
    def q(spark, sf):
        """Postings per value with share."""
        from hirescope.operators.metrics import value_counts
        return value_counts(staged(spark, sf).select(col), col)
    q.__name__ = f"postings_by_{col}"
    return q


def top_skills_per_level(spark, sf, k: int = 3):
    """Top-k skills per seniority level."""
    from hirescope.operators.metrics import top_k_per_group
    from hirescope.plans import star
    per = (star.skill_pairs_with(staged(spark, sf), "experience_level")
           .groupBy("experience_level", "skill_name").agg(F.count(F.lit(1)).alias("n_jobs")))
    return top_k_per_group(per, "experience_level", "skill_name", "n_jobs", k)


def skill_roadmap(spark, sf):
    """Share of a level's postings that ask for each skill."""
    from hirescope.plans import star
    stg = materialized_stage(spark, sf)
    lvl = stg.groupBy("experience_level").agg(F.count(F.lit(1)).alias("level_jobs"))
    per = (star.skill_pairs_with(stg, "experience_level")
           .groupBy("experience_level", "skill_name").agg(F.count(F.lit(1)).alias("n_jobs")))
    # one row per level; levels come from the four-value classifier (F9), a
    # proven bound, so the level table is broadcast
    return (per.join(F.broadcast(lvl), "experience_level")
            .withColumn("share_pct", F.round(F.col("n_jobs").cast("double") * 100.0 / F.col("level_jobs"), 2)))


def notebook_categories_skills(spark, sf):
    """F22 -> F23 -> F24 on titles; F15 / F16 / F17 / F18 skill cleaners on
    the raw skill lists (sorted '|'-joined, since the originals return sets)."""
    from hirescope.functions import rules as R
    from hirescope.functions.skills import clean_skills_policy, clean_skills_regex, parse_list_literal
    r = raw_postings(spark, sf)
    wide = P.classify_category_wide("title")
    std = P.collapse_category(wide)

    def j(a):
        return F.array_join(F.array_sort(a), "|")
    late = clean_skills_list(parse_list_literal(F.to_json("skills")), bullet="drop", vocabulary=False,
                             markers=R.SKILL_MARKERS_LATE, noise=R.SKILL_NOISE_LATE)
    return r.select(
        "pos", wide.alias("category_wide"), std.alias("category_std"),
        P.reclassify_other(std, "title").alias("category_final"),
        j(clean_skills_regex("skills", R.SKILL_NOISE_PATTERNS_V1)).alias("skills_v1"),
        j(clean_skills_policy("skills", R.SKILL_REMOVE_ITEMS, bullet="drop")).alias("skills_v2"),
        j(clean_skills_policy("skills", R.SKILL_REMOVE_ITEMS, bullet="strip")).alias("skills_final"),
        F.array_join(late, "|").alias("skills_late"))


def notebook_location_refine(spark, sf):
    """F26 -> F37 -> F38 -> F39 -> F40 -> P11: governorate / district from the
    location text, refined from the URL, rows without an Egyptian city dropped."""
    from hirescope.functions import rules as R
    from hirescope.functions import slug as S
    r = raw_postings(spark, sf)
    loc = P.split_location("location")
    hier = S.location_hierarchy(loc["city"])
    t = r.select("pos", "url", hier["governorate"].alias("governorate"), hier["district"].alias("district"))
    t = t.withColumn("governorate", S.governorate_from_url("governorate", "url"))
    t = t.withColumn("gov_allowed", F.col("governorate").isin(R.EGYPT_GOVERNORATES)
                     & ~F.col("governorate").isin(R.INTERNATIONAL_CITIES))
    t = t.withColumn("district", S.district_from_url("url", "district"))
    t = t.withColumn("city", S.city_from_district("district", "governorate"))
    t = t.withColumn("city", S.final_city_check("city", "url"))
    return t.filter(F.col("city") != "To Drop").select("pos", "governorate", "gov_allowed", "district", "city")


def audit_profile(spark, sf):
    """Q14 over the cleaned postings."""
    from hirescope.operators.quality import audit_profile as ap
    return ap(cleaned_postings(spark, sf).drop("skills"))


def level_before_after(spark, sf):
    """Q15: experience-level distribution from the years-only banding
    versus the title-first classifier (F9), with the delta per level."""
    from hirescope.operators.metrics import before_after
    r = normalize_raw(raw_postings(spark, sf))
    before = r.select(P.parse_experience_patterns("experience_raw", P.JSON_EXPERIENCE_PATTERNS)["experience_level"]
                      .alias("experience_level"))
    exp = P.parse_experience_years("experience_raw")
    after = r.select(P.classify_experience_level("job_title", exp["min_experience"], "experience_raw")
                     .alias("experience_level"))
    return before_after(before.na.fill("unbanded"), after, "experience_level")


def empty_skills_share(spark, sf):
    """Percent of cleaned postings whose skill list is empty, per category."""
    c = cleaned_postings(spark, sf)
    e = F.when(F.coalesce(F.size("skills"), F.lit(0)) <= 0, 1.0).otherwise(0.0)
    return c.groupBy("job_category").agg(F.round(F.avg(e) * 100.0, 2).alias("empty_pct"),
                                         F.count(F.lit(1)).alias("postings"))


def sample_postings(spark, sf, n: int = 25):
    """A repeatable sample of n cleaned postings (seeded hash of the URL)."""
    from hirescope.operators.metrics import repeatable_sample
    return repeatable_sample(cleaned_postings_report(spark, sf), "job_url", n)


def warehouse_load_shape(spark, sf):
    """P5 / P6 / S13 input: the cleaned postings as loaded into the raw
    warehouse table -- dates as text, upper-case column names."""
    c = cleaned_postings_report(spark, sf)
    c = c.withColumns({"posted_date": F.col("posted_date").cast("string"),
                       "scrape_date": F.col("scrape_date").cast("string")})
    return c.toDF(*[x.upper() for x in c.columns])


def skill_count_sql(spark, sf):
    """The statistics script's first query, run as SQL over the
    star models exposed as (uniquely named) temp views."""
    import uuid
    s = _star(spark, sf)
    tag = uuid.uuid4().hex[:8]
    for name in ("dim_job", "bridge_job_skills"):
        s[name].createOrReplaceTempView(f"{name}_{tag}")
    return spark.sql(f"""
        SELECT j.job_id, j.experience_level, j.job_category, COUNT(DISTINCT b.skill_id) AS skill_count
        FROM dim_job_{tag} j JOIN bridge_job_skills_{tag} b ON j.job_id = b.job_id
        GROUP BY j.job_id, j.experience_level, j.job_category""")


def combine_sources(json_postings: DataFrame, csv_postings: DataFrame) -> DataFrame:
    """JSON- and CSV-sourced raw postings aligned by name
    (missing columns null) and de-duplicated by URL, first source wins."""
    j = json_postings.withColumn("_src", F.lit(0))
    c = csv_postings.withColumn("_src", F.lit(1))
    u = j.unionByName(c, allowMissingColumns=True)
    if "pos" not in u.columns:
        u = u.withColumn("pos", F.lit(0))
    order = ["_src", "pos"]
    return keep_first(u, ["url"], order).drop("_src")


def notebook_company_drafts(spark, sf):
    """F31-F35 over the raw postings' URLs and titles."""
    from hirescope.functions import slug as S
    r = raw_postings(spark, sf).select("pos", "url", "title")
    return S.with_company_drafts(r, "url", "title").drop("url", "title")


def _projection_rules() -> dict:
    """Named column rules that a projection table may use."""
    from hirescope.functions import rules as R
    from hirescope.functions import slug as S
    from hirescope.functions.skills import clean_skills_policy, first_of_list_literal, parse_list_literal
    rules = {"copy": lambda c: c, "clean_company": P.clean_company,
             "job_type": lambda c: S.map_label(c, R.JOB_TYPE_MAP, R.JOB_TYPE_NULL),
             "city": lambda c: P.split_location(c)["city"], "country": lambda c: P.split_location(c)["country"],
             "skills": lambda c: clean_skills_policy(c, R.SKILL_REMOVE_ITEMS, bullet="strip"),
             "skills_of_text": lambda c: clean_skills_policy(parse_list_literal(c), R.SKILL_REMOVE_ITEMS, bullet="strip"),
             "first_of_text": first_of_list_literal}
    for field in ("min_experience", "max_experience", "experience_level"):
        rules[f"json_{field}"] = lambda c, f=field: P.parse_experience_patterns(c, P.JSON_EXPERIENCE_PATTERNS)[f]
        rules[f"csv_{field}"] = lambda c, f=field: P.parse_experience_patterns(c, P.CSV_EXPERIENCE_PATTERNS, strip_bullet=False)[f]
    return rules


def notebook_projections(spark: SparkSession) -> DataFrame:
    """Both notebook projections as one mapping table."""
    from hirescope.functions import rules as R
    from hirescope.operators.mapping import SCHEMA
    rows = [(source, i, target, *R.NOTEBOOK_PROJECTIONS[source][target])
            for source in R.NOTEBOOK_PROJECTIONS for i, target in enumerate(R.NOTEBOOK_PROJECTIONS[source])]
    return spark.createDataFrame(rows, SCHEMA)


def combine_projected(sources: dict[str, DataFrame], mapping: DataFrame, order: str = "pos") -> DataFrame:
    """Each source through its projection, the union, and per URL
    the row of the first source, then of the least ``order``."""
    from hirescope.operators.mapping import compile_mapping, project
    rules = _projection_rules()
    columns = compile_mapping(mapping, rules)
    parts = [project(df, columns[name], rules, (order,)).withColumn("_src", F.lit(i)) for i, (name, df) in enumerate(sources.items())]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return keep_first(union, ["job_url"], ["_src", order]).drop("_src")


def notebook_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Two sources derived from the raw postings: JSON records, and the rows of
    the CSV export, whose lists are text.  Some URLs are in both."""
    raw = raw_postings(spark, sf)
    quoted = F.concat(F.lit("['"), F.array_join("skills", "', '"), F.lit("']"))
    csv = raw.where(F.col("pos") % 2 == 1).select(
        "pos", F.col("url").alias("job_url"), F.concat(F.lit("['"), F.col("keyword"), F.lit("', 'other']")).alias("search_keywords"),
        F.col("title").alias("job_title"), "posted_date", "job_type", "experience",
        F.when(F.size("skills") > 0, quoted).otherwise("").alias("skills"))
    return {"json": raw.where(F.col("pos") % 8 < 4), "csv": csv}


def notebook_combined(spark: SparkSession, sf: str) -> DataFrame:
    """M14 over two derived sources: projected, combined, first source kept."""
    out = combine_projected(notebook_sources(spark, sf), notebook_projections(spark))
    return out.withColumn("skills_list", F.array_join(F.array_sort("skills_list"), "|"))


def audit_report(spark, sf):
    """Q14: shape, nulls, distributions, date ranges and repeats of the cleaned postings."""
    from hirescope.operators.profile import audit
    return audit(cleaned_postings_report(spark, sf), "job_url", ["experience_level", "work_type", "company_type", "job_category"],
                 ["posted_date", "scrape_date"])


def audit_sketches(spark, sf):
    """Q14, A10: one profile state per year of the orders, merged; estimates, so without an SQL twin."""
    from hirescope.operators import profile
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("o_orderdate"))
    parts = [profile.state(o.where(F.year("o_orderdate") % 3 == y)) for y in range(3)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    return profile.report(profile.merge(states))


def notebook_work_types(spark, sf):
    """The remote flag, and work types with the seeded relabelling."""
    from hirescope.functions import slug as S
    c = cleaned_postings(spark, sf)
    return c.select("job_url", "work_type", S.is_remote("work_type").alias("is_remote"),
                    S.flexible_work_type("work_type", "job_title", "company_name", "job_url").alias("flexible_type"))


def notebook_governorates(spark, sf):
    """P10 as a filter: postings per Egyptian governorate."""
    from hirescope.functions.slug import egyptian_governorates
    kept = egyptian_governorates(notebook_location_refine(spark, sf).drop("gov_allowed"))
    return kept.groupBy("governorate").agg(F.count("*").alias("n"))


def job_metrics_ordered(spark, sf):
    """O1: the skill mart, ordered when it is read: most demanded first."""
    return skill_metrics(spark, sf).orderBy(F.desc("skill_demand_score"), "skill_name")
