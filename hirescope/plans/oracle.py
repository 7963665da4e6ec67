"""Independent DuckDB SQL for each registered query.

These restate each rule in plain SQL (CASE / LIKE / contains / window
functions) over the driver's views; they share only the fixed rule *values*
with the Spark side.
"""

from __future__ import annotations

from hirescope.functions import rules as R

NULL_TOKEN = R.SURROGATE_NULL_TOKEN


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sk(*exprs: str) -> str:
    """Surrogate key spelled out: md5 of '-'-joined, null -> token."""
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), {q(NULL_TOKEN)})" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def contains_any(expr: str, kws) -> str:
    kws = [k for k in dict.fromkeys(kws) if k != ""]
    return "(" + " OR ".join(f"contains({expr}, {q(k)})" for k in kws) + ")"


DOC_URL = "('https://wuzzuf.net/jobs/p/doc-' || CAST(doc_id AS VARCHAR))"
DOC_PAIRS = f"""
  SELECT DISTINCT {sk(DOC_URL)} AS job_id, trim(tok) AS skill_name
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS tok FROM documents)
  WHERE tok IS NOT NULL AND length(trim(tok)) > 1
"""


def demand_case(x: str) -> str:
    arms = " ".join(f"WHEN {x} >= {b} THEN {q(l)}" for b, l in R.DEMAND_BUCKETS)
    return f"CASE {arms} ELSE {q(R.DEMAND_DEFAULT)} END"


ORACLE: dict[str, str] = {}

ORACLE["skill_demand_mart"] = f"""
WITH pairs AS ({DOC_PAIRS}),
total AS (SELECT count(*)::DOUBLE AS n FROM documents),
per AS (SELECT skill_name, count(DISTINCT job_id) AS jobs_requiring_skill FROM pairs GROUP BY skill_name)
SELECT skill_name, jobs_requiring_skill,
       round(jobs_requiring_skill::DOUBLE * 100.0 / (SELECT n FROM total), 2) AS skill_demand_score,
       round(100 - jobs_requiring_skill::DOUBLE * 100.0 / (SELECT n FROM total), 2) AS skill_rarity_score,
       {demand_case("round(jobs_requiring_skill::DOUBLE * 100.0 / (SELECT n FROM total), 2)")} AS demand_category
FROM per
"""

ORACLE["dim_skills"] = f"""
SELECT {sk('skill_name')} AS skill_id, skill_name
FROM (SELECT DISTINCT skill_name FROM ({DOC_PAIRS}))
"""

ORACLE["bridge_job_skills"] = f"""
SELECT job_id, {sk('skill_name')} AS skill_id FROM ({DOC_PAIRS})
"""

ORACLE["top_skills"] = f"""
SELECT skill_name, count(*) AS n_jobs FROM ({DOC_PAIRS})
GROUP BY skill_name ORDER BY n_jobs DESC, skill_name LIMIT 20
"""

ORACLE["skill_slice"] = f"""
SELECT skill_name FROM (SELECT DISTINCT skill_name FROM ({DOC_PAIRS}))
ORDER BY skill_name OFFSET 50 LIMIT 50
"""


# ---------------------------------------------------------------- postings
# Unicode White_Space, as Java's (?U)\\s and Python's str.strip() see it.
UWS = "[\\t\\n\\x0B\\f\\r \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{UWS}+|{UWS}+$', '', 'g')"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def inlist(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def case_rules(x: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN {contains_any(x, kws)} THEN {q(label)}" for label, kws in rules)
    return f"CASE {arms} ELSE {q(default)} END"


RAW_SQL = ""


def _postings_sql(bullet: str = "strip") -> str:
    from hirescope.plans import postings as PT
    k = "o_orderkey"
    title = f"{lst(PT.TITLES)}[({k} % {len(PT.TITLES)}) + 1]"
    company = f"{lst(PT.COMPANIES)}[(o_custkey % {len(PT.COMPANIES)}) + 1]"
    location = f"{lst(PT.LOCATIONS)}[(({k} // 2) % {len(PT.LOCATIONS)}) + 1]"
    tail = f"{lst(PT.POSTED_TAILS)}[((({k} // 3)) % {len(PT.POSTED_TAILS)}) + 1]"
    n = len(PT.SKILL_POOL)
    def slug(x):
        return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"
    t_pair = f"{lst(PT.TITLES)}[(({k} // 2) % {len(PT.TITLES)}) + 1]"
    c_pair = f"{lst(PT.COMPANIES)}[(({k} // 2) % {len(PT.COMPANIES)}) + 1]"
    job_id = f"concat_ws('-', CAST({k} // 2 AS VARCHAR), {slug(t_pair)}, {slug(c_pair)}, {slug(location)})"
    raw = f"""
    SELECT {k} AS pos, {job_id} AS job_id, {title} AS title, {company} AS company, {location} AS location,
      {lst(PT.JOB_TYPES)}[({k} % {len(PT.JOB_TYPES)}) + 1] AS job_type,
      {lst(PT.EXPERIENCE)}[({k} % {len(PT.EXPERIENCE)}) + 1] AS experience,
      list_slice({lst(PT.SKILL_POOL)}, ({k} % {n}) + 1, ({k} % {n}) + ({k} % 7)) AS skills,
      CASE WHEN {k} % 3 = 0 THEN {tail}
           ELSE concat_ws(chr(10), {title}, concat_ws(' - ', {company}, {location}), {tail}) END AS posted_raw,
      {q(PT.HOST + '/jobs/p/')} || {job_id} AS url,
      strftime(CAST(o_orderdate AS DATE) + CAST({k} % 5 AS INTEGER), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS scraped_at,
      {lst(PT.KEYWORDS)}[({k} % {len(PT.KEYWORDS)}) + 1] AS keyword
    FROM orders"""
    global RAW_SQL
    RAW_SQL = raw
    non_city = inlist(R.NON_CITY_PARTS)
    city = f"""CASE WHEN location IS NULL OR location = '' OR location = 'Egypt' THEN {q(R.DEFAULT_CITY)}
      ELSE coalesce(list_filter(list_transform(string_split(location, ','), lambda p: {strip('p')}),
                                lambda p: lower(p) NOT IN {non_city})[1], {q(R.DEFAULT_CITY)}) END"""
    combo = "lower(concat_ws(' ', location, job_type))"
    work = f"CASE WHEN contains({combo}, 'remote') THEN 'Remote' WHEN contains({combo}, 'hybrid') THEN 'Hybrid' ELSE 'On-site' END"
    norm = f"""
    SELECT pos, regexp_replace({strip('title')}, '{UWS}+', ' ', 'g') AS job_title, company AS company_name,
      job_type, experience AS experience_raw, skills AS skills_list, posted_raw, url AS job_url,
      {city} AS city, {work} AS work_type, scraped_at
    FROM ({raw})"""
    kept = f"""
    SELECT * FROM ({norm})
    WHERE length(job_title) > 2
      AND NOT {contains_any('lower(job_url)', R.NON_EGYPT_URL_PATTERNS)}
      AND lower(city) NOT IN {inlist(R.NON_EGYPT_CITIES)}"""
    s = f"lower({strip('experience_raw')})"
    rng, plus = r"(\d+)\s*[-to]+\s*(\d+)", r"(\d+)\+|more than (\d+)"
    mn = f"""CASE WHEN regexp_matches({s}, '{rng}') THEN TRY_CAST(regexp_extract({s}, '{rng}', 1) AS DOUBLE)
      WHEN regexp_matches({s}, '{plus}') THEN TRY_CAST(coalesce(nullif(regexp_extract({s}, '{plus}', 1), ''),
                                                              nullif(regexp_extract({s}, '{plus}', 2), '')) AS DOUBLE) END"""
    mx = f"CASE WHEN regexp_matches({s}, '{rng}') THEN TRY_CAST(regexp_extract({s}, '{rng}', 2) AS DOUBLE) END"
    t = "lower(job_title)"
    lvl_arms = " ".join(f"WHEN {contains_any(t, kws)} THEN {q(label)}" for label, kws in R.LEVEL_TITLE_RULES)
    yrs = " ".join(f"WHEN min_experience <= {b} THEN {q(l)}" for b, l in R.LEVEL_YEAR_BANDS)
    level = f"""CASE {lvl_arms} {yrs} WHEN min_experience IS NOT NULL THEN {q(R.LEVEL_YEAR_TOP)}
      WHEN {contains_any('lower(experience_raw)', R.LEVEL_RAW_JUNIOR_HINTS)} THEN 'junior' ELSE {q(R.LEVEL_DEFAULT)} END"""
    lines = f"list_filter(list_transform(string_split(posted_raw, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"
    p = f"lower(CASE WHEN contains(posted_raw, chr(10)) THEN ({lines})[-1] ELSE {strip('posted_raw')} END)"

    def n_of(unit):
        return f"CAST(regexp_extract({p}, '(\\d+)\\s+{unit}', 1) AS INTEGER)"
    posted = f"""CASE WHEN regexp_matches({p}, '(\\d+)\\s+hour') THEN sd
      WHEN regexp_matches({p}, '(\\d+)\\s+day') THEN sd - {n_of('day')}
      WHEN regexp_matches({p}, '(\\d+)\\s+week') THEN sd - {n_of('week')} * 7
      WHEN regexp_matches({p}, '(\\d+)\\s+month') THEN sd - {n_of('month')} * 30
      ELSE coalesce(CAST(coalesce(try_strptime({p}, '%Y-%m-%d'), try_strptime({p}, '%d/%m/%Y'),
                                  try_strptime({p}, '%m/%d/%Y')) AS DATE), sd) END"""
    words = " + ".join(f"CAST(contains(lower(x), {q(w)}) AS INTEGER)" for w in dict.fromkeys(R.SKILL_TITLE_WORDS))
    marks = R.SKILL_SENTENCE_MARKERS if bullet == "drop" else [m for m in R.SKILL_SENTENCE_MARKERS if m not in ("·", "•", "✔")]
    skill_ok = (f"length(x) <= {R.SKILL_MAX_LEN} AND NOT {contains_any('x', marks)} "
                f"AND lower(x) NOT IN {inlist(R.SKILL_NOISE)} AND ({words}) < 2 "
                f"AND {contains_any('lower(x)', R.TECH_SKILLS_VOCAB)}")
    plain = strip(chr(99) + 'oalesce(x, ' + q('None') + ')')
    if bullet == "strip":
        plain = strip(f"regexp_replace({plain}, '^[·•✔][ \\t\\n\\x0B\\f\\r]*', '')")
    skills = (f"list_filter(list_transform(skills_list, lambda x: {plain}), "
              f"lambda x: {skill_ok})")
    cat = case_rules("lower(job_title)", R.CATEGORY_RULES, R.CATEGORY_DEFAULT)
    ovr = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.COMPANY_OVERRIDES.items())
    cn = "company_name"
    score = " + ".join(f"CAST(contains(lower({cn}), {q(w)}) AS INTEGER)" for w in dict.fromkeys(R.STARTUP_KEYWORDS))
    nwords = f"len(list_filter(regexp_split_to_array({strip(cn)}, '\\s+'), lambda w: w <> ''))"
    ctype = f"""CASE WHEN {cn} IS NULL OR lower({strip(cn)}) IN {inlist(R.COMPANY_UNKNOWN_NAMES)} THEN 'Unknown'
      WHEN {cn} IN {inlist(R.COMPANY_OVERRIDES)} THEN (CASE {cn} {ovr} END)
      WHEN {contains_any(f'lower({cn})', R.KNOWN_MNCS)} THEN 'MNC'
      WHEN {contains_any(f'lower({cn})', R.GOVERNMENT_KEYWORDS)} THEN 'Government'
      WHEN ({score}) >= 2 THEN 'Startup'
      WHEN ({score}) = 1 AND {nwords} <= 3 THEN 'Startup'
      ELSE 'Corporate' END"""
    return f"""
    WITH kept AS ({kept}),
    bat AS (SELECT CAST(left(arg_min(scraped_at, pos), 10) AS DATE) AS sd FROM kept WHERE scraped_at IS NOT NULL),
    e AS (SELECT kept.*, {mn} AS min_experience, {mx} AS max_experience, bat.sd AS sd FROM kept, bat),
    c AS (
      SELECT pos, scraped_at, job_title, company_name, job_type, {skills} AS skills, {cat} AS job_category,
             {posted} AS posted_date, job_url, city, work_type, min_experience, max_experience,
             {level} AS experience_level, sd AS scrape_date, {ctype} AS company_type
      FROM e),
    d AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY scraped_at DESC, pos DESC) AS rn FROM c)
    SELECT job_title, company_name, job_type, job_category, posted_date, job_url, city, work_type,
           min_experience, max_experience, experience_level, scrape_date, company_type, skills
    FROM d WHERE rn = 1"""


POSTINGS = _postings_sql()
ORACLE["cleaned_postings"] = f"""
SELECT * EXCLUDE (skills), CAST(to_json(skills) AS VARCHAR) AS skills_list FROM ({POSTINGS})
"""
ORACLE["cleaned_skills_without_bullets"] = f"""
SELECT job_url, CAST(to_json(skills) AS VARCHAR) AS skills_list FROM ({_postings_sql("drop")})
"""

STG = f"""
SELECT {sk('job_url')} AS job_id, trim(job_title) AS job_title, trim(lower(job_category)) AS job_category,
  trim(lower(experience_level)) AS experience_level, trim(job_type) AS job_type, trim(work_type) AS work_type,
  job_url, skills, min_experience, max_experience,
  CASE WHEN min_experience IS NOT NULL AND max_experience IS NOT NULL THEN max_experience - min_experience END AS experience_gap,
  trim(company_name) AS company_name, trim(company_type) AS company_type, trim(city) AS city, 'Egypt' AS country,
  posted_date, scrape_date, date_diff('day', posted_date, scrape_date) AS days_on_market
FROM ({POSTINGS}) WHERE job_url IS NOT NULL
"""
ORACLE["stg_jobs"] = f"SELECT * EXCLUDE (skills), CAST(to_json(skills) AS VARCHAR) AS skills FROM ({STG})"
ORACLE["dim_job"] = f"SELECT job_id, job_title, job_category, experience_level, scrape_date FROM ({STG})"
DIM_COMPANY = f"""
SELECT {sk('company_name')} AS company_id, company_name, company_type FROM (
  SELECT company_name, arg_max(company_type, struct_pack(d := scrape_date, t := company_type)) AS company_type
  FROM ({STG}) WHERE company_name IS NOT NULL GROUP BY company_name)
"""
ORACLE["dim_company"] = DIM_COMPANY
DIM_LOCATION = f"""
SELECT {sk('city', 'country')} AS location_id, city, country
FROM (SELECT DISTINCT city, country FROM ({STG}) WHERE city IS NOT NULL)
"""
ORACLE["dim_location"] = DIM_LOCATION
DIM_DATE = f"""
SELECT {sk('full_date')} AS date_id, full_date, day(full_date) AS day, month(full_date) AS month,
  year(full_date) AS year, quarter(full_date) AS quarter, weekofyear(full_date) AS week_of_year,
  dayofweek(full_date) AS day_of_week, monthname(full_date) AS month_name, dayname(full_date) AS day_name
FROM (SELECT DISTINCT posted_date AS full_date FROM ({STG}) WHERE posted_date IS NOT NULL)
"""
ORACLE["dim_date"] = DIM_DATE
FACT = f"""
SELECT {sk('stg.job_url')} AS fact_id, stg.job_id, co.company_id, lo.location_id, da.date_id,
  stg.min_experience, stg.max_experience, stg.job_type, stg.work_type, stg.job_url
FROM ({STG}) stg
LEFT JOIN ({DIM_COMPANY}) co ON stg.company_name = co.company_name
LEFT JOIN ({DIM_LOCATION}) lo ON stg.city = lo.city
LEFT JOIN ({DIM_DATE}) da ON stg.posted_date = da.full_date
"""
ORACLE["fact_jobs"] = FACT
ORACLE["fact_jobs_joined"] = FACT
PAIRS = f"""
SELECT DISTINCT job_id, skill_name FROM (
  SELECT job_id, trim(lower(s)) AS skill_name FROM (SELECT job_id, unnest(skills) AS s FROM ({STG})))
WHERE skill_name IS NOT NULL AND length(skill_name) > 1
"""
ORACLE["job_skill_metrics"] = f"""
WITH t AS (SELECT count(*)::DOUBLE AS n FROM ({FACT})),
per AS (SELECT skill_name, count(DISTINCT job_id) AS c FROM ({PAIRS}) GROUP BY skill_name)
SELECT skill_name, c AS jobs_requiring_skill,
  round(c::DOUBLE * 100.0 / (SELECT n FROM t), 2) AS skill_demand_score,
  round(100 - c::DOUBLE * 100.0 / (SELECT n FROM t), 2) AS skill_rarity_score,
  {demand_case("round(c::DOUBLE * 100.0 / (SELECT n FROM t), 2)")} AS demand_category
FROM per
"""
ORACLE["category_metrics"] = f"""
WITH f AS ({FACT}), t AS (SELECT count(*)::DOUBLE AS n FROM f)
SELECT j.job_category, j.experience_level, count(f.job_id) AS job_count,
  round(avg(f.min_experience), 1) AS avg_min_experience,
  round(avg(CASE WHEN f.work_type = 'Remote' THEN 1.0 ELSE 0.0 END) * 100, 2) AS remote_ratio,
  round(count(f.job_id)::DOUBLE * 100.0 / (SELECT n FROM t), 2) AS market_demand_index
FROM f JOIN ({STG}) j ON f.job_id = j.job_id
GROUP BY j.job_category, j.experience_level
"""
ORACLE["skill_count_per_job"] = f"""
SELECT j.job_id, j.experience_level, j.job_category, count(DISTINCT p.skill_name) AS skill_count
FROM ({STG}) j JOIN ({PAIRS}) p ON j.job_id = p.job_id
GROUP BY j.job_id, j.experience_level, j.job_category
"""
ORACLE["skill_category_crosstab"] = f"""
SELECT p.skill_name, j.job_category, count(*) AS n
FROM ({PAIRS}) p JOIN ({STG}) j ON p.job_id = j.job_id GROUP BY 1, 2
"""
ORACLE["star_integrity"] = f"""
WITH f AS ({FACT})
SELECT 'company_id' AS relationship, count(*) AS failures FROM f WHERE company_id IS NOT NULL AND company_id NOT IN (SELECT company_id FROM ({DIM_COMPANY}))
UNION ALL SELECT 'location_id', count(*) FROM f WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT location_id FROM ({DIM_LOCATION}))
UNION ALL SELECT 'date_id', count(*) FROM f WHERE date_id IS NOT NULL AND date_id NOT IN (SELECT date_id FROM ({DIM_DATE}))
UNION ALL SELECT 'job_id', count(*) FROM f WHERE job_id IS NOT NULL AND job_id NOT IN (SELECT job_id FROM ({STG}))
"""

# ------------------------------------------------------------------ events
EV = "event_id, ts, user_id, event_type, value, props"
ORACLE["latest_event_per_user"] = f"""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""
ORACLE["first_event_per_user"] = f"""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
"""
ORACLE["repeated_user_day_type"] = """
SELECT event_id, user_id, event_type, day FROM (
  SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
         count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type) AS c FROM events) WHERE c > 1
"""
ORACLE["duplicate_user_count"] = f"""
SELECT count(*) - count(DISTINCT user_id) AS duplicates,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {EV} FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL
     AND user_id IS NOT NULL AND event_type IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL)) AS duplicate_rows
FROM events
"""
ORACLE["user_event_sequence"] = """
SELECT user_id, string_agg(event_type, ',' ORDER BY ft, fi) AS event_type_list FROM (
  SELECT user_id, event_type, min(ts) AS ft, arg_min(event_id, struct_pack(t := ts, i := event_id)) AS fi
  FROM events GROUP BY user_id, event_type) GROUP BY user_id
"""
ORACLE["first_type_per_user"] = """
SELECT event_type, count(*) AS new_unique FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1 GROUP BY event_type
"""
ORACLE["event_props"] = """
SELECT event_type, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       count(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS n_k, count(*) AS n
FROM events GROUP BY event_type
"""
ORACLE["incremental_events"] = f"""
WITH src AS (SELECT {EV}, CAST(ts AS DATE) AS day FROM events),
tgt AS (SELECT event_id, ts, user_id, event_type, 0.0::DOUBLE AS value, props, day, 'target' AS origin
        FROM src WHERE ts < TIMESTAMP '2024-01-16'),
inc AS (SELECT {EV}, day, 'increment' AS origin FROM src WHERE day >= (SELECT max(day) FROM tgt))
SELECT * FROM tgt WHERE event_id NOT IN (SELECT event_id FROM inc)
UNION ALL SELECT * FROM inc
"""
ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
UPS = f"""
tgt AS (SELECT {ORD} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
src AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
               o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
"""
ORACLE["upsert_orders"] = f"""
WITH {UPS}
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src
"""
ORACLE["upsert_order_counts"] = f"""
WITH {UPS}
SELECT (SELECT count(*) FROM tgt WHERE o_orderkey IN (SELECT o_orderkey FROM src)) AS updated_count,
       (SELECT count(*) FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)) AS appended_count,
       (SELECT count(*) FROM (SELECT o_orderkey FROM tgt UNION SELECT o_orderkey FROM src)) AS total_rows
"""
ORACLE["fieldwise_order_update"] = f"""
WITH {UPS}
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey,
       coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey
"""

# ----------------------------------------------------------------- reports
ORACLE["segment_value_counts"] = """
SELECT c_mktsegment, count(*) AS count,
  round(count(*)::DOUBLE * 100.0 / (SELECT count(*) FROM customer WHERE c_mktsegment IS NOT NULL), 2) AS share_pct
FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1
"""
ORACLE["priority_status_counts"] = """
SELECT o_orderpriority, o_orderstatus, count(*) AS count FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2
"""
ORACLE["distinct_counts"] = """
SELECT count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderpriority) AS n_priorities,
  CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
"""
PER_ORDER = """
SELECT o.o_orderkey, o.o_orderpriority, o.o_custkey, p.skill_count FROM orders o JOIN
  (SELECT l_orderkey, count(DISTINCT l_partkey) AS skill_count FROM lineitem GROUP BY 1) p ON o.o_orderkey = p.l_orderkey
"""
ORACLE["parts_per_order_anova"] = f"""
WITH d AS ({PER_ORDER}), g AS (SELECT o_orderpriority, count(*) AS n, avg(skill_count) AS m FROM d GROUP BY 1),
gm AS (SELECT avg(skill_count) AS mu, count(*) AS nn, (SELECT count(*) FROM g) AS k FROM d),
ssb AS (SELECT sum(n * (m - (SELECT mu FROM gm)) ^ 2) AS v FROM g),
ssw AS (SELECT sum((skill_count - g.m) ^ 2) AS v FROM d JOIN g USING (o_orderpriority))
SELECT round(((SELECT v FROM ssb) / (k - 1)) / ((SELECT v FROM ssw) / (nn - k)), 6) AS f_stat,
       k - 1 AS df_between, nn - k AS df_within, nn AS n FROM gm
"""
ORACLE["parts_per_order_by_level"] = f"""
SELECT o_orderpriority, round(avg(skill_count), 6) AS mean, count(skill_count) AS count FROM ({PER_ORDER}) GROUP BY 1
"""
ORACLE["segment_correlation"] = f"""
SELECT round(corr(posting_count, avg_skill_count), 6) AS r, count(*) AS n FROM (
  SELECT c.c_mktsegment, count(*) AS posting_count, avg(d.skill_count) AS avg_skill_count
  FROM ({PER_ORDER}) d JOIN customer c ON d.o_custkey = c.c_custkey GROUP BY 1)
"""
CELLS = """
WITH pr AS (SELECT p.p_brand, o.o_orderpriority FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
            JOIN orders o ON l.l_orderkey = o.o_orderkey),
top AS (SELECT p_brand FROM pr GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 20)
SELECT p_brand, o_orderpriority, count(*) AS n FROM pr WHERE p_brand IN (SELECT p_brand FROM top) GROUP BY 1, 2
"""
ORACLE["brand_priority_crosstab"] = CELLS
ORACLE["brand_priority_chi_square"] = f"""
WITH c AS ({CELLS}), r AS (SELECT p_brand, sum(n) AS rs FROM c GROUP BY 1),
k AS (SELECT o_orderpriority, sum(n) AS cs FROM c GROUP BY 1), t AS (SELECT sum(n) AS nn FROM c),
allcells AS (SELECT r.p_brand, k.o_orderpriority, r.rs * k.cs / t.nn AS e, coalesce(c.n, 0) AS o
             FROM r CROSS JOIN k CROSS JOIN t LEFT JOIN c ON c.p_brand = r.p_brand AND c.o_orderpriority = k.o_orderpriority)
SELECT round(sum((o - e) ^ 2 / e), 4) AS chi2,
       ((SELECT count(*) FROM r) - 1) * ((SELECT count(*) FROM k) - 1) AS dof, CAST((SELECT nn FROM t) AS BIGINT) AS n FROM allcells
"""
ORACLE["weekly_velocity"] = """
SELECT year(date_trunc('week', CAST(o_orderdate AS DATE))) AS week_year, weekofyear(CAST(o_orderdate AS DATE)) AS week_of_year,
       count(*) AS postings FROM orders GROUP BY 1, 2
"""
ORACLE["daily_velocity"] = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS postings FROM orders GROUP BY 1"
ORACLE["monthly_share_change"] = """
SELECT month, share_pct, postings, round(share_pct - lag(share_pct) OVER (ORDER BY month), 2) AS change_pct FROM (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 2) AS share_pct, count(*) AS postings
  FROM orders GROUP BY 1)
"""
ORACLE["days_to_ship"] = """
SELECT date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS days_on_market, count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1
"""
ORACLE["top_customers"] = """
SELECT c.c_name, p.postings FROM (SELECT o_custkey, count(*) AS postings FROM orders GROUP BY 1) p
JOIN customer c ON p.o_custkey = c.c_custkey ORDER BY postings DESC, c_name LIMIT 10
"""
ORACLE["priority_funnel"] = """
SELECT o_orderpriority, count(*) AS count,
  round(count(*)::DOUBLE * 100.0 / (SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL), 2) AS share_pct,
  round(sum(count(*)) OVER (ORDER BY o_orderpriority)::DOUBLE * 100.0 / sum(count(*)) OVER ()::DOUBLE, 2) AS running_share_pct
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY 1
"""
ORACLE["part_cooccurrence"] = """
WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
SELECT x.l_partkey AS part_a, y.l_partkey AS part_b, count(*) AS n_orders
FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.l_partkey < y.l_partkey
GROUP BY 1, 2
"""

# ------------------------------------------------------------------- pages
NOISE = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
ANCHOR = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
ANCHOR_ATTRS = r'(?is)<a\s([^>]*)>(.*?)</a>'
LINK = r"""(?is)<a\s[^>]*?href=("[^"]*"|'[^']*')[^>]*>(.*?)</a>"""
# The card rules, written here on their own.
CARD_TEXT = r">([^<>]+)<"
CARD_SPAN = r"(?is)<span[^>]*>([^<]*)</span>"
CARD_YEARS = r"(?i)[0-9]+.*y(r|ear)"
CARD_AGO = r"(?i)([0-9]+\s+(?:month|week|day|hour)s?\s+ago)"
CARD_MONTH_DAY = (r"(?i)((?:" + "|".join("jan feb mar apr may jun jul aug sep oct nov dec".split())
                  + r")[a-z]*\.?\s+[0-9]{1,2},?\s+[0-9]{4})")
CARD_SKILL_LINK = r'class="[^"]*[Tt]ag|href="[^"]*(skills|filters\[skill\]|filters%5Bskill)'
TAGRX = r"(?s)<[^>]*>"
ASCII_WS = r"[ \t\n\x0B\f\r]"


def _tag(x: str, tag: str) -> str:
    inner = f"regexp_extract({x}, '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    return f"nullif(trim(regexp_replace({inner}, '{TAGRX}', '', 'g')), '')"


ORACLE["page_fields"] = f"""
SELECT page_id, {_tag('c', 'title')} AS title, {_tag('c', 'h1')} AS h1,
  coalesce({_tag('c', 'h1')}, {_tag('c', 'title')}) AS headline,
  len(regexp_extract_all(c, '{ANCHOR}', 1)) AS n_links,
  regexp_extract_all(c, '{ANCHOR}', 1)[1] AS first_href,
  regexp_matches(c, '(?i)<article') AS has_article,
  len(regexp_extract_all(c, '{ANCHOR}', 1)) = 0 AND NOT regexp_matches(c, '(?i)<article') AS is_empty,
  length(trim(regexp_replace(regexp_replace(c, '{TAGRX}', ' ', 'g'), '{ASCII_WS}+', ' ', 'g'))) AS text_len
FROM (SELECT page_id, regexp_replace(html, '{NOISE}', '', 'g') AS c FROM pages)
"""
ORACLE["page_links"] = f"""
WITH a AS (
  SELECT page_id, url, unnest(regexp_extract_all(c, {q(LINK)}, 1)) AS quoted, unnest(regexp_extract_all(c, {q(LINK)}, 2)) AS t
  FROM (SELECT page_id, url, regexp_replace(html, '{NOISE}', '', 'g') AS c FROM pages)),
b AS (SELECT *, trim(substr(quoted, 2, length(quoted) - 2)) AS h, split_part(split_part(url, '#', 1), '?', 1) AS page,
             split_part(url, ':', 1) AS scheme FROM a),
r AS (SELECT page_id, t, CASE
    WHEN h = '' OR h[1] = '#' THEN NULL
    WHEN lower(h) LIKE 'http://%' OR lower(h) LIKE 'https://%' THEN h
    WHEN h[1:2] = '//' THEN scheme || ':' || h
    WHEN regexp_matches(h, '^[a-zA-Z][-+.a-zA-Z0-9]*:') THEN NULL
    WHEN h[1] = '/' THEN scheme || '://' || split_part(page, '/', 3) || h
    WHEN h[1] = '?' THEN page || h
    WHEN len(string_split(page, '/')) > 3 THEN left(page, length(page) - length(string_split(page, '/')[-1])) || h
    ELSE page || '/' || h END AS href FROM b)
SELECT page_id, href, trim(regexp_replace(t, '{TAGRX}', '', 'g')) AS anchor_text FROM r WHERE href IS NOT NULL
"""
ORACLE["page_url_parts"] = f"""
SELECT page_id,
  nullif(regexp_extract(url, '^([a-z]+)://', 1), '') AS scheme,
  nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host,
  nullif(regexp_extract(p, '^/([a-z]{{2}})(/|$)', 1), '') AS lang,
  nullif(regexp_extract(p, '([^/]+)/*$', 1), '') AS path_id,
  nullif(regexp_extract(url, '\\?([^#]*)', 1), '') AS query,
  nullif(regexp_extract(url, '#(.*)$', 1), '') AS fragment,
  trim(regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '[^a-z0-9]+', '-', 'g'), '-') AS host_slug,
  {contains_any('lower(url)', R.NON_EGYPT_URL_PATTERNS)} AS denied
FROM (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS p FROM pages)
"""


def _last_line(x: str, prefix: str | None) -> str:
    last = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), lambda l: l <> '')[-1]"
    if prefix:
        last = f"CASE WHEN starts_with(lower({last}), {q(prefix)}) THEN {last} ELSE {q(prefix)} || {last} END"
    return f"CASE WHEN contains({x}, chr(10)) THEN {last} ELSE {x} END"


ORACLE["doc_text_profile"] = f"""
SELECT * FROM (
  SELECT doc_id, trim(lower(lang)) AS lang,
    length(regexp_replace({strip('text')}, '{UWS}+', ' ', 'g')) AS clean_len,
    len(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')) AS n_lines,
    length({_last_line('text', None)}) AS last_line_len
  FROM documents) WHERE clean_len > 2
"""
ORACLE["conversation_last_lines"] = f"""
SELECT conv_id, turn, trim(lower(role)) AS role, {_last_line('text', 'posted ')} AS last_line FROM conversations
"""
ORACLE["doc_rule_labels"] = f"""
SELECT lang, job_category, relevant, tech, count(*) AS n FROM (
  SELECT lang, {case_rules("lower(coalesce(text, 'None'))", R.CATEGORY_RULES, R.CATEGORY_DEFAULT)} AS job_category,
    coalesce({contains_any('lower(text)', R.TECH_TITLE_KEYWORDS)}, false) AS relevant,
    coalesce({contains_any('lower(text)', R.TECH_SKILLS_VOCAB)}, false) AS tech
  FROM documents) GROUP BY ALL
"""
_lt = "lower(t)"
_startup = " + ".join(f"CAST(contains({_lt}, {q(w.lower())}) AS INTEGER)" for w in dict.fromkeys(R.STARTUP_KEYWORDS))
ORACLE["text_rule_labels"] = f"""
WITH x AS (
  SELECT 'part' AS source, p_name || ' ' || p_type AS t FROM part
  UNION ALL SELECT 'customer', c_name || ' ' || c_mktsegment FROM customer
  UNION ALL SELECT 'page', regexp_replace(url, '[-_/.?=&]+', ' ', 'g') FROM pages)
SELECT source, {case_rules(_lt, R.CATEGORY_RULES_WIDE, 'none')} AS category, {case_rules(_lt, R.LEVEL_TITLE_RULES, 'none')} AS level,
  CASE WHEN {contains_any(_lt, [k.lower() for k in R.KNOWN_MNCS])} THEN 'MNC'
       WHEN {contains_any(_lt, [k.lower() for k in R.GOVERNMENT_KEYWORDS])} THEN 'Government' ELSE 'none' END AS company,
  {contains_any(_lt, R.TECH_SKILLS_VOCAB)} AS tech, CAST({_startup} AS BIGINT) AS startup_words, count(*) AS n
FROM x GROUP BY ALL
"""
_pn = "p_name"
_score = " + ".join(f"CAST(contains(lower(coalesce({_pn}, '')), {q(w)}) AS INTEGER)" for w in dict.fromkeys(R.STARTUP_KEYWORDS))
_ovr = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.COMPANY_OVERRIDES.items())
ORACLE["part_company_types"] = f"""
SELECT company_type, startup_score, count(*) AS n FROM (
  SELECT CASE WHEN {_pn} IS NULL OR lower({strip(_pn)}) IN {inlist(R.COMPANY_UNKNOWN_NAMES)} THEN 'Unknown'
    WHEN {_pn} IN {inlist(R.COMPANY_OVERRIDES)} THEN (CASE {_pn} {_ovr} END)
    WHEN {contains_any(f'lower({_pn})', R.KNOWN_MNCS)} THEN 'MNC'
    WHEN {contains_any(f'lower({_pn})', R.GOVERNMENT_KEYWORDS)} THEN 'Government'
    WHEN ({_score}) >= 2 THEN 'Startup'
    WHEN ({_score}) = 1 AND len(list_filter(regexp_split_to_array({strip(_pn)}, '{UWS}+'), lambda w: w <> '')) <= 3 THEN 'Startup'
    ELSE 'Corporate' END AS company_type, ({_score}) AS startup_score
  FROM part) GROUP BY ALL
"""

# ------------------------------------------------------- quality / reports
_crit = [f"('not_null_{c}', count(*) FILTER ({c} IS NULL))" for c in R.GATE_CRITICAL_COLUMNS]
_acc = [(c, v) for c, v in [("experience_level", R.VALID_EXPERIENCE_LEVELS), ("work_type", R.VALID_WORK_TYPES),
                            ("company_type", R.VALID_COMPANY_TYPES)]]
ORACLE["quality_checks"] = f"""
WITH p AS ({POSTINGS}), a AS (SELECT max(scrape_date) AS as_of FROM p),
g AS (SELECT count(*) AS n,
        date_diff('day', min(posted_date), (SELECT as_of FROM a)) AS span,
        date_diff('day', (SELECT as_of FROM a), max(posted_date)) AS ahead,
        count(*) FILTER (coalesce(len(skills), 0) <= 0) AS empty FROM p),
checks AS (
  SELECT 'row_count' AS "check", CASE WHEN n BETWEEN {R.GATE_MIN_ROWS} AND {R.GATE_MAX_ROWS} THEN 0 ELSE n END AS failing FROM g
  UNION ALL SELECT 'required_columns', 0
  {''.join(f" UNION ALL SELECT 'not_null_{c}', count(*) FILTER ({c} IS NULL) FROM p" for c in R.GATE_CRITICAL_COLUMNS)}
  UNION ALL SELECT 'unique_job_url', count(*) - count(DISTINCT job_url) FROM p
  {''.join(f" UNION ALL SELECT 'accepted_{c}', count(*) FILTER (NOT coalesce({c} IN {inlist(v)}, false)) FROM p" for c, v in _acc)}
  UNION ALL SELECT 'url_prefix', count(*) FILTER (NOT coalesce(starts_with(job_url, {q(R.GATE_URL_PREFIX)}), false)) FROM p
  UNION ALL SELECT 'date_range', CASE WHEN span > {R.GATE_MAX_DATE_SPAN_DAYS} THEN span WHEN ahead > 0 THEN ahead ELSE 0 END FROM g
  UNION ALL SELECT 'empty_skills', CASE WHEN n = 0 THEN 1 WHEN empty * 100.0 / n > {R.GATE_MAX_EMPTY_SKILLS_PCT} THEN empty ELSE 0 END FROM g)
SELECT "check", CAST(failing AS BIGINT) AS failing, failing = 0 AS passed FROM checks
"""
_cols = ["job_title", "company_name", "job_type", "job_category", "posted_date", "job_url", "city", "work_type",
         "min_experience", "max_experience", "experience_level", "scrape_date", "company_type", "skills_list"]
ORACLE["null_profile"] = "WITH c AS (" + ORACLE["cleaned_postings"] + ")\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM c" for c in _cols)


def _raw_missing(c: str, is_list: bool = False) -> str:
    cond = f"{c} IS NULL" if is_list else f"{c} IS NULL OR CAST({c} AS VARCHAR) IN {inlist(R.RAW_MISSING_TOKENS)}"
    return f"count(*) FILTER ({cond}) AS missing_{c}"


_raw_cols = {"job_id": "job_id", "title": "title", "company": "company", "location": "location", "job_type": "job_type",
             "experience": "experience", "skills": "skills", "posted_date": "posted_raw", "url": "url",
             "scraped_at": "scraped_at"}
ORACLE["raw_completeness"] = f"""
WITH r AS (SELECT * EXCLUDE (posted_raw), posted_raw AS posted_date FROM ({RAW_SQL})),
per AS (SELECT keyword, count(*) AS total, count(*) FILTER (coalesce(len(skills), 0) <= 0) AS empty_skills,
   {', '.join(_raw_missing(c, c == 'skills') for c in R.RAW_REQUIRED_FIELDS)} FROM r GROUP BY keyword),
d AS (SELECT keyword, count(*) FILTER (n > 1) AS duplicates FROM (SELECT keyword, job_id, count(*) AS n FROM r GROUP BY 1, 2) GROUP BY 1)
SELECT per.*, d.duplicates FROM per JOIN d USING (keyword)
"""
ORACLE["raw_top_locations"] = f"""
SELECT * FROM (SELECT keyword, location, count, row_number() OVER (PARTITION BY keyword ORDER BY count DESC, location) AS rank
  FROM (SELECT keyword, location, count(*) AS count FROM ({RAW_SQL}) GROUP BY 1, 2)) WHERE rank <= 5
"""
ORACLE["raw_top_companies"] = f"""
SELECT * FROM (SELECT keyword, company, count, row_number() OVER (PARTITION BY keyword ORDER BY count DESC, company) AS rank
  FROM (SELECT keyword, company, count(*) AS count FROM ({RAW_SQL}) GROUP BY 1, 2)) WHERE rank <= 5
"""
ORACLE["missing_counts"] = " UNION ALL ".join(
    f"SELECT {q(c)} AS field, sum(missing_{c})::BIGINT AS missing FROM ({ORACLE['raw_completeness']})" for c in R.RAW_REQUIRED_FIELDS)
MART = ORACLE["job_skill_metrics"]
DIM_SKILLS = f"SELECT {sk('skill_name')} AS skill_id, skill_name FROM (SELECT DISTINCT skill_name FROM ({PAIRS}))"
BRIDGE = f"SELECT job_id, {sk('skill_name')} AS skill_id FROM ({PAIRS})"
_T = {"fact_jobs": FACT, "dim_job": f"SELECT job_id, job_title, experience_level FROM ({STG})",
      "dim_company": DIM_COMPANY, "dim_location": DIM_LOCATION, "dim_date": DIM_DATE, "dim_skills": DIM_SKILLS,
      "bridge_job_skills": BRIDGE, "mart_job_metrics": MART, "stg_jobs": STG}
_tests = []
for _cols_of in (R.MODEL_NOT_NULL, R.EXTRA_NOT_NULL):
    for t, cs in _cols_of.items():
        _tests += [f"SELECT 'not_null_{t}_{c}' AS test, count(*) FILTER ({c} IS NULL) AS failures FROM ({_T[t]})" for c in cs]
for t, cs in R.MODEL_UNIQUE.items():
    _tests += [f"SELECT 'unique_{t}_{c}', count(*) FROM (SELECT {c} FROM ({_T[t]}) WHERE {c} IS NOT NULL GROUP BY 1 "
               f"HAVING count(*) > 1)" for c in cs]
for t, c, v in R.MODEL_ACCEPTED + R.EXTRA_ACCEPTED:
    _tests.append(f"SELECT 'accepted_values_{t}_{c}', count(*) FILTER ({c} IS NOT NULL AND {c} NOT IN {inlist(v)}) FROM ({_T[t]})")
for t, c, d, pk in R.MODEL_RELATIONSHIPS + R.EXTRA_RELATIONSHIPS:
    _tests.append(f"SELECT 'relationships_{t}_{c}', count(*) FROM ({_T[t]}) x WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM ({_T[d]}))")
ORACLE["model_tests"] = "\nUNION ALL ".join(_tests)
ORACLE["kpis"] = f"""
SELECT count(*) AS postings, count(DISTINCT company_name) AS companies, count(DISTINCT city) AS cities,
  min(posted_date) AS first_posted, max(posted_date) AS last_posted,
  (SELECT count(DISTINCT skill_name) FROM ({PAIRS})) AS skills, (SELECT count(*) FROM ({PAIRS})) AS job_skill_pairs
FROM ({STG})
"""
for _c in ["company_type", "city", "job_category"]:
    ORACLE[f"postings_by_{_c}"] = f"""
SELECT {_c}, count(*) AS count,
  round(count(*)::DOUBLE * 100.0 / (SELECT count(*) FROM ({STG}) WHERE {_c} IS NOT NULL), 2) AS share_pct
FROM ({STG}) WHERE {_c} IS NOT NULL GROUP BY 1
"""
LEVEL_SKILL = f"""
SELECT j.experience_level, p.skill_name, count(*) AS n_jobs FROM ({PAIRS}) p JOIN ({STG}) j ON p.job_id = j.job_id GROUP BY 1, 2
"""
ORACLE["top_skills_per_level"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experience_level ORDER BY n_jobs DESC, skill_name) AS rank
  FROM ({LEVEL_SKILL})) WHERE rank <= 3
"""
ORACLE["top_skills_per_category"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_category ORDER BY n_jobs DESC, skill_name) AS rank
  FROM ({LEVEL_SKILL.replace("experience_level", "job_category")})) WHERE rank <= 3
"""
ORACLE["skill_roadmap"] = f"""
SELECT s.experience_level, s.skill_name, s.n_jobs, l.level_jobs,
  round(s.n_jobs::DOUBLE * 100.0 / l.level_jobs, 2) AS share_pct
FROM ({LEVEL_SKILL}) s JOIN (SELECT experience_level, count(*) AS level_jobs FROM ({STG}) GROUP BY 1) l USING (experience_level)
"""

# --------------------------------------------------------- notebook fields
def initcap(x: str) -> str:
    """Spark initcap: lower-case, then upper-case the first letter of each blank-separated word."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


def band(a: str, b: str) -> str:
    v = f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN ({a}) ELSE (({a}) + ({b})) / 2 END)"
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= 2 THEN 'junior' WHEN {v} <= 5 THEN 'mid' WHEN {v} <= 8 THEN 'senior' ELSE 'executive' END"


def exp_fields(s: str, pats) -> tuple[str, str, str]:
    mn, mx, lv = [], [], []
    for rx, kind in pats:
        a = f"TRY_CAST(regexp_extract({s}, '{rx}', 1) AS INTEGER)"
        if kind == "range":
            b = f"TRY_CAST(regexp_extract({s}, '{rx}', 2) AS INTEGER)"
            lvl = band(a, b)
        elif kind == "plus":
            b, lvl = "CAST(NULL AS INTEGER)", "'senior'"
        else:
            b, lvl = a, band(a, a)
        hit = f"regexp_matches({s}, '{rx}')"
        mn.append(f"WHEN {hit} THEN {a}")
        mx.append(f"WHEN {hit} THEN {b}")
        lv.append(f"WHEN {hit} THEN {lvl}")
    return tuple("CASE " + " ".join(x) + " END" for x in (mn, mx, lv))


def _notebook_sql() -> str:
    from hirescope.functions.parse import CSV_EXPERIENCE_PATTERNS, JSON_EXPERIENCE_PATTERNS
    sj = strip("replace(coalesce(experience, ''), '·', '')")
    sc = strip("coalesce(experience, '')")
    jmn, jmx, jlv = exp_fields(sj, JSON_EXPERIENCE_PATTERNS)
    cmn, cmx, clv = exp_fields(sc, CSV_EXPERIENCE_PATTERNS)
    loc = f"coalesce({strip('location')}, '')"
    parts = f"list_transform(string_split({loc}, ','), lambda p: {strip('p')})"
    loc_city = f"CASE WHEN {loc} = '' THEN 'Unknown' ELSE {parts}[1] END"
    loc_country = f"CASE WHEN {loc} = '' THEN 'Unknown' WHEN len({parts}) = 1 THEN 'Egypt' ELSE {parts}[-1] END"
    company = f"""CASE WHEN company IS NULL OR lower({strip('company')}) IN ('', 'experienced', 'confidential') THEN 'Unknown'
                  ELSE {strip('company')} END"""

    def label(x, m, null):
        arms = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in m.items())
        return f"CASE WHEN {x} IS NULL THEN {q(null)} ELSE (CASE {strip(x)} {arms} ELSE {strip(x)} END) END"
    tail = strip("string_split(location, ',')[-1]")
    u = "lower(url)"

    def first_city(cities, suffixes, names):
        conds = " OR ".join(f"regexp_matches({u}, '-' || c || {q(sfx)})" for sfx in suffixes)
        c = f"list_filter({lst(cities)}, lambda c: {conds})[1]"
        arms = " ".join(f"WHEN {q(x)} THEN {q(names(x))}" for x in cities)
        return f"(CASE {c} {arms} END)"

    def eg_name(x):
        t = x.replace("-", " ").title()
        return R.URL_CITY_NAME_FIXES.get(t, R.URL_CITY_NAME_FIXES.get(" ".join(w[:1].upper() + w[1:] for w in x.replace('-', ' ').split(' ')), t))
    eg = first_city(R.URL_EGYPT_CITIES, ["-egypt", ",-egypt"], eg_name)
    sa = first_city(R.URL_SAUDI_CITIES, ["-saudi", "-sa($|[^a-z0-9])"], lambda x: x.title())
    ae = first_city(R.URL_UAE_CITIES, ["-uae", "-united"], lambda x: x.title())
    is_sa = f"(contains({u}, '-saudi-arabia') OR regexp_matches({u}, '-sa($|[^a-z0-9])'))"
    is_ae = f"(contains({u}, '-united-arab-emirates') OR contains({u}, '-uae'))"
    url_city = f"""CASE WHEN url IS NULL OR url = '' THEN 'Unknown'
      WHEN contains({u}, '-egypt') THEN coalesce({eg}, 'Unknown')
      WHEN {is_sa} THEN coalesce({sa}, 'Unknown') WHEN {is_ae} THEN coalesce({ae}, 'Unknown') ELSE 'Unknown' END"""
    others = " ".join(f"WHEN contains({u}, {q(m)}) THEN {q(n)}" for m, n in R.URL_OTHER_COUNTRIES)
    url_country = f"""CASE WHEN url IS NULL OR url = '' THEN 'Unknown' WHEN contains({u}, '-egypt') THEN 'Egypt'
      WHEN {is_sa} THEN 'Saudi Arabia' WHEN {is_ae} THEN 'UAE' {others} ELSE 'Unknown' END"""
    fixes = "x"
    for a, b in R.COMPANY_WORD_FIXES:
        fixes = f"replace({fixes}, {q(a)}, {q(b)})"
    locs = lst(R.URL_LOCATION_TOKENS)
    url_company = f"""(SELECT CASE WHEN url IS NULL OR url = '' OR NOT contains(url, 'wuzzuf.net') THEN 'Unknown'
         WHEN len(comp) = 0 THEN 'Confidential'
         ELSE (SELECT {fixes} FROM (SELECT array_to_string(list_transform(comp, lambda t: upper(left(t, 1)) || substr(t, 2)), ' ') AS x)) END
      FROM (SELECT CASE WHEN pz IS NOT NULL THEN list_slice(rest, 1, pz - 1) ELSE rest END AS comp
        FROM (SELECT rest, list_position(list_transform(rest, lambda t: list_contains({locs}, t)), true) AS pz
          FROM (SELECT list_slice(parts, CASE WHEN fst IS NULL THEN 2 ELSE coalesce(nxt - 1, n) + 1 END, n) AS rest
            FROM (SELECT parts, n, fst, list_min(list_filter(range(2, n + 1), lambda j: j > fst AND NOT list_contains(tp, parts[j]))) AS nxt
              FROM (SELECT parts, n, tp, list_min(list_filter(range(2, n + 1), lambda j: list_contains(tp, parts[j]))) AS fst
                FROM (SELECT parts, len(parts) AS n,
                        string_split(trim(regexp_replace(lower(coalesce(title, 'None')), '[^a-z0-9]+', '-', 'g'), '-'), '-') AS tp
                      FROM (SELECT string_split(lower(string_split(url, '/')[-1]), '-') AS parts))))))))"""
    cur = strip(initcap(f"coalesce(({loc_city}), 'None')"))
    dmap = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.DISTRICT_TO_CITY.items())
    gov = f"(CASE {cur} {dmap} END)"
    rw = ["remote", "work from home", "wfh"]
    txt = "lower(concat_ws(' ', title, url))"
    wt1 = f"CASE WHEN {contains_any(txt, rw)} THEN 'Remote' WHEN contains({txt}, 'hybrid') THEN 'Hybrid' ELSE 'On-site' END"
    txt2 = "lower(concat_ws(' ', job_id, title, company, location, job_type, experience, posted_raw, url, scraped_at, keyword))"
    wt2 = f"CASE WHEN {contains_any(txt2, rw + ['telecommute'])} THEN 'Remote' WHEN contains({txt2}, 'hybrid') THEN 'Hybrid' ELSE 'On-site' END"
    tails = inlist(R.KNOWN_WORK_MODES + R.KNOWN_JOB_TYPES)
    arr = "string_split(location, ',')"
    idx = f"coalesce(list_max(list_filter(range(1, len({arr}) + 1), lambda i: NOT (lower({strip(arr + '[i]')}) IN {tails}))), 0)"
    return f"""
    SELECT pos, {jmn} AS json_min, {jmx} AS json_max, {jlv} AS json_level,
      {cmn} AS csv_min, {cmx} AS csv_max, {clv} AS csv_level,
      {loc_city} AS loc_city, {loc_country} AS loc_country, {company} AS company_clean,
      {label('job_type', R.JOB_TYPE_MAP, R.JOB_TYPE_NULL)} AS job_type_label,
      {label(tail, R.WORKPLACE_MAP, R.WORKPLACE_NULL)} AS workplace_label,
      {url_city} AS url_city, {url_country} AS url_country,
      CASE WHEN ({url_city}) <> 'Unknown' THEN ({url_city}) || ', ' || ({url_country}) ELSE 'Unknown' END AS location_raw,
      {url_company} AS url_company,
      coalesce({gov}, {cur}) AS governorate, CASE WHEN {gov} IS NOT NULL THEN {cur} ELSE {q(R.DISTRICT_MAIN)} END AS district,
      {wt1} AS work_type_title, {wt2} AS work_type_any,
      array_to_string(CASE WHEN {idx} > 0 THEN list_slice({arr}, 1, {idx}) ELSE [] END, ',') AS peeled_location,
      CASE WHEN len({arr}) > {idx} THEN {arr}[-1] END AS peeled_type
    FROM ({RAW_SQL})"""


ORACLE["notebook_fields"] = _notebook_sql()

# ------------------------------------------------- notebook categories/skills
def _cat_chain(x: str, rules, default_expr: str) -> str:
    arms = " ".join(f"WHEN {contains_any(x, kws)} THEN {q(label)}" for label, kws in rules)
    return f"CASE {arms} ELSE {default_expr} END"


def _notebook_cat_skills_sql() -> str:
    t = "coalesce(title, 'None')"
    wide = _cat_chain(f"lower({t})", R.CATEGORY_RULES_WIDE, t)
    std = f"CASE WHEN ({wide}) IN {inlist(R.STANDARD_CATEGORIES)} THEN ({wide}) ELSE 'other' END"
    final = f"CASE WHEN ({std}) = 'other' THEN {_cat_chain(f'lower({t})', R.RECLASSIFY_OTHER_RULES, q('other'))} ELSE ({std}) END"
    base = f"list_transform(list_filter(skills, lambda x: x IS NOT NULL AND x <> ''), lambda x: {strip('x')})"
    rx = "(?i)^(?:" + "|".join(R.SKILL_NOISE_PATTERNS_V1) + ")"
    v1 = f"list_filter({base}, lambda x: NOT regexp_matches(x, {q(rx)}) AND length(x) >= 3)"
    rm = inlist(R.SKILL_REMOVE_ITEMS)
    v2 = f"list_filter({base}, lambda x: NOT (x IN {rm}) AND NOT ends_with(x, '-') AND length(x) >= 2 AND NOT starts_with(x, '·'))"
    st = f"""list_transform({base}, lambda x: CASE WHEN starts_with(x, '· ') THEN substr(x, 3)
             WHEN starts_with(x, '·') THEN {strip('substr(x, 2)')} ELSE x END)"""
    fin = f"list_filter({st}, lambda x: NOT (x IN {rm}) AND NOT ends_with(x, '-') AND length(x) >= 2)"
    words = " + ".join(f"CAST(contains(lower(x), {q(w)}) AS INTEGER)" for w in dict.fromkeys(R.SKILL_TITLE_WORDS))
    late = (f"list_filter(list_transform(skills, lambda x: {strip(chr(99) + 'oalesce(x, ' + q('None') + ')')}), "
            f"lambda x: length(x) <= {R.SKILL_MAX_LEN} AND NOT {contains_any('x', R.SKILL_MARKERS_LATE)} "
            f"AND lower(x) NOT IN {inlist(R.SKILL_NOISE_LATE)} AND ({words}) < 2)")

    def j(a):
        return f"array_to_string(list_sort(list_distinct({a})), '|')"
    return f"""
    SELECT pos, {wide} AS category_wide, {std} AS category_std, {final} AS category_final,
      {j(v1)} AS skills_v1, {j(v2)} AS skills_v2, {j(fin)} AS skills_final, array_to_string({late}, '|') AS skills_late
    FROM ({RAW_SQL})"""


ORACLE["notebook_categories_skills"] = _notebook_cat_skills_sql()


def _notebook_location_sql() -> str:
    loc = f"coalesce({strip('location')}, '')"
    parts = f"list_transform(string_split({loc}, ','), lambda p: {strip('p')})"
    loc_city = f"CASE WHEN {loc} = '' THEN 'Unknown' ELSE {parts}[1] END"
    dmap = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.DISTRICT_TO_CITY.items())
    gfix = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.GOVERNORATE_FIXES.items())
    cfix = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.DISTRICT_CITY_FIXES.items())
    u = "lower(coalesce(url, 'None'))"
    dist_hit = f"list_filter({lst(R.URL_DISTRICTS)}, lambda d: contains({u}, d))[1]"
    gov_hit = f"list_filter({lst(R.EGYPT_GOVERNORATES)}, lambda g: contains({u}, lower(g)))[1]"
    return f"""
    WITH a AS (SELECT pos, url, {strip(initcap(f"coalesce(({loc_city}), 'None')"))} AS cur FROM ({RAW_SQL})),
    b AS (SELECT pos, url, coalesce((CASE cur {dmap} END), cur) AS governorate,
                 CASE WHEN (CASE cur {dmap} END) IS NOT NULL THEN cur ELSE {q(R.DISTRICT_MAIN)} END AS district FROM a),
    c AS (SELECT pos, url, district, coalesce(governorate, 'Unknown') AS g0,
                 regexp_extract({u}, {q(R.GOVERNORATE_URL_PATTERN)}, 1) AS m FROM b),
    d AS (SELECT pos, url, district,
                 CASE WHEN g0 <> 'Unknown' THEN g0 WHEN m <> '' THEN {initcap("string_split(m, '-')[-1]")} ELSE g0 END AS v FROM c),
    e AS (SELECT pos, url, CASE v {gfix} ELSE v END AS governorate,
                 coalesce({initcap(f"replace({dist_hit}, '-', ' ')")}, district) AS district FROM d),
    f AS (SELECT pos, url, governorate, district, coalesce((CASE district {cfix} END), governorate) AS city FROM e),
    g AS (SELECT pos, governorate, governorate IN {inlist(R.EGYPT_GOVERNORATES)} AND NOT (governorate IN {inlist(R.INTERNATIONAL_CITIES)}) AS gov_allowed, district,
                 CASE WHEN {strip("coalesce(city, 'None')")} IN {inlist(R.EGYPT_GOVERNORATES)} THEN {strip("coalesce(city, 'None')")}
                      ELSE coalesce({gov_hit}, {q(R.CITY_DROP_SENTINEL)}) END AS city FROM f)
    SELECT * FROM g WHERE city <> {q(R.CITY_DROP_SENTINEL)}"""


ORACLE["notebook_location_refine"] = _notebook_location_sql()

# ------------------------------------------------------------- more checks
_prof_cols = ["job_title", "company_name", "job_type", "job_category", "posted_date", "job_url", "city", "work_type",
              "min_experience", "max_experience", "experience_level", "scrape_date", "company_type"]
_types = {"posted_date": "date", "scrape_date": "date", "min_experience": "double", "max_experience": "double"}
ORACLE["audit_profile"] = f"WITH p AS ({POSTINGS})\n" + "\nUNION ALL ".join(
    f"SELECT (SELECT count(*) FROM p) AS row_count, '{c}' AS column_name, '{_types.get(c, 'string')}' AS data_type, "
    f"count(*) FILTER ({c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count, "
    f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM p" for c in _prof_cols)


def _level_before_after_sql() -> str:
    from hirescope.functions.parse import JSON_EXPERIENCE_PATTERNS
    sj = strip("replace(coalesce(experience, ''), '·', '')")
    _, _, jlv = exp_fields(sj, JSON_EXPERIENCE_PATTERNS)
    s = f"lower({strip('experience')})"
    rng, plus = r"(\d+)\s*[-to]+\s*(\d+)", r"(\d+)\+|more than (\d+)"
    mn = f"""CASE WHEN regexp_matches({s}, '{rng}') THEN TRY_CAST(regexp_extract({s}, '{rng}', 1) AS DOUBLE)
      WHEN regexp_matches({s}, '{plus}') THEN TRY_CAST(coalesce(nullif(regexp_extract({s}, '{plus}', 1), ''),
                                                              nullif(regexp_extract({s}, '{plus}', 2), '')) AS DOUBLE) END"""
    t = f"lower({strip('title')})"
    t = f"lower(regexp_replace({strip('title')}, '{UWS}+', ' ', 'g'))"
    lvl_arms = " ".join(f"WHEN {contains_any('t', kws)} THEN {q(label)}" for label, kws in R.LEVEL_TITLE_RULES)
    yrs = " ".join(f"WHEN m <= {b} THEN {q(l)}" for b, l in R.LEVEL_YEAR_BANDS)
    after = f"""CASE {lvl_arms} {yrs} WHEN m IS NOT NULL THEN {q(R.LEVEL_YEAR_TOP)}
      WHEN {contains_any('lower(experience)', R.LEVEL_RAW_JUNIOR_HINTS)} THEN 'junior' ELSE {q(R.LEVEL_DEFAULT)} END"""
    return f"""
    WITH r AS (SELECT *, {t} AS t, {mn} AS m FROM ({RAW_SQL})),
    b AS (SELECT coalesce({jlv}, 'unbanded') AS experience_level, count(*) AS before FROM r GROUP BY 1),
    a AS (SELECT {after} AS experience_level, count(*) AS after FROM r GROUP BY 1)
    SELECT coalesce(b.experience_level, a.experience_level) AS experience_level, coalesce(b.before, 0) AS before,
           coalesce(a.after, 0) AS after, coalesce(a.after, 0) - coalesce(b.before, 0) AS delta
    FROM b FULL OUTER JOIN a ON b.experience_level = a.experience_level"""


ORACLE["level_before_after"] = _level_before_after_sql()
ORACLE["empty_skills_share"] = f"""
SELECT job_category, round(avg(CASE WHEN coalesce(len(skills), 0) <= 0 THEN 1.0 ELSE 0.0 END) * 100.0, 2) AS empty_pct,
       count(*) AS postings FROM ({POSTINGS}) GROUP BY 1
"""
ORACLE["warehouse_load_shape"] = "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c.upper()}" if c in ("posted_date", "scrape_date") else f"{c} AS {c.upper()}"
    for c in ["job_title", "company_name", "job_type", "job_category", "posted_date", "job_url", "city", "work_type",
              "min_experience", "max_experience", "experience_level", "scrape_date", "company_type", "skills_list"]
) + f" FROM ({ORACLE['cleaned_postings']})"
ORACLE["new_vs_known_pairs"] = """
WITH e AS (SELECT *, CAST(ts AS DATE) AS day, hour(ts) AS hour FROM events),
b AS (SELECT * FROM e WHERE day = (SELECT max(day) FROM e)),
f AS (SELECT user_id, event_type, hour, ts, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY ts, event_id) AS rn FROM b) WHERE rn = 1)
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.day < (SELECT max(day) FROM e)
                                  AND e.user_id = f.user_id AND e.event_type = f.event_type AND e.hour = f.hour)
"""


def _cards_sql() -> str:
    words = inlist(R.KNOWN_WORK_MODES + R.KNOWN_JOB_TYPES)
    hs = f"regexp_extract_all(c, {q(ANCHOR)}, 1)"
    ts = f"list_transform(regexp_extract_all(c, {q(ANCHOR)}, 2), lambda t: trim(regexp_replace(t, '{TAGRX}', '', 'g')))"
    nodes = f"list_filter(list_transform(regexp_extract_all(c, {q(CARD_TEXT)}, 1), lambda t: trim(t)), lambda t: t <> '')"
    prim = f"ts[list_filter(range(1, len(hs) + 1), lambda i: contains(hs[i], '/jobs/c/') OR contains(hs[i], '/company/'))[1]]"
    gen = (f"ts[list_filter(range(1, len(hs) + 1), lambda i: NOT contains(hs[i], '/jobs/p/') AND ts[i] <> '' "
           f"AND NOT (lower(ts[i]) IN {words}))[1]]")
    company = f"nullif(regexp_replace(coalesce({prim}, {gen}), '\\s*-\\s*$', ''), '')"
    span_loc = _tag(f"regexp_extract(c, {q(chr(40) + '?is' + chr(41) + '(<span[^>]*class=\"[^\"]*[Ll]ocation[^\"]*\"[^>]*>.*?</span>)')}, 1)", "span")
    spans = f"list_filter(list_transform(regexp_extract_all(c, {q(CARD_SPAN)}, 1), lambda t: trim(t)), lambda t: t <> '')"
    short = f"list_filter({spans}, lambda t: length(t) < 60 AND NOT regexp_matches(t, {q(CARD_YEARS)}))"
    location = f"coalesce({span_loc}, nullif(array_to_string(list_slice({short}, 1, 2), ', '), ''), 'Egypt')"
    span_xp = _tag(f"regexp_extract(c, {q('(?is)(<span[^>]*class=\"[^\"]*(?:xp|exp|Exp|experience)[^\"]*\"[^>]*>.*?</span>)')}, 1)", "span")
    node_xp = f"list_filter(nodes, lambda t: regexp_matches(t, {q(CARD_YEARS)}) AND length(t) < 50)[1]"
    posted = (f"coalesce(nullif(regexp_extract(c, {q(chr(40) + '?is' + chr(41) + '<time[^>]*datetime=\"([^\"]*)\"')}, 1), ''), "
              f"{_tag('c', 'time')}, nullif(regexp_extract(c, {q(CARD_AGO)}, 1), ''), "
              f"nullif(regexp_extract(c, {q(CARD_MONTH_DAY)}, 1), ''))")
    at = f"regexp_extract_all(c, {q(ANCHOR_ATTRS)}, 1)"
    tt = f"list_transform(regexp_extract_all(c, {q(ANCHOR_ATTRS)}, 2), lambda t: trim(regexp_replace(t, '{TAGRX}', '', 'g')))"
    skills = (f"len(list_filter(range(1, len({at}) + 1), lambda i: regexp_matches({at}[i], {q(CARD_SKILL_LINK)}) "
              f"AND ({tt})[i] <> ''))")
    shown = r"""<(DIV|div)\s[^>]*class=["'][^"'>]*(NoResults|no-results|empty-state|EmptyState)"""
    titled = ("len(list_filter(regexp_extract_all(c, '(?is)<h2(?:\\s[^>]*)?>(.*?)</h2>', 1), "
              "lambda x: regexp_matches(x, '(?is)<a\\s[^>]*href=[^>]*/jobs/p/'))) > 0")
    said = ("len(list_filter(regexp_extract_all(c, '(?is)<h[123](?:\\s[^>]*)?>(.*?)</h[123]>', 1), lambda x: "
            f"regexp_matches(lower(regexp_replace(x, '{TAGRX}', '', 'g')), '0 jobs|no (vacancies|jobs|results) found'))) > 0")
    empty = f"(NOT {titled} AND (regexp_matches(c, {q(shown)}) OR {said}))"
    return f"""
    SELECT page_id, {company} AS company, {location} AS location, coalesce({span_xp}, {node_xp}) AS experience,
           {posted} AS posted, {skills} AS n_skill_tags, {empty} AS no_results
    FROM (SELECT page_id, c, {hs} AS hs, {ts} AS ts, {nodes} AS nodes
          FROM (SELECT page_id, regexp_replace(html, '{NOISE}', '', 'g') AS c FROM pages))"""


ORACLE["page_card_fallbacks"] = _cards_sql()

ORACLE["skill_count_sql"] = ORACLE["skill_count_per_job"]


def _company_drafts_sql() -> str:
    def flags(words):
        return f"list_transform(lw, lambda t: t IN {inlist(words)})"

    def first_in(words):
        p = f"coalesce(list_position(list_slice({flags(words)}, 2, L - 1), true), 0)"
        return f"(CASE WHEN {p} > 0 THEN {p} + 1 END)"

    def last_in(words):
        p = f"coalesce(list_position(list_reverse(list_slice({flags(words)}, 2, L - 1)), true), 0)"
        return f"(CASE WHEN {p} > 0 THEN L - {p} END)"

    def between(s, e):
        return f"(CASE WHEN ({e}) - ({s}) > 0 THEN list_slice(p, {s}, ({e}) - 1) ELSE [] END)"

    def name(arr, fixes=()):
        out = initcap(f"array_to_string({arr}, ' ')")
        for a, b in fixes:
            out = f"replace({out}, {q(a)}, {q(b)})"
        return out
    v1_tokens = (f"list_transform(list_filter(range(2, n + 1), lambda j: NOT loc[j] AND NOT (lw[j] IN "
                 f"{inlist(R.URL_DRAFT_JOB_WORDS_V1)})), lambda j: p[j])")
    v1 = strip(f"regexp_replace({name(v1_tokens)}, '\\d+$', '')")
    c2 = name(between(f"coalesce({first_in(R.URL_DRAFT_JOB_WORDS_V2)} + 1, 2)", "L"))
    cf = name(between(f"coalesce({last_in(R.URL_DRAFT_JOB_WORDS_FINAL)} + 1, 2)", "L"), R.URL_DRAFT_WORD_FIXES)
    c4 = name(between(f"coalesce({last_in(R.URL_DRAFT_JOB_WORDS_V4)} + 1, 2)", "L"), R.URL_DRAFT_WORD_FIXES)
    j3 = ("(CASE WHEN len(tw) > 0 THEN list_filter(range(2, least(L - 1, 6) + 1), "
          "lambda j: len(list_filter(tw, lambda w: contains(lw[j], w))) > 0)[1] END)")
    first_try = name(between(f"{j3} + 1", "L"))
    fallback = name(between("2", "least(4, L - 1) + 1"))
    v3 = f"CASE WHEN {j3} IS NOT NULL AND {first_try} <> '' THEN {first_try} ELSE {fallback} END"
    bad = "(url IS NULL OR url = '')"
    no_loc = f"({bad} OR L IS NULL)"
    return f"""
    WITH a AS (SELECT pos, url, title, string_split(string_split(url, '/')[-1], '-') AS p FROM ({RAW_SQL})),
    b AS (SELECT *, list_transform(p, lambda t: lower(t)) AS lw, len(p) AS n,
                 list_filter(regexp_split_to_array(lower(coalesce(title, '')), '\\s+'), lambda w: w <> '') AS tw FROM a),
    c AS (SELECT *, list_transform(lw, lambda t: t IN {inlist(R.URL_DRAFT_LOCATIONS)}) AS loc FROM b),
    d AS (SELECT *, CASE WHEN list_contains(loc, true) THEN n - list_position(list_reverse(loc), true) + 1 END AS L FROM c)
    SELECT pos,
      CASE WHEN {bad} OR {v1} = '' THEN 'Unknown' ELSE {v1} END AS company_v1,
      CASE WHEN {no_loc} OR {c2} = '' THEN 'Unknown' ELSE {c2} END AS company_v2,
      CASE WHEN {no_loc} OR {cf} = '' THEN 'Unknown' ELSE {cf} END AS company_final,
      CASE WHEN {no_loc} OR length({c4}) <= 1 THEN 'Unknown' ELSE {c4} END AS company_v4,
      CASE WHEN {no_loc} OR ({v3}) = '' THEN 'Unknown' ELSE {v3} END AS company_v3
    FROM d"""


ORACLE["notebook_company_drafts"] = _company_drafts_sql()

# ------------------------------------------------------------ round trips
ORACLE["upsert_order_files"] = ORACLE["upsert_orders"]
ORACLE["stream_postings"] = f"""
SELECT job_url, job_title, company_name, job_category, experience_level, min_experience, city, work_type FROM ({POSTINGS})
"""
ORACLE["incremental_marts"] = f"""
SELECT 'skill' AS mart, skill_name AS name, demand_category AS part, jobs_requiring_skill AS n, skill_demand_score AS share,
       skill_rarity_score AS other FROM ({ORACLE["job_skill_metrics"]})
UNION ALL
SELECT 'category', job_category, experience_level, job_count, market_demand_index, remote_ratio FROM ({ORACLE["category_metrics"]})
"""
ORACLE["quality_offenders"] = f"""
WITH bad AS (
  SELECT 'accepted_job_type' AS "check", job_type AS value FROM ({RAW_SQL})
    WHERE job_type IS NULL OR job_type NOT IN ('Full Time', 'Part Time', 'Internship')
  UNION ALL SELECT 'accepted_company', company FROM ({RAW_SQL}) WHERE company IS NULL OR company NOT IN ('Samsung Egypt', 'ITIDA')
  UNION ALL SELECT 'accepted_keyword', keyword FROM ({RAW_SQL})
    WHERE keyword IS NULL OR keyword NOT IN ('data engineer', 'data analyst', 'machine learning', 'backend developer')
  UNION ALL SELECT 'accepted_title', title FROM ({RAW_SQL}) WHERE title IS NULL OR title NOT IN ('IT')),
counted AS (SELECT "check", value, count(*) AS n FROM bad GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY n DESC, value NULLS FIRST) AS rank FROM counted) WHERE rank <= 10
"""

# M14 from the single rules above: what each source's row must hold, then the first source per URL.
ORACLE["notebook_combined"] = f"""
WITH r AS (
  SELECT r.*, f.*, s.skills_final FROM ({RAW_SQL}) r
  JOIN (SELECT * RENAME (pos AS fpos) FROM ({ORACLE["notebook_fields"]})) f ON r.pos = f.fpos
  JOIN (SELECT pos AS spos, skills_final FROM ({ORACLE["notebook_categories_skills"]})) s ON r.pos = s.spos
), u AS (
  SELECT 0 AS src, pos, title AS job_title, company_clean AS company_name, location AS location_raw, loc_city AS city,
    loc_country AS country, job_type, experience AS experience_raw, json_min AS min_experience, json_max AS max_experience,
    json_level AS experience_level, skills_final AS skills_list, keyword AS job_category, posted_raw AS posted_date, url AS job_url,
    'json_wuzzuf' AS data_source FROM r WHERE pos % 8 < 4
  UNION ALL
  SELECT 1, pos, title, 'Unknown', 'Unknown', 'Unknown', 'Unknown', job_type_label, experience, csv_min, csv_max, csv_level,
    skills_final, keyword, posted_raw, url, 'csv_wuzzuf_jobs' FROM r WHERE pos % 2 = 1
)
SELECT * EXCLUDE (src, place) FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY src, pos) AS place FROM u) WHERE place = 1
"""

_audit = "WITH p AS (" + ORACLE["cleaned_postings"] + ")"
_audited = ["job_title", "company_name", "job_type", "job_category", "posted_date", "job_url", "city", "work_type", "min_experience",
            "max_experience", "experience_level", "scrape_date", "company_type", "skills_list"]
ORACLE["audit_report"] = _audit + f"""
SELECT 'shape' AS section, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM p
UNION ALL SELECT 'shape', 'columns', '{len(_audited)}'
{''.join(f" UNION ALL SELECT 'nulls', '{c}', CAST(count(*) FILTER ({c} IS NULL) AS VARCHAR) FROM p" for c in _audited)}
{''.join(f" UNION ALL SELECT 'dates', '{c} {w}', CAST({f}({c}) AS VARCHAR) FROM p" for c in ("posted_date", "scrape_date") for w, f in (("first", "min"), ("last", "max")))}
{''.join(f" UNION ALL SELECT 'distribution of {c}', coalesce(v, '(null)'), CAST(n AS VARCHAR) FROM (SELECT {c} AS v, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, v NULLS FIRST LIMIT 20)" for c in ("experience_level", "work_type", "company_type", "job_category"))}
UNION ALL SELECT 'duplicates', 'rows', CAST((SELECT count(*) FROM p) - (SELECT count(*) FROM (SELECT DISTINCT * FROM p)) AS VARCHAR)
UNION ALL SELECT 'duplicates', 'job_url', CAST(count(*) - count(DISTINCT job_url) AS VARCHAR) FROM p
"""

_w = "['software', 'data', 'intelligence', 'systems', 'solutions', 'tech', 'digital']"


def _drawn(seed: int, share: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || job_url), 1, 8))::BIGINT < floor({share} * 4294967296))"


ORACLE["notebook_work_types"] = f"""
SELECT job_url, work_type, CAST(lower(trim(work_type)) = 'remote' AS INTEGER) AS is_remote,
  CASE WHEN work_type = 'Remote' THEN 'Remote'
    WHEN contains(lower(job_title), 'data') AND {_drawn(42, "0.10")} THEN 'Remote'
    WHEN len(list_filter({_w}, lambda w: contains(lower(job_title), w) OR contains(lower(company_name), w))) > 0
         AND {_drawn(43, "0.30")} THEN 'Hybrid'
    ELSE 'On-site' END AS flexible_type
FROM ({POSTINGS})
"""
ORACLE["notebook_governorates"] = f"""
SELECT governorate, count(*) AS n FROM ({ORACLE["notebook_location_refine"]}) WHERE gov_allowed GROUP BY 1
"""
ORACLE["job_metrics_ordered"] = ORACLE["job_skill_metrics"]
ORACLE["catalog_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations"))
_jobs = f"""SELECT url, title, company, job_type, experience, array_to_string(skills, '|') AS skills, posted_raw, scraped_at, keyword
  FROM ({RAW_SQL})"""
ORACLE["raw_json_roundtrip"] = f"""
SELECT url AS job_url, title AS job_title, company AS company_name, job_type, experience AS experience_raw, skills, posted_raw AS posted_date,
       scraped_at, keyword AS job_category FROM ({_jobs})
"""
ORACLE["raw_csv_roundtrip"] = f"""
SELECT url AS job_url, title AS job_title, posted_raw AS posted_date, job_type, experience, skills, scraped_at, keyword FROM ({_jobs})
"""
ORACLE["gate_status"] = f"""
SELECT count(*) FILTER (passed) AS checks_passed, count(*) FILTER (NOT passed) AS checks_failed,
       CASE WHEN count(*) FILTER (NOT passed) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, (SELECT count(*) FROM ({POSTINGS})) AS n_stored
FROM ({ORACLE["quality_checks"]})
"""


def _rule_arms_sql() -> str:
    def cycled(words, place):
        return f"{lst(words)}[({place} % {len(words)}) + 1]"
    titles = [w for _, words in R.CATEGORY_RULES for w in words] + ["florist", "baker"]
    levels = [w for _, words in R.LEVEL_TITLE_RULES for w in words] + [""] * 8
    companies = R.KNOWN_MNCS + R.GOVERNMENT_KEYWORDS + R.STARTUP_KEYWORDS + list(R.COMPANY_OVERRIDES) + R.COMPANY_UNKNOWN_NAMES + ["Grain Mills"]
    by_title = " ".join(f"WHEN {contains_any('lower(title)', kws)} THEN {q(label)}" for label, kws in R.LEVEL_TITLE_RULES)
    by_years = " ".join(f"WHEN years <= {bound} THEN {q(label)}" for bound, label in R.LEVEL_YEAR_BANDS)
    score = " + ".join(f"CAST(contains(lower(company), {q(w)}) AS INTEGER)" for w in dict.fromkeys(R.STARTUP_KEYWORDS))
    override = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in R.COMPANY_OVERRIDES.items())
    return f"""
    WITH r AS (
      SELECT concat_ws(' ', {cycled(levels, "(o_orderkey // 7)")}, {cycled(titles, "o_orderkey")}) AS title,
        {cycled(companies, "o_orderkey")} || CASE o_orderkey % 5 WHEN 1 THEN ' Smart Group' WHEN 2 THEN ' of the four rivers' ELSE '' END AS company,
        CASE WHEN o_orderkey % 3 <> 0 THEN ((o_orderkey // 11) % 10)::DOUBLE END AS years,
        CASE WHEN o_orderkey % 2 = 0 THEN {cycled(R.LEVEL_RAW_JUNIOR_HINTS, "(o_orderkey // 2)")} ELSE '' END AS raw
      FROM orders)
    SELECT {case_rules("lower(title)", R.CATEGORY_RULES, R.CATEGORY_DEFAULT)} AS category,
      CASE {by_title} {by_years} WHEN years IS NOT NULL THEN {q(R.LEVEL_YEAR_TOP)}
           WHEN {contains_any("lower(raw)", R.LEVEL_RAW_JUNIOR_HINTS)} THEN 'junior' ELSE {q(R.LEVEL_DEFAULT)} END AS level,
      CASE WHEN lower(trim(company)) IN {inlist(R.COMPANY_UNKNOWN_NAMES)} THEN 'Unknown'
        WHEN company IN {inlist(R.COMPANY_OVERRIDES)} THEN (CASE company {override} END)
        WHEN {contains_any("lower(company)", R.KNOWN_MNCS)} THEN 'MNC' WHEN {contains_any("lower(company)", R.GOVERNMENT_KEYWORDS)} THEN 'Government'
        WHEN ({score}) >= 2 THEN 'Startup'
        WHEN ({score}) = 1 AND len(list_filter(string_split(trim(company), ' '), lambda w: w <> '')) <= 3 THEN 'Startup' ELSE 'Corporate' END AS company_type,
      {contains_any("lower(title)", R.TECH_TITLE_KEYWORDS)} AS relevant, count(*) AS n
    FROM r GROUP BY ALL"""


ORACLE["rule_arms"] = _rule_arms_sql()
