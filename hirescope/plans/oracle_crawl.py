"""DuckDB SQL for the records read from derived pages.

It never sees markup: what each record must hold follows from the order.
"""

from __future__ import annotations

_LOOSE = "['Airflow', 'A link of more than twenty-five letters']"

ORACLE: dict[str, str] = {}

ORACLE["page_postings"] = f"""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderdate AS d, (o_orderkey // 20) % 6 AS style FROM orders
), f AS (
  SELECT *, 'Group ' || c AS g, k % 4 < 2 AS spans FROM o
  WHERE k % 10 <> 7 AND NOT (k % 13 = 5 AND style < 4)
)
SELECT CASE WHEN style < 2 THEN 'J' || k ELSE k || '-data-engineer' END AS job_id,
  CASE WHEN k % 9 = 0 THEN 'R&D' ELSE 'Senior' END || ' Data Engineer wanted, number ' || k AS title,
  CASE k % 3 WHEN 0 THEN 'Company ' || c WHEN 1 THEN 'Firm ' || c ELSE g END AS company,
  CASE k % 4 WHEN 0 THEN 'Maadi, Cairo, Egypt' WHEN 1 THEN s || ' City, Egypt' WHEN 2 THEN 'Giza, Egypt' ELSE 'Egypt' END AS location,
  CASE k % 8 WHEN 0 THEN 'Part Time' WHEN 1 THEN 'Internship' WHEN 2 THEN 'Contract' WHEN 4 THEN 'Hybrid' ELSE 'Unknown' END AS job_type,
  CASE WHEN k % 8 = 7 THEN 'Not specified' ELSE (k % 5) || ' - ' || (k % 5 + 3) || ' Yrs of Exp' END AS experience,
  array_to_string(CASE WHEN k % 5 = 0 THEN ['Python', 'SQL'] WHEN k % 5 = 1 THEN ['dbt'] WHEN k % 5 = 2 AND spans THEN ['Spark']
    WHEN k % 3 = 2 THEN [g] || {_LOOSE} ELSE {_LOOSE} END, '|') AS skills,
  CASE k % 6 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN '2 days ago' WHEN 2 THEN '5 hours ago' WHEN 3 THEN '3 weeks ago'
    WHEN 4 THEN 'Mar 5, 2026' ELSE 'Unknown' END AS posted_date,
  'https://wuzzuf.net/jobs/p/' || k || '-data-engineer?o=1' AS url,
  '2026-05-01T00:00:00+00:00' AS scraped_at, 'data engineer' AS keyword
FROM f
"""

ORACLE["page_quarantine"] = """
WITH o AS (SELECT o_orderkey AS k, o_orderkey // 20 AS page_id FROM orders), bad AS (
  SELECT page_id, 0 AS inner_card FROM o WHERE k % 13 = 5 AND page_id % 6 < 4
  UNION ALL SELECT page_id, 1 FROM o WHERE k % 9 = 4 AND page_id % 6 = 1
)
SELECT page_id, 'no title link' AS reason, count(*) AS n, count(*) FILTER (inner_card = 1) AS n_inner FROM bad GROUP BY page_id
"""

ORACLE["page_details"] = """
SELECT 'https://wuzzuf.net/jobs/p/' || k AS job_url, 'Wuzzuf' AS source_platform, 'data engineer' AS search_keywords,
  '2026-05-01 00:00:00' AS scraped_at, CASE WHEN k % 8 <> 0 THEN 'Engineer ' || k END AS job_title,
  CASE WHEN k % 9 <> 0 THEN 'Firm ' || o_custkey || ' - Cairo' END AS company_location_text,
  CASE WHEN k % 10 <> 0 THEN 'Posted ' || strftime(o_orderdate, '%Y-%m-%d') END AS posted_date,
  CASE k % 3 WHEN 0 THEN 'Full Time' WHEN 1 THEN 'Part Time' END AS job_type,
  CASE WHEN k % 3 = 0 THEN 'On-site' END AS workplace_type,
  (k % 7) || ' to ' || (k % 7 + 2) || ' years' AS experience,
  CASE WHEN k % 4 <> 0 THEN o_orderpriority END AS salary,
  CASE WHEN k % 2 = 0 THEN 'SQL|Spark' ELSE 'SQL' END AS skills,
  CASE WHEN k % 5 <> 0 THEN 'Work ' || k || ' Inside deep & nested' END AS job_description,
  CASE WHEN k % 6 <> 0 THEN 'Know this that' END AS job_requirements
FROM (SELECT *, o_orderkey AS k FROM orders)
"""

# The first heading of a page; comments, scripts and styles are no headings.
ORACLE["page_headlines"] = r"""
SELECT page_id, url AS job_url, NULL::VARCHAR AS job_type, NULL::VARCHAR AS salary, 0::BIGINT AS n_skills,
  CASE WHEN regexp_matches(c, '(?is)<h1[^>]*>.*?</h1>') THEN
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_extract(c, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&#39;', chr(39)), '&apos;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) END AS job_title
FROM (SELECT page_id, url, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') AS c FROM pages)
"""
