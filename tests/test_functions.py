"""Unit cases for the Column helpers (worked examples of the original)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirescope.functions import parse as P
from hirescope.functions import slug as S
from hirescope.functions.keys import surrogate_key
from hirescope.functions.skills import clean_skills_list, first_of_list_literal, parse_list_literal
from hirescope.functions.text import collapse_ws, contains_any


def ev(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("2 - 4 Yrs of Exp", (2.0, 4.0)),
    ("2+ Yrs of Exp", (2.0, None)),
    ("0 To 1 Year", (0.0, 1.0)),
    ("Not Specified", (None, None)),
    ("More than 5 years", (5.0, None)),
    (None, (None, None)),
])
def test_experience_years(spark, raw, expected):
    r = ev(spark, P.parse_experience_years(F.col("x")), raw)
    assert (r["min_experience"], r["max_experience"]) == expected


def test_experience_variants(spark):
    r = ev(spark, P.parse_experience_patterns(F.col("x"), P.CSV_EXPERIENCE_PATTERNS, strip_bullet=False),
           "More Than 3 Years")
    assert (r[0], r[1], r[2]) == (3, None, "senior")
    r = ev(spark, P.parse_experience_patterns(F.col("x"), P.JSON_EXPERIENCE_PATTERNS), "· 5+ Yrs of Exp")
    assert (r[0], r[1], r[2]) == (5, None, "senior")
    r = ev(spark, P.parse_experience_patterns(F.col("x"), P.JSON_EXPERIENCE_PATTERNS), "· 2 - 5 Yrs of Exp")
    assert (r[0], r[1], r[2]) == (2, 5, "mid")
    r = ev(spark, P.parse_experience_patterns(F.col("x"), P.CSV_EXPERIENCE_PATTERNS, strip_bullet=False),
           "0 To 2 Years")
    assert (r[0], r[1], r[2]) == (0, 2, "junior")


@pytest.mark.parametrize("loc,city", [
    ("Cairo, Egypt, On-site", "Cairo"), ("Giza, Egypt", "Giza"), ("Egypt", "Cairo"), (None, "Cairo"),
    ("Egypt, Remote", "Cairo"), ("  Maadi , Cairo", "Maadi")])
def test_extract_city(spark, loc, city):
    assert ev(spark, P.extract_city(F.col("x")), loc) == city


def test_work_type(spark):
    df = spark.createDataFrame([("Cairo, Remote", "Full Time"), ("Giza", "Hybrid x"), ("Giza", None)], "l string, t string")
    assert [r[0] for r in df.select(P.extract_work_type("l", "t")).collect()] == ["Remote", "Hybrid", "On-site"]


@pytest.mark.parametrize("title,mn,raw,level", [
    ("Middle Data Engineer", None, "", "mid"),
    ("Senior Data Engineer", 1.0, "", "senior"),
    ("Head of Data", None, "", "executive"),
    ("Data Engineer", 1.0, "", "junior"),
    ("Data Engineer", 3.0, "", "mid"),
    ("Data Engineer", 6.0, "", "senior"),
    ("Data Engineer", 9.0, "", "executive"),
    ("Data Engineer", None, "0 to 1 year", "junior"),
    ("Data Engineer", None, "", "mid"),
])
def test_experience_level(spark, title, mn, raw, level):
    df = spark.createDataFrame([(title, mn, raw)], "t string, m double, r string")
    assert df.select(P.classify_experience_level("t", "m", "r")).first()[0] == level


def test_posted_date(spark):
    sd = dt.date(2024, 1, 10)
    cases = {"5 days ago": dt.date(2024, 1, 5), "2 weeks ago": dt.date(2023, 12, 27),
             "1 month ago": dt.date(2023, 12, 11), "3 hours ago": sd, "2024-01-05": dt.date(2024, 1, 5),
             "15/03/2024": dt.date(2024, 3, 15), "03/25/2024": dt.date(2024, 3, 25), "yesterday": sd,
             "Title 24 hours\nCo - Cairo\n3 days ago": dt.date(2024, 1, 7),
             "title\ncompany\n2024-01-05": dt.date(2024, 1, 5)}
    df = spark.createDataFrame([(k, sd) for k in cases], "x string, d date")
    got = dict(df.select("x", P.relative_posted_date("x", "d")).collect())
    assert got == cases


def test_last_line(spark):
    assert ev(spark, P.last_line(F.col("x")), "A\nB - C\n 29 days ago ") == "posted 29 days ago"
    assert ev(spark, P.last_line(F.col("x")), "single line") == "single line"
    assert ev(spark, P.last_line(F.col("x")), "A\nReposted 3 days ago") == "Reposted 3 days ago"


def test_skills_vocabulary(spark):
    arr = ["Apache Spark", "scikit-learn", "Stakeout", "QuickBooks", "· Python", "English",
           "Senior Data Engineer", "x" * 51, "Power BI"]
    got = ev(spark, clean_skills_list(F.col("x"), bullet="drop"), arr, "x array<string>")
    assert got == ["Apache Spark", "scikit-learn", "Power BI"]
    got = ev(spark, clean_skills_list(F.col("x")), arr, "x array<string>")
    assert "Python" in got


def test_list_literal(spark):
    assert ev(spark, parse_list_literal(F.col("x")), "['a', \"b, c\"]") == ["a", "b, c"]
    assert ev(spark, parse_list_literal(F.col("x")), "not a list") == []
    assert ev(spark, first_of_list_literal(F.col("x")), "['data analyst', 'business analyst', 'power bi']") == "data analyst"


def test_category_and_company(spark):
    df = spark.createDataFrame([("Senior Data Engineer",), ("Flutter Developer",), ("Graphic Designer",),
                                ("Power BI Developer",)], "t string")
    assert [r[0] for r in df.select(P.classify_job_category("t")).collect()] == [
        "data engineer", "mobile developer", "other", "bi developer"]
    names = [("Confidential",), ("Samsung Egypt",), ("ITIDA",), ("Smart Data Labs",), ("B Tech",),
             ("Cairo Cement Company",), (None,), ("Nile Software Solutions Group International",)]
    df = spark.createDataFrame(names, "n string")
    assert [r[0] for r in df.select(P.classify_company_type("n")).collect()] == [
        # substring semantics: "ai" inside "cairo" scores one startup keyword (3 words -> Startup)
        "Unknown", "MNC", "Government", "Startup", "Corporate", "Startup", "Unknown", "Startup"]


def test_split_location_and_url(spark):
    r = ev(spark, P.split_location(F.col("x")), "Riyadh, Saudi Arabia")
    assert (r["city"], r["country"]) == ("Riyadh", "Saudi Arabia")
    u = "https://wuzzuf.net/jobs/p/zav5d9coyr5v-procurement-analyst-guillam-alexandria-egypt"
    r = ev(spark, S.location_from_url(F.col("x")), u)
    assert (r["city"], r["country"]) == ("Alexandria", "Egypt")
    df = spark.createDataFrame([("https://wuzzuf.net/jobs/p/f3fi-middle-data-engineer-vertex-technologies-cairo-egypt",
                                 "Middle Data Engineer")], "u string, t string")
    assert S.with_company_from_url(df, "u", "t", "c").first()["c"] == "Vertex Technologies"
    df = spark.createDataFrame([("https://wuzzuf.net/jobs/p/x-senior-the-acme-and-sons-of-cairo-x", "Senior"),
                                ("https://wuzzuf.net/jobs/p/x-cairo-egypt", "Analyst"), ("https://x.com/a", "A")],
                               "u string, t string")
    assert [r["c"] for r in S.with_company_from_url(df, "u", "t", "c").collect()] == [
        "Acme & Sons Of", "Confidential", "Unknown"]


def test_helpers(spark):
    assert ev(spark, collapse_ws(F.col("x")), "  a \t b\n c ") == "a b c"
    assert ev(spark, contains_any(F.col("x"), ["c++", ".net"]), "we use c++ daily") is True
    assert ev(spark, contains_any(F.col("x"), ["c++"]), None) is False
    import hashlib
    assert ev(spark, surrogate_key(F.col("x")), "abc") == hashlib.md5(b"abc").hexdigest()
    assert ev(spark, surrogate_key(F.col("x")), None) == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    r = ev(spark, S.location_hierarchy(F.col("x")), "maadi")
    assert (r[0], r[1]) == ("Cairo", "Maadi")


def test_helpers_more(spark):
    from hirescope.functions.text import title_case, url_encode_blank20
    sd = dt.date(2024, 1, 10)
    df = spark.createDataFrame([("garbage", sd), ("2 days ago", sd)], "x string, d date")
    got = [r[0] for r in df.select(P.relative_posted_date("x", "d", fallback="null")).collect()]
    assert got == [None, dt.date(2024, 1, 8)]
    assert ev(spark, url_encode_blank20(F.col("x")), "data engineer & ml") == "data%20engineer%20%26%20ml"
    assert ev(spark, title_case(F.col("x")), "vertex technologies") == "Vertex Technologies"
    assert ev(spark, P.iso_to_date(F.col("x")), "2026-05-14T10:49:31.351741+00:00") == dt.date(2026, 5, 14)
    assert ev(spark, P.iso_to_date(F.col("x")), "") is None


def test_company_drafts(spark):
    df = spark.createDataFrame([
        ("https://wuzzuf.net/jobs/p/f3fi6wjnx9o9-middle-data-engineer-vertex-technologies-cairo-egypt",
         "Middle Data Engineer"),
        ("https://wuzzuf.net/jobs/p/abc-sales-rep-acme-and-sons-of-x-giza-egypt", "Sales Rep"),
        ("https://x/y", None)], "url string, title string")
    rows = S.with_company_drafts(df, "url", "title").collect()
    a, b, c = rows
    assert (a.company_v1, a.company_v2, a.company_v3, a.company_final, a.company_v4) == (
        "Middle Vertex Technologies", "Vertex Technologies Cairo", "Data Engineer Vertex Technologies Cairo",
        "Vertex Technologies Cairo", "Vertex Technologies Cairo")
    assert (b.company_v1, b.company_v2, b.company_v3, b.company_final, b.company_v4) == (
        "Rep Acme And Sons Of X", "Sales Rep Acme And Sons Of X Giza", "Rep Acme And Sons Of X Giza",
        "Rep Acme Sons X Giza", "Sales Rep Acme Sons X Giza")
    assert {c.company_v1, c.company_v2, c.company_v3, c.company_final, c.company_v4} == {"Unknown"}
