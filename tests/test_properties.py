"""Brute-force checks: Spark rule helpers vs a plain-Python statement of the
same rules on randomly assembled strings (one Spark job per property)."""

import random

from pyspark.sql import functions as F

from hirescope.functions import parse as P
from hirescope.functions import rules as R
from hirescope.functions.skills import clean_skills_list


def _first_group(text, rules, default):
    for label, kws in rules:
        if any(k in text for k in kws):
            return label
    return default


def _random_strings(rng, pool, n, k=4):
    fillers = ["x", "the", " ", "-", "1", "pro", "& co", "Sr", "DATA", "ai", "it "]
    out = []
    for _ in range(n):
        parts = [rng.choice(pool + fillers) for _ in range(rng.randint(0, k))]
        out.append(" ".join(parts))
    return out


def test_category_and_level_rules(spark):
    rng = random.Random(7)
    pool = [k for _, kws in R.CATEGORY_RULES for k in kws] + [k for _, kws in R.LEVEL_TITLE_RULES for k in kws]
    titles = _random_strings(rng, pool, 400)
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = df.select("t", P.classify_job_category("t").alias("c"),
                    P.classify_experience_level("t", F.lit(None).cast("double"), F.lit("")).alias("l")).collect()
    for r in got:
        low = r.t.lower()
        assert r.c == _first_group(low, R.CATEGORY_RULES, R.CATEGORY_DEFAULT), r.t
        assert r.l == _first_group(low, R.LEVEL_TITLE_RULES, R.LEVEL_DEFAULT), r.t


def test_experience_ranges(spark):
    cases = {"· 2 - 4 Yrs of Exp": (2, 4), "7 - 10 Yrs of Exp": (7, 10), "0 To 1 Year": (0, 1), "1 to 3 years": (1, 3), "3to5": (3, 5),
             "12-15": (12, 15), "5+ Yrs": (5, None), "More Than 3 Years": (3, None), "more than 10 years": (10, None),
             "Not Specified": (None, None), "4 yrs": (None, None), "": (None, None), "· 10 Yrs of Exp": (None, None)}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    for r in df.select("x", P.parse_experience_years("x").alias("e")).collect():
        assert (r.e.min_experience, r.e.max_experience) == cases[r.x], r.x


def test_skill_cleaning(spark):
    cases = [(["· Python", "Docker -", " SQL "], ["Python", "Docker -", "SQL"]),          # bullets are stripped, not dropped
             (["·    php", "·"], ["php"]),
             (["English", "Communication Skills", "Microsoft Office", "ms office"], []),   # noise
             (["Senior Data Engineer", "Python Developer"], ["Python Developer"]),         # two title words make a title
             (["Data Analysis and Reporting", "SQL who Spark", "SQL -> Spark"], []),              # sentences
             (["Stakeout", "QuickBooks"], []),                      # not technical
             (["Apache Spark", "scikit-learn", "Power BI"], ["Apache Spark", "scikit-learn", "Power BI"]),
             (["python " + "x" * 43, "python " + "x" * 44], ["python " + "x" * 43]),       # 50 characters at most
             ([], [])]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a array<string>")
    for r in df.select("i", clean_skills_list("a").alias("c")).collect():
        assert r.c == cases[r.i][1], cases[r.i]
