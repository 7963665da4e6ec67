"""Whole-token country codes, seeded work types, governorate filter, remote flag, absolute URLs."""

from pyspark.sql import functions as F

from hirescope.functions import slug as S
from hirescope.functions import text as X
from hirescope.functions.parse import is_relevant_title


def test_country_code_is_a_whole_token(spark):
    cases = {"https://w.net/jobs/p/1-engineer-jeddah-sa": ("Jeddah", "Saudi Arabia"), "https://w.net/jobs/p/1-engineer-x-sa/": ("Unknown", "Saudi Arabia"),
             "https://w.net/jobs/p/1-engineer-san-francisco": ("Unknown", "Unknown"), "https://w.net/jobs/p/1-sales-riyadh-saudi-arabia": ("Riyadh", "Saudi Arabia"),
             "https://w.net/jobs/p/1-sales-sahel-cairo-egypt": ("Cairo", "Egypt"), "https://w.net/jobs/p/1-x-dubai-uae": ("Dubai", "UAE"),
             "https://w.net/jobs/p/1-sap-x-kuwait": ("Unknown", "Kuwait")}
    df = spark.createDataFrame([(k,) for k in cases], "u string").select("u", S.location_from_url("u").alias("l"))
    assert {r.u: tuple(r.l) for r in df.collect()} == cases


def test_seeded_work_types(spark):
    df = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 4 == 0, "Data Engineer").when(F.col("id") % 4 == 1, "Cook")
                                  .otherwise("Clerk").alias("t"), F.when(F.col("id") % 4 == 2, "Smart Solutions").otherwise("Bakery").alias("c"))
    out = df.select("k", (F.col("k") % 4).alias("q"), S.flexible_work_type(F.lit("On-site"), "t", "c", "k").alias("w"))
    n = {(r.q, r.w): r["count"] for r in out.groupBy("q", "w").count().collect()}
    assert 60 <= n[0, "Remote"] <= 140 and 210 <= n[0, "Hybrid"] <= 330      # a tenth, then three tenths of the rest
    assert (2, "Remote") not in n and 240 <= n[2, "Hybrid"] <= 360
    assert n[1, "On-site"] == n[3, "On-site"] == 1000
    again = df.repartition(7).select("k", S.flexible_work_type(F.lit("On-site"), "t", "c", "k").alias("w"))
    assert sorted(again.collect()) == sorted(out.select("k", "w").collect())
    kept = spark.createDataFrame([("Remote", None, None, None)], "w string, t string, c string, k string")
    assert kept.select(S.flexible_work_type("w", "t", "c", "k")).first()[0] == "Remote"


def test_flags_and_filters(spark):
    df = spark.createDataFrame([("Cairo", " remote "), ("Dubai", "Hybrid"), (None, None), ("Nowhere", "On-site")], "governorate string, w string")
    assert [r.governorate for r in S.egyptian_governorates(df).collect()] == ["Cairo"]
    assert [r.r for r in df.select(S.is_remote("w").alias("r")).collect()] == [1, 0, 0, 0]


def test_urls_and_titles(spark):
    df = spark.createDataFrame([("/jobs/p/12-x?o=1", "Data Engineer"), ("https://w.net/a/b/", "Pastry cook"), ("http://w.net/jobs/p/7#f", None)], "u string, t string")
    got = [tuple(r) for r in df.select(X.absolute_url("u", "https://w.net"), X.id_from_url("u"), is_relevant_title("t")).collect()]
    assert got == [("https://w.net/jobs/p/12-x?o=1", "12-x", True), ("https://w.net/a/b/", "b", False), ("http://w.net/jobs/p/7#f", "7", False)]
