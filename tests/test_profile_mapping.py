"""Mergeable profiles against exact figures; projections driven by a table."""


import pytest
from pyspark.sql import functions as F

from hirescope.operators import mapping, profile
from hirescope.plans import postings
from tests.conftest import SF_SMALL


def people(spark, n=20_000):
    return spark.range(n).select(
        "id", (F.col("id") % 7).cast("int").alias("seven"), F.when(F.col("id") % 10 != 0, F.concat(F.lit("v"), F.col("id") % 3000)).alias("text"),
        (F.pow(F.col("id") % 1000, 2) / 3).alias("x"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("d"),
        F.array("id").alias("list"), (F.col("id") % 2 == 0).alias("flag"), F.lit(None).cast("double").alias("none"))


def test_merged_states_are_within_the_stated_error(spark):
    df = people(spark)
    parts = [profile.state(df.where(F.col("id") % 4 == i)) for i in range(4)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    got = {r.column_name: r for r in profile.report(profile.merge(states)).collect()}
    assert set(got) == {"id", "seven", "text", "x", "d", "flag", "none"}
    for name, exact in (("id", 20_000), ("seven", 7), ("text", 2700), ("x", 1000), ("d", 365), ("flag", 2)):
        assert abs(got[name].distinct_estimate - exact) <= 4 * 0.016 * exact + 0.5, name
    assert got["text"].n_null == 2000 and got["none"].n_null == got["none"].n_rows == 20_000
    assert (got["id"].min_value, got["text"].min_value, got["d"].max_value) == ("0.0", "v1", "2026-12-31")
    xs = sorted((i % 1000) ** 2 / 3 for i in range(20_000))
    for q, name in ((0.25, "p25"), (0.5, "p50"), (0.95, "p95")):
        rank = sum(x <= got["x"][name] for x in xs) / len(xs)
        assert abs(rank - q) < 0.03
    assert got["text"].p50 is None and got["none"].p50 is None
    whole = {r.column_name: r for r in profile.report(profile.state(df)).collect()}
    assert all(whole[c][k] == got[c][k] for c in got for k in ("n_rows", "n_null", "min_value", "max_value"))


def test_one_pass_without_expand(spark):
    plan = profile.state(people(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Range") == 1


def test_audit_and_sample(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", None), (3, None, None)], "k int, v string, w string")
    rows = {(r.section, r.name): r.value for r in profile.audit(df, "k", ["v", "w"], top=2).collect()}
    assert rows == {("shape", "rows"): "4", ("shape", "columns"): "3", ("nulls", "k"): "0", ("nulls", "v"): "1", ("nulls", "w"): "4",
                    ("distribution of v", "a"): "2", ("distribution of v", "(null)"): "1", ("distribution of w", "(null)"): "4",
                    ("duplicates", "rows"): "1", ("duplicates", "k"): "1"}
    assert profile.sample_row(df).collect() == profile.sample_row(df.repartition(3)).collect()
    assert profile.sample_row(df.where("false")).count() == 0


RULES = {"copy": lambda c: c, "upper": F.upper}


def table(spark, *rows):
    return spark.createDataFrame(list(rows), mapping.SCHEMA)


def test_projection_follows_the_table(spark):
    m = mapping.compile_mapping(table(spark, ("a", 0, "x", "upper", "p"), ("a", 1, "y", "literal", "none"), ("b", 0, "x", "copy", "q"),
                                      ("b", 1, "y", "copy", "r")), RULES)
    a = mapping.project(spark.createDataFrame([("v",)], "p string"), m["a"], RULES)
    b = mapping.project(spark.createDataFrame([("w", "z")], "q string, r string"), m["b"], RULES)
    assert [tuple(r) for r in a.unionByName(b).collect()] == [("V", "none"), ("w", "z")]


@pytest.mark.parametrize("bad", [("a", 1, "z", "no such rule", "p"), ("a", 1, "x", "copy", "p"), ("b", 0, "other", "copy", "p")])
def test_bad_mappings_are_refused(spark, bad):
    with pytest.raises(ValueError):
        mapping.compile_mapping(table(spark, ("a", 0, "x", "copy", "p"), bad), RULES)


def test_a_source_is_added_by_rows(spark):
    sources = postings.notebook_sources(spark, SF_SMALL)
    m = postings.notebook_projections(spark)
    third = m.where("source = 'csv'").withColumn("source", F.lit("late")).withColumn(
        "argument", F.when(F.col("target") == "data_source", "late export").otherwise(F.col("argument")))
    late = sources["csv"].withColumn("job_url", F.concat("job_url", F.lit("-late")))
    out = postings.combine_projected({**sources, "late": late}, m.unionByName(third))
    assert out.where("data_source = 'late export'").count() == late.count()
    assert out.where("data_source <> 'late export'").count() == postings.notebook_combined(spark, SF_SMALL).count()
