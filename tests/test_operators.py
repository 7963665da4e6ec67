"""Operator invariants: dedup, upsert, statistics, quality (SURVEY 5 (3))."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirescope.operators import dedup, stats, upsert
from hirescope.operators.quality import model_tests, null_counts
from tests.conftest import SF_SMALL, one


def test_keep_last_unique_and_hot_key(spark):
    # one key holds most rows: the aggregate still returns exactly one row per key
    rows = [(1 if i % 3 else i, i, f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, ts long, v string")
    out = dedup.keep_last(df, ["k"], ["ts"])
    assert out.count() == out.select("k").distinct().count()
    assert out.filter("k = 1").first()["ts"] == max(i for i in range(3000) if i % 3)
    first = dedup.keep_first(df, ["k"], ["ts"])
    assert first.filter("k = 1").first()["ts"] == 1


def test_duplicated_rows_and_sequence(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "a", 5), (1, "a", 7)], "u long, t string, ts long")
    assert dedup.duplicated_rows(df, ["u"]).count() == 3
    seq = {r[0]: r[1] for r in dedup.ordered_distinct_list(df, "u", "t", ["ts"]).collect()}
    assert seq == {1: "b,a", 2: "a"}


def test_merge_is_idempotent(spark):
    t = spark.createDataFrame([(1, "old"), (2, "old")], "k long, v string")
    s = spark.createDataFrame([(2, "new"), (3, "new"), (3, "newer")], "k long, v string").withColumn("o", F.monotonically_increasing_id())
    once = upsert.merge_by_key(t.withColumn("o", F.lit(0)), s, ["k"], ["o"])
    twice = upsert.merge_by_key(once, s, ["k"], ["o"])
    a = sorted(tuple(r) for r in once.select("k", "v").collect())
    assert a == sorted(tuple(r) for r in twice.select("k", "v").collect())
    assert a == [(1, "old"), (2, "new"), (3, "newer")]
    c = one(upsert.merge_counts(t, s, ["k"]))
    assert (c.updated_count, c.appended_count, c.total_rows) == (1, 1, 3)


def test_incremental_slice(spark):
    tgt = spark.createDataFrame([(1, 5)], "k long, d long")
    src = spark.createDataFrame([(1, 4), (2, 5), (3, 6)], "k long, d long")
    assert sorted(r.k for r in upsert.incremental_slice(src, tgt, "d").collect()) == [2, 3]
    assert [r.k for r in upsert.incremental_slice(src, tgt, "d", strict=True).collect()] == [3]


def test_anova_chi2_pearson_vs_brute_force(spark):
    rng = np.random.default_rng(1)
    data = [(g, float(x)) for g in "abcd" for x in rng.poisson(3 + "abcd".index(g) * 0.3, 50)]
    df = spark.createDataFrame(data, "g string, x double")
    f = one(stats.anova_oneway(df, "g", "x")).f_stat
    groups = [np.array([x for gg, x in data if gg == g]) for g in "abcd"]
    allx = np.concatenate(groups)
    ssb = sum(len(v) * (v.mean() - allx.mean()) ** 2 for v in groups)
    ssw = sum(((v - v.mean()) ** 2).sum() for v in groups)
    assert math.isclose(f, (ssb / 3) / (ssw / (len(allx) - 4)), rel_tol=1e-5)

    table = np.array([[10, 20, 5], [3, 9, 30], [7, 7, 7]])
    cells = spark.createDataFrame([(f"r{i}", f"c{j}", int(table[i, j])) for i in range(3) for j in range(3)],
                                  "r string, c string, n long")
    res = one(stats.chi_square(cells, "r", "c"))
    exp = table.sum(1)[:, None] * table.sum(0)[None, :] / table.sum()
    assert math.isclose(res.chi2, ((table - exp) ** 2 / exp).sum(), rel_tol=1e-6)
    assert res.dof == 4
    pr = one(stats.pearson(spark.createDataFrame([(1, 2), (2, 4), (3, 7)], "x long, y long"), "x", "y")).r
    assert math.isclose(pr, np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1], rel_tol=1e-5)


def test_p_values():
    assert math.isclose(stats.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-6)
    assert math.isclose(stats.chi2_sf(18.307038053275146, 10), 0.05, rel_tol=1e-6)
    assert math.isclose(stats.f_sf(3.2873821046365093, 3, 15), 0.05, rel_tol=1e-5)
    assert stats.f_sf(0.0, 3, 15) == 1.0


def test_quality_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (2, None)], "a long, b string")
    got = {r[0]: r[1] for r in null_counts(df).collect()}
    assert got == {"a": 0, "b": 2}
    t = {"t": df, "d": spark.createDataFrame([(1,)], "a long")}
    res = {r[0]: r[1] for r in model_tests(t, [("t", "b")], [("t", "a")], [("t", "b", ["x"])],
                                           [("t", "a", "d", "a")]).collect()}
    assert res == {"not_null_t_b": 2, "unique_t_a": 1, "accepted_values_t_b": 0, "relationships_t_a": 2}


def test_star_invariants(spark):
    from hirescope.plans import postings
    s = postings._star(spark, SF_SMALL)
    assert s["fact_jobs"].count() == s["stg_jobs"].count()
    bad = s["mart_job_metrics"].filter(F.abs(F.col("skill_demand_score") + F.col("skill_rarity_score") - 100) > 0.011)
    assert bad.count() == 0
    assert all(r.failures == 0 for r in postings.integrity(spark, SF_SMALL).collect())
    cleaned = postings.cleaned_postings(spark, SF_SMALL)
    assert cleaned.count() == cleaned.select("job_url").distinct().count()


def test_hypothesis_report(spark):
    from hirescope.plans.reports import hypothesis_tests
    rep = hypothesis_tests(spark, SF_SMALL)
    a, c = rep["anova"], rep["chi_square"]
    assert a["df_between"] == 4 and 0.0 <= a["p_value"] <= 1.0
    assert 0.0 <= c["p_value"] <= 1.0 and c["dof"] > 0
    assert -1.0 <= rep["pearson_r"] <= 1.0


def test_audit_profile_approx(spark):
    from hirescope.operators.quality import audit_profile
    df = spark.range(1000).selectExpr("id", "id % 7 AS k", "CAST(NULL AS STRING) AS s")
    exact = {r.column_name: r for r in audit_profile(df).collect()}
    approx = {r.column_name: r for r in audit_profile(df, exact=False).collect()}
    assert exact["k"].distinct_count == 7 and exact["s"].null_count == 1000
    assert abs(approx["id"].distinct_count - 1000) <= 30 and approx["k"].distinct_count == 7


def test_versions_are_never_overwritten(spark, tmp_path):
    import os
    base = str(tmp_path / "t")
    one, two = spark.range(5), spark.range(9)
    first = upsert.write_version(one, base, "9")
    assert upsert.write_version(two, base, "9") == first and spark.read.parquet(first).count() == 5
    parent = upsert.head(spark, base)
    second = upsert.write_version(two, base, "10", parent)            # "10" < "9" as text
    assert upsert.latest_version(spark, base) == second
    with pytest.raises(upsert.CommitConflict):                        # another writer was faster
        upsert.write_version(one, base, "11", parent)
    assert upsert.latest_version(spark, base) == second and not upsert.is_committed(spark, base, "11")
    one.write.parquet(f"{base}/v=12-crashed")                         # written, never committed
    assert upsert.latest_version(spark, base) == second
    assert upsert.write_version(one, base, "12") != f"{base}/v=12-crashed"
    assert os.path.exists(f"{base}/v=12-crashed")
    gone = upsert.expire(spark, base, 1)
    assert first in gone and not os.path.exists(first) and upsert.latest_version(spark, base) not in gone
    with pytest.raises(ValueError):                                   # its folder is no longer there
        upsert.write_version(one, base, "9")


def test_dead_writer_locks_nothing(spark, tmp_path):
    base = str(tmp_path / "t")
    upsert.write_version(spark.range(3), base, "1")
    open(f"{base}/_versions/000000000002.json", "w").close()          # a writer died in between
    second = upsert.write_version(spark.range(4), base, "2")
    assert upsert.latest_version(spark, base) == second and upsert.head(spark, base) == 2


def test_log_is_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "SNAPSHOT_EVERY", 3)
    base = str(tmp_path / "t")
    paths = [upsert.write_version(spark.range(i), base, str(i)) for i in range(5)]
    assert upsert.head(spark, base) == 5 and upsert.latest_version(spark, base) == paths[-1]
    assert upsert.write_version(spark.range(9), base, "1") == paths[1]
    for i in range(5):                                                # entries before the snapshot aren't read
        if i < 3:
            open(f"{base}/_versions/{i + 1:012d}.json", "w").close()
        assert upsert.is_committed(spark, base, str(i))
    with pytest.raises(upsert.CommitConflict):
        upsert.commit_folder(spark, base, "late", "x", 4)


def test_fieldwise_update(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, p string, q string")
    new = spark.createDataFrame([(2, None, "n", 1), (2, "late", None, 2), (3, "c", "m", 1)],
                                "id long, p string, r string, o int")
    got = {r.id: (r.p, r.q, r.r) for r in upsert.fieldwise_update(old, new, "id", ["o"]).collect()}
    assert got == {1: ("a", "x", None), 2: ("late", "y", None), 3: ("c", None, "m")}
